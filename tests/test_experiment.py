import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, table
from tidegauge.operators import experiment as ex

START = dt.date(2025, 1, 1)


def _wide(spark, pairs):
    rows = [(START + dt.timedelta(days=i), c, t) for i, (c, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, "date date, control bigint, treatment bigint")


def test_assignment_is_balanced_per_date_and_repeatable(spark):
    users = spark.range(1000).select(
        F.col("id").alias("user_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), F.when(F.col("id") < 401, 0).otherwise(F.col("id") % 7).cast("int")).alias("signup_date"),
    )
    got = ex.assign_variant(users, seed=1)
    assert got.columns == ["signup_date", "user_id", "variant"] or set(got.columns) == {"user_id", "signup_date", "variant"}
    sizes = got.groupBy("signup_date").agg(
        F.count_if(F.col("variant") == "control").alias("c"), F.count("*").alias("n")
    ).collect()
    assert all(r.c == r.n // 2 for r in sizes) and sum(r.n for r in sizes) == 1000
    assert table(got) == table(ex.assign_variant(users.repartition(7), seed=1))
    assert table(got) != table(ex.assign_variant(users, seed=2))


def test_dau_by_variant_takes_the_arm_of_the_user(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"))
    events = frames.events(
        (1, "2025-01-01T10:00", "app_open", "treatment"), (1, "2025-01-01T11:00", "app_open", "control"),
        (2, "2025-01-02T10:00", "app_open", "control"), (3, "2025-01-03T10:00", "app_open", "control"),
    )
    assert table(ex.dau_by_variant(events, users)) == {
        (day("2025-01-01"), 1, None), (day("2025-01-02"), None, 1)
    }


def test_rollout_date(frames, spark):
    users = frames.users((1, "2025-01-05", "control"), (2, "2025-01-01", "treatment"))
    assert spark.range(1).select(ex.rollout_date(users)).first()[0] == day("2025-04-01")


def test_aa_check_passes_and_fails_by_rule(spark):
    same = _wide(spark, [(100 + 10 * i, 100 + 10 * i) for i in range(20)])
    row = ex.aa_check(same, "2025-01-16").first()
    assert (row.days, row.mean_ratio, row.p95_abs_gap, row.passed) == (15, 1.0, 0.0, True)
    assert row["corr"] == pytest.approx(1.0)
    apart = _wide(spark, [(100 + 10 * i, 120 + 12 * i) for i in range(20)])
    row = ex.aa_check(apart, "2025-02-01").first()
    assert (row.enough_days, row.mean_ok, row.gap_ok, row.corr_ok, row.passed) == (True, False, False, True, False)
    small = ex.aa_check(_wide(spark, [(1, 1)] * 20), "2025-02-01").first()
    assert (small.days, small.enough_days, small.passed) == (0, False, False)


def test_aa_check_smoothed_uses_seven_day_means(spark):
    pairs = [(100 + 10 * i + (9 if i % 2 else -9), 100 + 10 * i + (-9 if i % 2 else 9)) for i in range(20)]
    row = ex.aa_check_smoothed(_wide(spark, pairs), "2025-02-01").first()
    assert row.days == 14 and row.corr_ok and row.gap_ok and row.passed
    short = ex.aa_check_smoothed(_wide(spark, pairs[:12]), "2025-02-01").first()
    assert (short.days, short.corr_ok, short.passed) == (6, None, False)


def test_signup_share_and_activity_rate(frames, spark):
    users = frames.users(
        (1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"), (3, "2025-01-01", "treatment"),
        (4, "2025-01-03", "control"),
    )
    assert table(ex.signup_share(users), "date", "control", "treatment", "total") == {
        (day("2025-01-01"), 1, 2, 3), (day("2025-01-03"), 1, 0, 1)
    }
    wide = _wide(spark, [(1, 1), (1, 2), (1, 2), (None, 1)])
    rates = ex.activity_rate(wide, users)
    assert table(rates, "date", "control_cum", "dau_rate_control", "dau_rate_treatment") == {
        (day("2025-01-01"), 1, 1.0, 0.5), (day("2025-01-02"), 1, 1.0, 1.0), (day("2025-01-03"), 2, 0.5, 1.0)
    }
    assert ex.activity_rate(wide, users, "2025-01-02").count() == 1


def test_sessions_per_active_user_is_null_without_a_side(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"))
    sessions = frames.sessions(
        ("s1", 1, "2025-01-01T10:00", "2025-01-01T10:10"), ("s2", 1, "2025-01-01T12:00", "2025-01-01T12:10"),
        ("s3", 2, "2025-01-02T10:00", "2025-01-02T10:10"),
    )
    events = frames.events((1, "2025-01-01T10:00", "app_open", "control"), (2, "2025-01-03T10:00", "app_open", "treatment"))
    assert table(ex.sessions_per_active_user(sessions, events, users)) == {
        (day("2025-01-01"), 2.0, None), (day("2025-01-02"), None, None), (day("2025-01-03"), None, None)
    }
    assert (day("2025-01-01"), 2.0) in table(ex.sessions_per_active_user(sessions, events, by_variant=False))


def test_average_streak_and_opens(frames):
    events = frames.full_events(
        ("a", 1, "2025-01-01T10:00", "streak_incremented", 0, 0, 2, False, "control"),
        ("b", 2, "2025-01-01T10:00", "streak_incremented", 0, 0, 4, False, "control"),
        ("c", 2, "2025-01-01T10:00", "app_open", 0, 0, 9, False, "control"),
        ("d", 2, "2025-01-02T10:00", "app_open", 0, 0, 9, False, "control"),
    )
    assert table(ex.average_streak(events)) == {(day("2025-01-01"), 3.0, None)}
    assert table(ex.average_streak(events, by_variant=False)) == {(day("2025-01-01"), 3.0)}
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "control"))
    assert table(ex.opens_per_user(events, users)) == {("control", 2.0)}


def test_pre_post_summary(spark):
    wide = _wide(spark, [(10, 11), (20, 22), (None, 30), (40, 60)])
    got = ex.pre_post_summary({"dau": wide}, "2025-01-03")
    assert got.columns == ["metric", "control", "treatment", "diff_pct", "window"]
    rows = {r.window: r for r in got.collect()}
    assert (rows["pre"].control, rows["pre"].treatment) == (15.0, 16.5)
    assert rows["pre"].diff_pct == pytest.approx(0.1)
    assert (rows["post"].control, rows["post"].treatment, rows["post"].diff_pct) == (40.0, 45.0, 0.125)
    zero = ex.pre_post_summary({"dau": _wide(spark, [(0, 5)])}, "2025-01-03").first()
    assert zero.diff_pct is None


def test_guardrails(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"))
    events = frames.full_events(
        ("a", 1, "2025-01-01T10:00", "lesson_started", 0, -1, 0, False, "control"),
        ("b", 1, "2025-01-01T10:10", "lesson_completed", 0, 0, 0, False, "control"),
        ("c", 1, "2025-01-01T10:11", "paywall_shown", 0, 0, 0, False, "control"),
        ("d", 1, "2025-01-01T10:12", "purchase", 0, 0, 0, False, "control"),
        ("e", 2, "2025-01-01T10:12", "purchase", 0, 0, 0, False, "treatment"),
    )
    sessions = frames.sessions(("s1", 1, "2025-01-01T10:00", "2025-01-01T10:20"))
    got = ex.guardrails(sessions, events, users)
    assert table(got) == {
        (day("2025-01-01"), "control", 1200.0, 1.0, 1.0, 1.0), (day("2025-01-01"), "treatment", None, None, None, None)
    }


def test_guardrail_z(spark):
    rows = [("control", float(v)) for v in (10, 12, 11, 13)] + [("treatment", float(v)) for v in (5, 6, 5, 6)]
    daily = spark.createDataFrame(rows, "variant string, m double")
    row = ex.guardrail_test(daily, ["m"]).first()
    expected = (5.5 - 11.5) / ((5 / 3 / 4 + 1 / 3 / 4) ** 0.5)
    assert (row.control, row.treatment, row.significant) == (11.5, 5.5, True)
    assert row.z == pytest.approx(expected)
