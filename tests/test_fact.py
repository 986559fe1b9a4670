import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, table
from tidegauge.operators import fact, kpis, streaks
from tidegauge.schemas import DERIVED_TABLES

USERS = [(1, "2025-01-01", "control", True), (2, "2025-01-03", "treatment"), (3, "2025-03-01", "control")]
EVENTS = [
    ("a1", 1, "2025-01-01T08:00", "signup", 0, 0, 0, False, "control"),
    ("a2", 1, "2025-01-01T09:00", "lesson_completed", 10, 0, 1, False, "control"),
    ("a3", 1, "2025-01-01T09:30", "question_answered", 0, -1, 4, True, "control"),
    ("a4", 1, "2025-01-01T09:30", "question_answered", 0, -1, 5, False, "control"),
    ("b1", 2, "2025-01-04T10:00", "app_open", 0, 0, 2, False, "treatment"),
    ("x1", 9, "2025-12-31T10:00", "app_open", 0, 0, 0, False, "control"),
]


@pytest.fixture(scope="module")
def built(frames):
    sessions = frames.sessions(
        ("s1", 1, "2025-01-01T09:00", "2025-01-01T09:10"),
        ("s2", 1, "2025-01-01T19:00", "2025-01-01T19:01"),
        ("s3", 2, "2025-01-05T10:00", "2025-01-05T10:05"),
    )
    return fact.build_fact_user_daily(
        frames.users(*USERS), frames.full_events(*EVENTS), sessions, date_max="2025-01-05"
    ).cache()


def _row(built, user, date):
    return built.filter((F.col("user_id") == user) & (F.col("date") == date)).first()


def test_columns_and_types(built):
    assert built.columns == fact.FACT_COLUMNS
    assert dict(built.dtypes) == {f.name: f.dataType.simpleString() for f in DERIVED_TABLES["fact_user_daily"]}


def test_grain(built):
    assert table(built, "user_id", "date") == {
        *((1, day(f"2025-01-0{d}")) for d in range(1, 6)), *((2, day(f"2025-01-0{d}")) for d in range(3, 6))
    }
    assert built.count() == 8


def test_busy_day(built):
    r = _row(built, 1, "2025-01-01")
    assert (r.is_active, r.had_app_open, r.had_lesson_started, r.had_lesson_completed) == (1, 0, 0, 1)
    assert (r.sessions_count, r.session_duration_sec) == (2, 660)
    assert (r.lessons_completed, r.xp_earned, r.hearts_lost) == (1, 10, 2)
    assert (r.streak_length_end_of_day, r.is_premium) == (5, False)  # the tie goes to the later id
    assert r.lifecycle_state == "New"


def test_quiet_day_falls_back_to_the_signup_premium(built):
    r = _row(built, 1, "2025-01-02")
    assert (r.is_active, r.sessions_count, r.streak_length_end_of_day) == (0, 0, 0)
    assert (r.is_premium, r.lifecycle_state, r.days_since_signup) == (True, "AtRiskWAU", 1)
    assert _row(built, 2, "2025-01-05").is_premium is False


def test_quiet_days_before_the_first_busy_one(built):
    assert _row(built, 2, "2025-01-03").lifecycle_state == "New"
    assert _row(built, 2, "2025-01-04").lifecycle_state == "Resurrected"
    r = _row(built, 2, "2025-01-05")
    assert (r.sessions_count, r.is_active, r.lifecycle_state) == (1, 0, "AtRiskWAU")


def test_default_end_ignores_unknown_users_and_counts_late_signups(frames):
    built = fact.build_fact_user_daily(frames.users(*USERS), frames.full_events(*EVENTS), frames.sessions())
    assert built.agg(F.max("date")).first()[0] == day("2025-03-01")


def test_without_lifecycle_sample_and_kept_columns(frames):
    users = frames.users(*USERS).withColumn("country", F.lit("AU"))
    built = fact.build_fact_user_daily(
        users, frames.full_events(*EVENTS), frames.sessions(), date_max="2025-01-02",
        include_lifecycle=False, sample_n_users=1, keep_user_cols=["country"],
    )
    assert built.columns == [*fact.FACT_COLUMNS, "country"]
    assert table(built, "user_id", "lifecycle_state", "country") == {(1, None, "AU")}
    with pytest.raises(ValueError, match="at least one user"):
        fact.build_fact_user_daily(users, frames.full_events(), frames.sessions(), sample_n_users=0)


def test_empty_spine_and_reversed_range(frames):
    users, events, sessions = frames.users((3, "2025-03-01", "control")), frames.full_events(), frames.sessions()
    empty = fact.build_fact_user_daily(users, events, sessions, date_min="2025-04-01", date_max="2025-04-02")
    assert empty.count() == 2  # signed up before, so present without any event
    with pytest.raises(Exception, match="lies after the last day"):
        fact.build_fact_user_daily(users, events, sessions, date_max="2025-02-01").collect()
    with pytest.raises(ValueError, match="lies after the last day"):
        fact.build_fact_user_daily(users, events, sessions, date_min="2025-02-01", date_max="2025-01-01")


def test_no_spine_rows_after_the_end(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-02-01", "control"))
    spine = fact.build_user_date_spine(users, date_max="2025-01-02")
    assert spine.columns == ["date", "user_id", "signup_date", "days_since_signup"]
    assert table(spine, "user_id", "date", "days_since_signup") == {
        (1, day("2025-01-01"), 0), (1, day("2025-01-02"), 1)
    }


def test_events_without_times_use_the_last_known_value_by_id(frames):
    events = frames.full_events(
        ("a1", 1, "2025-01-01T08:00", "app_open", 0, 0, 3, True, "control"),
        ("a2", 1, "2025-01-01T08:00", "app_open", 0, 0, None, False, "control"),
    ).drop("event_time")
    built = fact.build_fact_user_daily(frames.users(USERS[0]), events, frames.sessions())
    assert table(built, "streak_length_end_of_day", "is_premium") == {(3, False)}


def test_bad_dates_fail_the_job(spark, frames):
    users = spark.createDataFrame([(1, "2025-01-01"), (2, "soon")], "user_id bigint, signup_date string")
    with pytest.raises(Exception, match="Not a calendar day"):
        fact.build_user_date_spine(users).collect()
    none = frames.users((1, None, "control"))
    with pytest.raises(Exception, match="Not a calendar day"):
        fact.build_user_date_spine(none).collect()


def test_dense_table_is_not_shuffled(frames):
    """After the last exchange come the join, the window and the explode of the quiet days."""
    built = fact.build_fact_user_daily(
        frames.users(*USERS), frames.full_events(*EVENTS), frames.sessions(), date_max="2025-01-05"
    )
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate explode(sequence")]


def test_kpis(frames, built):
    users, events = frames.users(*USERS), frames.full_events(*EVENTS)
    got = kpis.build_agg_daily_kpis(built, users, events)
    assert got.columns == [f.name for f in DERIVED_TABLES["agg_daily_kpis"]]
    rows = {(r.date, r.variant): r for r in got.collect()}
    first = rows[day("2025-01-01"), "control"]
    assert (first.signups, first.dau, first.wau, first.mau, first.sessions) == (1, 1, 1, 1, 2)
    assert (first.avg_session_duration_sec, first.sessions_per_active_user, first.xp_per_active_user) == (660.0, 2.0, 10.0)
    second = rows[day("2025-01-02"), "control"]
    assert (second.signups, second.dau, second.sessions_per_active_user, second.premium_users) == (0, 0, 0.0, 1)
    late = rows[day("2025-01-05"), "treatment"]
    assert (late.dau, late.wau, late.mau, late.dau_mau_ratio) == (0, 0, 0, 0.0)  # after the last active day


def test_streaks(frames, built):
    events = frames.events(*[
        (1, f"2025-01-{d:02d}T10:00", "app_open", "control") for d in (1, 2, 3, 5, 8, 9)
    ])
    assert table(streaks.streak_runs(events)) == {
        (1, day("2025-01-01"), day("2025-01-03"), 3), (1, day("2025-01-05"), day("2025-01-05"), 1),
        (1, day("2025-01-08"), day("2025-01-09"), 2),
    }
    assert (day("2025-01-01"), 1, 1) in table(streaks.streak_by_day(built))
    assert (day("2025-01-02"), 1, 0) in table(streaks.streak_by_day(built))
    assert dt.date(2025, 1, 4) in {r.date for r in streaks.streak_by_day(built).filter("streak_length = 1").collect()}


def test_a_build_of_a_few_days_reads_only_their_partitions(spark, frames, tmp_path):
    path = str(tmp_path / "events")
    frames.full_events(*EVENTS).write.partitionBy("event_date").parquet(path)
    events = spark.read.parquet(path)
    users, sessions = frames.users(*USERS), frames.sessions()
    window = dict(date_min="2025-01-02", date_max="2025-01-05")
    built = fact.build_fact_user_daily(users, events, sessions, **window)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(event_date" in plan and "2025-01-02" in plan
    whole = fact.build_fact_user_daily(users, frames.full_events(*EVENTS), sessions, **window)
    assert table(built) == table(whole)


def test_filters_and_columns_reach_the_scan(spark, frames, tmp_path):
    from tidegauge.operators import activity

    path = str(tmp_path / "events")
    frames.full_events(*EVENTS).write.parquet(path)
    plan = activity.compute_dau(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "In(event_name, [app_open,lesson_completed,lesson_started])" in plan
    assert "ReadSchema: struct<user_id:bigint,event_date:date,event_name:string,variant:string>" in plan
