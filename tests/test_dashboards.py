from pyspark.sql import functions as F

from tests.conftest import day, table
from tidegauge.operators import dashboards as d, lifecycle
from tidegauge.schemas import AGG_DAILY_KPIS, AGG_RETENTION_COHORT


def _kpis(spark, *rows):
    blank = dict.fromkeys([f.name for f in AGG_DAILY_KPIS])
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], AGG_DAILY_KPIS)


def test_kpi_cards(spark):
    kpis = _kpis(
        spark,
        dict(date=day("2025-01-01"), variant="control", signups=9, dau=9, wau=9, mau=9),
        dict(date=day("2025-01-02"), variant="control", signups=1, dau=2, wau=3, mau=4),
        dict(date=day("2025-01-02"), variant="treatment", signups=1, dau=2, wau=3, mau=4),
    )
    retention = spark.createDataFrame([
        (day("2025-01-01"), "control", 9, 1, 9, 1.0), (day("2025-01-02"), "control", 1, 1, 4, 0.25),
        (day("2025-01-01"), "control", 3, 7, 4, 0.75),
    ], AGG_RETENTION_COHORT)
    assert table(d.kpi_cards(kpis, retention)) == {
        ("signups", 2.0), ("dau", 4.0), ("wau", 6.0), ("mau", 8.0), ("dau_mau_ratio", 0.5),
        ("d1_retention", 0.25), ("d7_retention", 0.75),
    }
    assert d.retention_trend(retention, [7]).count() == 1
    assert d.active_user_trend(kpis).columns == ["date", "variant", "signups", "dau", "wau", "mau"]


def test_ratios_on_kpis(spark):
    kpis = _kpis(
        spark,
        dict(date=day("2025-01-01"), variant="control", lessons_completed=3, sessions=2, premium_users=1, premium_share=0.5),
        dict(date=day("2025-01-02"), variant="control", lessons_completed=3, sessions=0),
    )
    assert table(d.lessons_per_session(kpis)) == {
        (day("2025-01-01"), "control", 1.5), (day("2025-01-02"), "control", None)
    }
    assert (day("2025-01-01"), "control", 1, 0.5) in table(d.premium_share_trend(kpis))


def test_mixes(spark):
    daily = spark.createDataFrame([
        (day("2025-01-01"), "New", 1), (day("2025-01-01"), "Current", 3), (day("2025-01-01"), "AtRiskWAU", 6),
    ], "date date, state string, users bigint")
    assert table(d.active_mix(daily), "state_name", "share") == {("New", 0.25), ("Current", 0.75)}
    assert table(d.health_mix(daily), "state_name", "users") == {("Current", 3), ("At Risk WAU", 6)}


def test_paywall_and_purchase(frames):
    events = frames.events(
        (1, "2025-01-01T10:00", "app_open", "control"), (2, "2025-01-01T10:00", "app_open", "control"),
        (1, "2025-01-01T10:05", "paywall_shown", "control"), (1, "2025-01-01T10:06", "purchase", "control"),
        (2, "2025-01-01T10:07", "purchase", "control"), (2, "2025-01-02T10:00", "app_open", "control"),
        (1, "2025-01-03T10:00", "paywall_shown", "control"),
    )
    assert table(d.paywall_rate(events)) == {(day("2025-01-01"), 2, 1, 0.5), (day("2025-01-02"), 1, 0, 0.0)}
    assert table(d.purchase_conversion(events)) == {(day("2025-01-01"), 1, 1, 1.0), (day("2025-01-03"), 1, 0, 0.0)}


def test_session_duration_and_hearts_by_any_user_column(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment")).withColumn("country", F.lit("AU"))
    sessions = frames.sessions(
        ("s1", 1, "2025-01-01T10:00", "2025-01-01T10:10"), ("s2", 2, "2025-01-01T10:00", "2025-01-01T10:20")
    )
    assert table(d.session_duration(sessions)) == {(day("2025-01-01"), 900.0)}
    assert table(d.session_duration(sessions, users, group_cols=["country"])) == {(day("2025-01-01"), "AU", 900.0)}
    events = frames.full_events(
        ("a", 1, "2025-01-01T10:00", "app_open", 0, 0, 0, False, "control"),
        ("b", 1, "2025-01-01T10:01", "question_answered", 0, -2, 0, False, "control"),
        ("c", 2, "2025-01-01T10:01", "question_answered", 0, 1, 0, False, "control"),
    )
    assert table(d.hearts_lost_per_user(events, users, group_cols=["country"])) == {(day("2025-01-01"), "AU", 2.0)}


def test_streak_metrics(spark):
    fact = spark.createDataFrame([
        (day("2025-01-01"), "control", 4, 1, 2), (day("2025-01-01"), "control", 0, 0, 1),
    ], "date date, variant string, streak_length_end_of_day int, is_active int, hearts_lost bigint")
    assert table(d.streak_metrics(fact)) == {(day("2025-01-01"), "control", 2.0, 0.5)}
    assert table(d.hearts_per_active_day(fact)) == {(day("2025-01-01"), 3.0)}


def test_wide_lifecycle(spark):
    counts = spark.createDataFrame([
        (day("2025-01-01"), "New", 2, "control"), (day("2025-01-01"), "New", 4, "treatment"),
    ], "date date, state string, users bigint, variant string")
    row = lifecycle.lifecycle_wide(counts).first()
    assert (row["New"], row["Dormant"]) == (3.0, 0.0)
    assert lifecycle.lifecycle_wide(counts, variant="control").first()["New"] == 2.0
    row = lifecycle.lifecycle_by_arm(counts).first()
    assert (row["treatment_New"], row["control_Dormant"]) == (4.0, None)
