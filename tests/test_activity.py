import pytest
from pyspark.sql import functions as F

from tests.brute import DAY, START, random_days, trailing_users
from tests.conftest import day, table
from tidegauge.operators import activity


def _events(spark, active, variant=lambda u: "control"):
    rows = [(u, d, "app_open", variant(u)) for u, days in active.items() for d in days]
    return spark.createDataFrame(rows, "user_id bigint, event_date date, event_name string, variant string")


@pytest.mark.parametrize("seed,window", [(1, 7), (2, 30), (3, 7), (4, 1)])
def test_trailing_users_equal_the_set_definition(spark, seed, window):
    active = {u: days for u, (_, days) in random_days(seed).items()}
    days = _events(spark, active).select("user_id", F.col("event_date").alias("date"))
    got = activity.trailing_active_users(days, {"n": window}, [])
    assert table(got, "date", "n") == set(trailing_users(active, window).items())


def test_several_windows_in_one_pass(spark):
    active = {u: days for u, (_, days) in random_days(5).items()}
    arm = {u: "control" if u % 2 else "treatment" for u in active}
    got = activity.compute_active_users(_events(spark, active, arm.get))
    for name in ("control", "treatment"):
        own = {u: d for u, d in active.items() if arm[u] == name}
        rows = got.filter(F.col("variant") == name)
        for label, window in (("dau", 1), ("wau", 7), ("mau", 30)):
            assert table(rows, "date", label) == set(trailing_users(own, window).items())


def test_dau_is_sparse_and_drops_null_keys_wau_is_dense_and_keeps_them(frames):
    events = frames.events(
        (1, "2025-01-01T10:00", "app_open", "control"),
        (1, "2025-01-04T10:00", "app_open", "control"),
        (2, "2025-01-04T10:00", "lesson_started", "control"),
        (2, "2025-01-05T10:00", "push_received", "control"),
        (3, "2025-01-02T10:00", "app_open", None),
    )
    dau = activity.compute_dau(events)
    assert dau.columns == ["date", "variant", "dau"]
    assert table(dau) == {(day("2025-01-01"), "control", 1), (day("2025-01-04"), "control", 2)}
    wau = activity.compute_wau(events)
    assert wau.columns == ["date", "variant", "wau"]
    assert table(wau) == {
        (day("2025-01-01"), "control", 1), (day("2025-01-02"), "control", 1),
        (day("2025-01-03"), "control", 1), (day("2025-01-04"), "control", 2),
        (day("2025-01-02"), None, 1),
    }


def test_active_names_and_keys_from_users(frames):
    events = frames.events((1, "2025-01-01T10:00", "signup", None)).drop("variant")
    users = frames.users((1, "2025-01-01", "control"))
    assert activity.compute_dau(events, group_cols=None).count() == 0
    got = activity.compute_dau(events, active_event_names=["signup"], users=users)
    assert table(got) == {(day("2025-01-01"), "control", 1)}
    with pytest.raises(ValueError, match="cannot be grouped by"):
        activity.compute_dau(events)


def test_no_activity_gives_an_empty_table(frames):
    events = frames.events((1, "2025-01-01T10:00", "push_received", "control"))
    assert activity.compute_mau(events).columns == ["date", "variant", "mau"]
    assert activity.compute_mau(events).count() == 0


def test_window_length_must_be_positive(frames):
    with pytest.raises(ValueError, match="at least one day"):
        activity.trailing_active_users(frames.events().select("user_id"), {"n": 0}, [])


def test_rolling_mean_partial_and_full(spark):
    rows = [(START + DAY * i, i) for i in range(9)]
    daily = spark.createDataFrame(rows, "date date, dau int")
    partial = {r["date"]: r["avg"] for r in activity.rolling_mean(daily, "dau", name="avg").collect()}
    assert partial[START] == 0.0 and partial[START + DAY * 3] == 1.5
    full = activity.rolling_mean(daily, "dau", name="avg", full_only=True)
    assert table(full, "date", "avg") == {
        (START + DAY * 6, 3.0), (START + DAY * 7, 4.0), (START + DAY * 8, 5.0)
    }


def test_a_user_with_most_events_reaches_the_shuffle_reduced(spark):
    """One user with nearly all rows: the distinct is combined on the map side."""
    events = spark.range(0, 50_000, 1, 4).select(
        F.when(F.col("id") < 49_000, F.lit(0)).otherwise(F.col("id")).alias("user_id"),
        F.lit("2025-01-01").cast("date").alias("event_date"), F.lit("app_open").alias("event_name"),
    )
    plan = activity.active_user_days(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") > plan.index("HashAggregate")
    assert plan.count("HashAggregate") == 2
    assert table(activity.compute_dau(events, group_cols=None)) == {(day("2025-01-01"), 1_001)}
