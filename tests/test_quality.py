import pytest
from pyspark.sql import functions as F

from tests.conftest import day, moment, table
from tidegauge.functions.checks import validate_minimum_columns
from tidegauge.operators import quality


@pytest.fixture(scope="module")
def clean(frames, spark):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment")).withColumn(
        "signup_time", F.lit("2025-01-01 08:00:00").cast("timestamp_ntz")
    )
    sessions = frames.sessions(("s1", 1, "2025-01-01T09:00", "2025-01-01T09:30"))
    events = frames.full_events(
        ("e1", 1, "2025-01-01T09:00", "app_open", 0, 0, 0, False, "control"),
        ("e2", 1, "2025-01-01T09:01", "lesson_started", 0, 0, 0, False, "control"),
        ("e3", 1, "2025-01-01T09:10", "lesson_completed", 5, 0, 0, False, "control"),
    ).withColumns({"session_id": F.lit("s1"), "lesson_id": F.lit("L1")})
    signup = frames.full_events(
        ("e0", 1, "2025-01-01T08:00", "signup", 0, 0, 0, False, "control")
    ).withColumns({"session_id": F.lit(""), "lesson_id": F.lit(None).cast("string")})
    lessons = spark.createDataFrame([("L1",)], "lesson_id string")
    return users, sessions, events.unionByName(signup), lessons


def _violations(report):
    return {(r.table, r.check): r.violations for r in report.collect() if not r.passed}


def test_clean_tables_pass(clean):
    report = quality.quality_report(*clean)
    assert report.columns == ["check", "table", "violations", "passed"]
    assert _violations(report) == {}
    assert report.count() >= 25


def _with_event(clean, **changes):
    """The clean events and one more, a copy of e1 with changes."""
    events = clean[2]
    extra = events.filter("event_id = 'e1'").withColumn("event_id", F.lit("e9"))
    extra = extra.withColumns({c: F.lit(v).cast(dict(events.dtypes)[c]) for c, v in changes.items()})
    return events.unionByName(extra)


@pytest.mark.parametrize("changes,expected", [
    ({"event_id": "e1"}, {"unique_event_id": 2}),
    ({"user_id": 7}, {"user_exists": 1, "active_rows_have_variant": 1}),
    ({"user_id": None}, {"user_exists": 1, "active_rows_have_variant": 1}),
    ({"session_id": "s7"}, {"session_found": 1}),
    ({"event_name": "lesson_started", "lesson_id": ""},
     {"lesson_present": 1, "lesson_started_within_app_open_events": 1}),
    ({"event_name": "lesson_started", "lesson_id": "L7"},
     {"lesson_exists": 1, "lesson_started_within_app_open_events": 1}),
    ({"event_time": moment("2025-01-01T08:59")}, {"not_before_session": 1}),
    ({"event_time": moment("2025-01-01T09:31")}, {"not_after_session": 1}),
    ({"event_time": moment("2025-01-01T07:59"), "session_id": ""}, {"not_before_signup": 1}),
    ({"event_date": day("2025-01-02")}, {"date_matches_time": 1}),
    ({"event_date": None}, {"date_matches_time": 1, "event_date_known": 1}),
    ({"event_name": "dance"}, {"name_in_taxonomy": 1}),
    ({"event_name": "lesson_completed", "xp_delta": -1},
     {"xp_not_negative": 1, "lesson_completed_within_lesson_started_events": 1, "completed_after_started": 1}),
    ({"streak_length": -1}, {"streak_not_negative": 1}),
])
def test_each_event_violation_is_reported(clean, changes, expected):
    users, sessions, _, lessons = clean
    report = quality.quality_report(users, sessions, _with_event(clean, **changes), lessons)
    assert _violations(report) == {("events", c): n for c, n in expected.items()}


def test_session_violations(clean, frames):
    users, _, events, lessons = clean
    sessions = frames.sessions(
        ("s1", 1, "2025-01-01T09:00", "2025-01-01T09:30"), ("s1", 1, "2025-01-01T09:00", "2025-01-01T09:30"),
        ("s2", 9, "2025-01-01T10:00", "2025-01-01T09:00"), ("s3", 1, "2025-01-01T07:00", "2025-01-01T07:10"),
    ).withColumn("session_duration_sec", F.when(F.col("session_id") == "s3", 603).otherwise(F.col("session_duration_sec")))
    report = quality.quality_report(users, sessions.dropDuplicates(), events, lessons)
    assert _violations(report) == {
        ("sessions", "user_exists"): 1, ("sessions", "end_not_before_start"): 1,
        ("sessions", "duration_not_negative"): 1, ("sessions", "not_before_signup"): 1,
        ("sessions", "duration_matches"): 1,
    }
    assert quality.key_violations(sessions, "session_id").first()[0] == 2


def test_missing_columns(clean):
    users, sessions, events, lessons = clean
    report = quality.quality_report(users, sessions, events.drop("xp_delta"), lessons, full_layout=True)
    assert _violations(report)["events", "xp_not_negative"] is None
    assert _violations(report)["lessons", "columns_present"] == 6
    assert "country" in quality.missing_columns(users, "users")
    with pytest.raises(ValueError, match="users lacks.*\n.*sessions lacks"):
        validate_minimum_columns(users.drop("signup_date"), sessions.drop("session_end"), events)


def test_reports_of_rows(clean):
    users, sessions, _, _ = clean
    events = _with_event(clean, event_time=moment("2025-01-01T08:59:59"), event_date=day("2025-01-02"))
    assert table(quality.session_gaps(events, sessions), "event_id", "gap_sec") == {("e9", -1.0)}
    assert quality.largest_session_gaps(events, sessions, 5).count() == 1
    assert table(quality.date_mismatches(events), "event_id") == {("e9",)}
    assert ("app_open", 2) in table(quality.value_counts(events, "event_name"))
    assert table(quality.row_counts({"users": users, "sessions": sessions})) == {("users", 2), ("sessions", 1)}


def test_distribution(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "x int")
    row = quality.distribution(df, "x", (0.5, 0.95)).first()
    assert (row["count"], row["mean"], row["min"], row["p50"], row["max"]) == (5, 3.0, 1.0, 3.0, 5.0)
    assert row["p95"] == pytest.approx(4.8) and row["std"] == pytest.approx(1.5811388)


def test_daily_pivots(clean):
    events = _with_event(clean, event_name="app_open")
    assert table(quality.event_counts_by_day(events)) == {(day("2025-01-01"), 2, 1, 1)}
    assert table(quality.event_users_by_day(events)) == {(day("2025-01-01"), 1, 1, 1)}
