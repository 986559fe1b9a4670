import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, moment, table
from tidegauge.operators import engagement, funnel, prepare, retention


@pytest.fixture(scope="module")
def cohort(frames):
    users = frames.users(
        (1, "2025-01-01", "control"), (2, "2025-01-01", "control"), (3, "2025-01-01", "treatment"),
        (4, "2025-01-08", "control"), (5, "2025-01-01", None),
    )
    events = frames.events(
        (1, "2025-01-02T10:00", "app_open", "control"), (1, "2025-01-02T11:00", "app_open", "control"),
        (2, "2025-01-03T10:00", "app_open", "control"), (3, "2025-01-02T10:00", "app_open", "control"),
        (4, "2025-01-08T10:00", "app_open", "control"), (5, "2025-01-02T10:00", "app_open", None),
        (1, "2025-01-20T10:00", "push_received", "control"),
    )
    return users, events


def test_retention_by_variant_drops_pairs_past_the_last_active_day(cohort):
    got = retention.compute_retention(*cohort, [1, 7])
    assert got.columns == ["cohort_date", "variant", "retained_users", "day_n", "cohort_size", "retention_rate"]
    # User 3 was active under another variant than its own, so it does not count as retained.
    assert table(got) == {
        (day("2025-01-01"), "control", 1, 1, 2, 0.5), (day("2025-01-01"), "treatment", 0, 1, 1, 0.0),
        (day("2025-01-01"), "control", 0, 7, 2, 0.0), (day("2025-01-01"), "treatment", 0, 7, 1, 0.0),
    }


def test_retention_with_incomplete_pairs_and_one_horizon(cohort):
    got = retention.compute_retention(*cohort, 1, by_variant=False, drop_incomplete=False)
    assert table(got) == {
        (day("2025-01-01"), 3, 1, 4, 0.75, True), (day("2025-01-08"), 0, 1, 1, 0.0, False)
    }


def test_retention_without_active_events_is_empty(frames, cohort):
    events = frames.events((1, "2025-01-02T10:00", "push_received", "control"))
    for drop in (True, False):
        got = retention.compute_retention(cohort[0], events, drop_incomplete=drop)
        assert got.count() == 0 and "retention_rate" in got.columns


def test_two_event_variants_on_one_day_do_not_inflate(frames):
    users = frames.users((1, "2025-01-01", "control"))
    events = frames.events(
        (1, "2025-01-02T10:00", "app_open", "control"), (1, "2025-01-02T11:00", "app_open", "treatment")
    )
    got = retention.compute_retention(users, events, 1, by_variant=False)
    assert table(got, "retained_users", "cohort_size") == {(1, 1)}


def test_events_are_shuffled_once_for_retention(spark, cohort, tmp_path):
    """The probes meet the distinct user-days in the partitioning these already have."""
    users, events = cohort
    path = str(tmp_path / "events")
    events.write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = retention.compute_retention(users, spark.read.parquet(path), [1, 7], drop_incomplete=False)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The right side of the join comes last: the user-days of the events.
    right = plan[plan.rindex("Sort [user_id"):]
    assert right.count("FileScan parquet") == 1 and right.count("Exchange") == 1


def test_funnel_by_date(frames):
    events = frames.events(
        (1, "2025-01-01T10:00", "signup", "control"), (1, "2025-01-01T10:01", "app_open", "control"),
        (2, "2025-01-01T10:00", "app_open", "control"), (2, "2025-01-01T11:00", "app_open", "control"),
        (2, "2025-01-02T10:00", "lesson_completed", "control"), (3, "2025-01-03T10:00", "app_open", None),
        (3, "2025-01-04T10:00", "push_received", "control"),
    )
    got = funnel.compute_lesson_funnel(events, by="date")
    assert table(got) == {
        (day("2025-01-01"), "control", 1, 2, 0, 0, 2.0, 0.0, 0.0),
        (day("2025-01-02"), "control", 0, 0, 0, 1, 0.0, 0.0, 0.0),
    }
    assert got.columns[-1] == "cr_lesson_completed_given_lesson_started"
    # Keys the events lack are ignored.
    assert funnel.compute_lesson_funnel(events, by="date", group_cols=["country"]).columns[0:2] == ["date", "n_signup"]


def test_funnel_by_cohort(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "control"), (3, "2025-01-02", "control"))
    events = frames.events(
        (1, "2025-01-01T10:00", "app_open", "control"), (1, "2025-02-01T10:00", "lesson_started", "control"),
        (2, "2025-01-01T10:00", "app_open", "treatment"),
    )
    got = funnel.compute_lesson_funnel(events, users=users)
    assert table(got) == {
        (day("2025-01-01"), "control", 2, 1, 1, 0, 0.5, 1.0, 0.0),
        (day("2025-01-02"), "control", 1, 0, 0, 0, 0.0, 0.0, 0.0),
    }
    with pytest.raises(ValueError, match="users"):
        funnel.compute_lesson_funnel(events)
    with pytest.raises(ValueError, match="by date or by cohort"):
        funnel.compute_lesson_funnel(events, by="week")


def test_sessions_per_user(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"))
    sessions = frames.sessions(
        ("s1", 1, "2025-01-01T10:00", "2025-01-01T10:10"), ("s2", 1, "2025-01-01T12:00", "2025-01-01T12:10"),
        ("s3", 2, "2025-01-02T10:00", "2025-01-02T10:10"),
    )
    events = frames.events((1, "2025-01-01T10:00", "app_open", "control"), (2, "2025-01-03T10:00", "app_open", "treatment"))
    got = engagement.compute_sessions_per_user(sessions, events, users)
    assert got.columns == ["date", "variant", "sessions", "active_users", "sessions_per_user"]
    assert table(got) == {
        (day("2025-01-01"), "control", 2, 1, 2.0), (day("2025-01-02"), "treatment", 1, 0, 0.0),
        (day("2025-01-03"), "treatment", 0, 1, 0.0),
    }
    own = engagement.compute_sessions_per_user(sessions, group_cols=None, active_user_source="sessions")
    assert table(own) == {(day("2025-01-01"), 2, 1, 2.0), (day("2025-01-02"), 1, 1, 1.0)}
    with pytest.raises(ValueError, match="takes the events table"):
        engagement.compute_sessions_per_user(sessions, users=users)
    with pytest.raises(ValueError, match="events or sessions"):
        engagement.compute_sessions_per_user(sessions, events, users, active_user_source="clicks")
    with pytest.raises(ValueError, match="without a users table"):
        engagement.compute_sessions_per_user(sessions, events)


def _sessions_by_loop(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][-1] <= gap:
            out[-1].append(t)
        else:
            out.append([t])
    return [(s[0], s[-1], len(s)) for s in out]


def test_sessions_from_events_equal_the_loop(spark):
    rng = random.Random(7)
    start, gap = moment("2025-01-01T00:00"), dt.timedelta(minutes=30)
    rows, expected = [], set()
    for user in range(20):
        t, times = start, []
        for _ in range(rng.randrange(1, 60)):
            t += rng.choice([dt.timedelta(minutes=30), dt.timedelta(minutes=30, microseconds=1),
                             dt.timedelta(seconds=rng.randrange(0, 5000))])
            times.append(t)
        rows += [(user, x) for x in times]
        expected |= {(user, i + 1, *s) for i, s in enumerate(_sessions_by_loop(times, gap))}
    events = spark.createDataFrame(rows, "user_id bigint, event_time timestamp_ntz")
    got = engagement.sessions_from_events(events, gap="30 minutes")
    rows = {
        (r.user_id, int(r.session_id.split("-")[1]), r.session_start, r.session_end, r.events)
        for r in got.collect()
    }
    assert rows == expected
    named = engagement.assign_sessions(events, gap="30 minutes")
    assert named.count() == events.count()
    sizes = named.groupBy("session_id").agg(F.count("*").alias("n"))
    assert table(sizes, "session_id", "n") == table(got, "session_id", "events")


def test_events_without_user_or_time_are_kept_without_a_session(spark):
    rows = [(1, moment("2025-01-01T10:00")), (None, moment("2025-01-01T10:00")), (1, None)]
    events = spark.createDataFrame(rows, "user_id bigint, event_time timestamp_ntz")
    assert table(engagement.assign_sessions(events), "session_id") == {("1-1",), (None,)}
    assert engagement.assign_sessions(events).count() == 3
    assert engagement.sessions_from_events(events).count() == 1


def test_filters(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-01", "treatment"))
    events = frames.events(
        (1, "2025-01-01T10:00", "app_open", "control"), (2, "2025-01-02T10:00", "app_open", "treatment"),
        (2, "2025-01-03T10:00", "app_open", "treatment"),
    ).withColumnRenamed("event_date", "date")
    assert prepare.filter_segment(events, date_from="2025-01-02", date_to="2025-01-02").count() == 1
    picked = prepare.filter_segment(events.drop("variant"), users, variant=["treatment"])
    assert table(picked, "user_id") == {(2,)}
    with pytest.raises(ValueError, match="takes a users table"):
        prepare.filter_segment(events.drop("variant"), variant="control")
    assert prepare.known_users_only(events, users.filter("user_id = 1")).count() == 1
    window = events.filter(prepare.in_window(F.col("date"), "2025-01-01", "2025-01-02"))
    assert table(window, "user_id") == {(1,)}
    assert prepare.ordered(events.select("date", "user_id"), "user_id").first()[1] == 1


def test_prepare_columns(frames, spark):
    events = frames.events((1, "2025-01-01T23:59", "app_open", "control"), (1, "2025-01-02T00:00", None, "control"))
    by_time = prepare.prep_events(events.drop("event_date"))
    assert table(by_time, "event_date", "is_active_event") == {(day("2025-01-01"), True), (day("2025-01-02"), False)}
    shifted = prepare.prep_events(events.withColumn("event_date", F.lit("2024-12-31")))
    assert table(shifted, "event_date") == {(day("2024-12-31"),)}  # its own column wins
    with pytest.raises(ValueError, match="event_date, event_time is needed"):
        prepare.prep_events(events.drop("event_date", "event_time"))
    with pytest.raises(ValueError, match="session_date, session_start is needed"):
        prepare.prep_sessions(events.select("user_id"))
    with pytest.raises(ValueError, match="no column"):
        prepare.prep_events(events.drop("event_name"))
    assert prepare.prep_events(events.drop("event_date", "event_time"), ensure_event_date=False).count() == 2
    blank = prepare.empty_text(spark.createDataFrame([(None,)], "session_id string"), ["session_id", "lesson_id"])
    assert table(blank) == {("",)}
