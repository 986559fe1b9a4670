from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.brute import DAY, START, calendar, random_days, state
from tests.conftest import day, table
from tidegauge.operators import fact, lifecycle

NAMES = ["New", "Current", "Reactivated", "Resurrected", "AtRiskWAU", "AtRiskMAU", "Dormant"]


def _frames(spark, people):
    users = spark.createDataFrame(
        [(u, s, "control" if u % 2 else "treatment") for u, (s, _) in people.items()],
        "user_id bigint, signup_date date, variant string",
    )
    events = spark.createDataFrame(
        [(u, d, "app_open") for u, (_, days) in people.items() for d in days],
        "user_id bigint, event_date date, event_name string",
    )
    return users, events


@pytest.mark.parametrize("seed,first,last", [
    (11, None, None), (12, "2025-01-20", "2025-03-10"), (13, None, "2025-06-30"), (14, "2025-03-25", None),
])
def test_counts_equal_the_window_definition(spark, seed, first, last):
    people = random_days(seed)
    users, events = _frames(spark, people)
    got = lifecycle.compute_lifecycle_counts(events, users, date_min=first, date_max=last)
    every = [d for s, days in people.values() for d in [s, *days]]
    lo, hi = day(first) if first else min(every), day(last) if last else max(every)
    counts = Counter(
        (t, state(t, s, days), "control" if u % 2 else "treatment")
        for u, (s, days) in people.items() for t in calendar(lo, hi) if s <= t
    )
    expected = {
        (t, name, counts[t, name, v], v)
        for t in calendar(lo, hi) for name in NAMES for v in ("control", "treatment")
    }
    assert got.columns == ["date", "state", "users", "variant"]
    assert table(got) == expected


def test_a_group_that_signs_up_later_still_reports_zeros(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-03-01", "treatment"))
    events = frames.events((1, "2025-01-01T10:00", "app_open", "control"))
    got = lifecycle.compute_lifecycle_counts(events, users, date_max="2025-01-02")
    assert got.count() == 2 * 2 * 7
    assert got.filter("variant = 'treatment'").agg(F.sum("users")).first()[0] == 0


def test_null_variant_keeps_its_users_but_matches_no_activity(frames):
    users = frames.users((1, "2025-01-01", None))
    events = frames.events((1, "2025-01-02T10:00", "app_open", None))
    got = lifecycle.compute_lifecycle_counts(events, users).filter("users > 0")
    assert table(got) == {(day("2025-01-01"), "New", 1, None), (day("2025-01-02"), "Dormant", 1, None)}


def test_event_variant_must_equal_the_user_variant(frames):
    users = frames.users((1, "2025-01-01", "control"))
    events = frames.events((1, "2025-01-02T10:00", "app_open", "treatment"))
    got = lifecycle.compute_lifecycle_counts(events, users).filter("users > 0")
    assert (day("2025-01-02"), "Dormant", 1, "control") in table(got)


def test_history_before_signup_counts_here_but_not_in_the_fact(frames):
    users = frames.users((1, "2025-01-10", "control"))
    events = frames.full_events(
        ("a", 1, "2025-01-09T10:00", "app_open", 0, 0, 0, False, "control"),
        ("b", 1, "2025-01-11T10:00", "app_open", 0, 0, 0, False, "control"),
    )
    counts = lifecycle.compute_lifecycle_counts(events, users).filter("users > 0")
    assert (day("2025-01-11"), "Current", 1, "control") in table(counts)
    built = fact.build_fact_user_daily(users, events, frames.sessions())
    assert table(built, "date", "lifecycle_state") == {
        (day("2025-01-10"), "New"), (day("2025-01-11"), "Resurrected")
    }


def test_reversed_ranges_fail(frames):
    users = frames.users((1, "2025-01-10", "control"))
    events = frames.events((1, "2025-01-10T10:00", "app_open", "control"))
    with pytest.raises(ValueError, match="lies after the last day"):
        lifecycle.compute_lifecycle_counts(events, users, date_min="2025-02-01", date_max="2025-01-01")
    with pytest.raises(Exception, match="lies after the last day"):
        lifecycle.compute_lifecycle_counts(events, users, date_min="2025-02-01").collect()


def test_duplicate_users_count_once_with_the_earliest_signup(frames):
    users = frames.users((1, "2025-01-03", "control"), (1, "2025-01-01", "control"))
    events = frames.events((1, "2025-01-01T10:00", "app_open", "control"))
    got = lifecycle.compute_lifecycle_counts(events, users, date_max="2025-01-03").filter("users > 0")
    assert table(got, "date", "state") == {
        (day("2025-01-01"), "New"), (day("2025-01-02"), "AtRiskWAU"), (day("2025-01-03"), "AtRiskWAU")
    }


@pytest.mark.parametrize("gap,active,quiet", [
    (6, "Current", "AtRiskWAU"), (7, "Current", "AtRiskMAU"), (8, "Reactivated", "AtRiskMAU"),
    (29, "Reactivated", "AtRiskMAU"), (30, "Reactivated", "Dormant"), (31, "Resurrected", "Dormant"),
])
def test_edges(spark, gap, active, quiet):
    row = spark.range(1).select(
        lifecycle.returning_state(F.lit(gap)), lifecycle.lapsing_state(F.lit(gap))
    ).first()
    assert tuple(row) == (active, quiet)


def test_assigned_from_the_fact_equals_the_definition(spark):
    people = random_days(21)
    rows = [
        (u, t, s, int(t in days))
        for u, (s, days) in people.items() for t in calendar(s, START + DAY * 130)
    ]
    table_in = spark.createDataFrame(rows, "user_id bigint, date date, signup_date date, is_active int")
    got = lifecycle.assign_lifecycle_state(table_in)
    expected = {
        (u, t, state(t, s, {d for d in days if d >= s}))
        for u, (s, days) in people.items() for t in calendar(s, START + DAY * 130)
    }
    assert table(got, "user_id", "date", "lifecycle_state") == expected


def test_daily_aggregate_and_transitions(spark):
    rows = [
        (day("2025-01-01"), 1, "New", "control"), (day("2025-01-02"), 1, "Current", "control"),
        (day("2025-01-03"), 1, "AtRiskWAU", "control"), (day("2025-01-01"), 2, "New", "control"),
        (day("2025-01-02"), 2, "AtRiskWAU", "control"), (day("2025-01-03"), 2, "AtRiskWAU", None),
    ]
    built = spark.createDataFrame(rows, "date date, user_id bigint, lifecycle_state string, variant string")
    daily = lifecycle.build_agg_lifecycle_daily(built)
    assert daily.columns == ["date", "state", "variant", "users"]
    assert (day("2025-01-01"), "New", "control", 2) in table(daily)
    assert daily.filter("date = '2025-01-03'").count() == 1
    slow = lifecycle.build_agg_lifecycle_daily(built, unique_grain=False)
    assert table(daily) == table(slow)
    assert table(lifecycle.lifecycle_transitions(built)) == {
        ("New", "Current", 1, 0.5), ("New", "AtRiskWAU", 1, 0.5), ("Current", "AtRiskWAU", 1, 1.0),
        ("AtRiskWAU", "AtRiskWAU", 1, 1.0),
    }


@pytest.mark.parametrize("seed,first", [(31, None), (32, "2025-02-10")])
def test_transitions_from_spans_equal_those_of_the_fact(spark, seed, first):
    people = random_days(seed)
    users, events = _frames(spark, people)
    got = lifecycle.compute_lifecycle_transitions(
        events, users, group_cols=["variant"], date_min=first, date_max="2025-05-31"
    )
    lo, counts = day(first) if first else START, Counter()
    for u, (s, days) in people.items():
        start = max(s, lo)
        seen = {d for d in days if d >= start}
        states = [state(t, s, seen) for t in calendar(start, day("2025-05-31"))]
        counts.update(("control" if u % 2 else "treatment", *pair) for pair in zip(states, states[1:]))
    assert got.columns == ["variant", "state", "next_state", "transitions", "probability"]
    assert table(got.drop("probability")) == {(*pair, n) for pair, n in counts.items()}
    sums = got.groupBy("variant", "state").agg(F.round(F.sum("probability"), 9).alias("p"))
    assert table(sums, "p") == {(1.0,)}


def test_users_without_any_event(frames):
    users = frames.users((1, "2025-01-01", "control"), (2, "2025-01-03", "control"))
    got = lifecycle.compute_lifecycle_counts(frames.events(), users).filter("users > 0")
    assert table(got, "date", "state", "users") == {
        (day("2025-01-01"), "New", 1), (day("2025-01-02"), "Dormant", 1),
        (day("2025-01-03"), "Dormant", 1), (day("2025-01-03"), "New", 1),
    }
