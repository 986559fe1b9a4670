"""Tables of days folded by month give what windows over the days give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, table
from tidegauge.operators import lifecycle, months, streaks

DAYS = "date date, user_id bigint, signup_date date, is_active int"


@pytest.fixture(scope="module")
def dense(spark):
    """Users over 130 days from several signups on: rare, frequent, never and always active; one without an id."""
    draw = random.Random(3)
    start, rows = dt.date(2023, 12, 20), []
    for user, (late, share) in enumerate([(0, 0.02), (0, 0.5), (11, 0.9), (12, 0.0), (13, 1.0), (40, 0.08), (42, 0.3), (71, 0.03)]):
        for n in range(late, 130):
            rows.append((start + dt.timedelta(n), user or None, start + dt.timedelta(late), int(draw.random() < share)))
    return spark.createDataFrame(rows, DAYS)


def test_states_of_several_months(dense):
    plain = lifecycle.assign_lifecycle_state(dense)
    got = months.states_of_months(months.fold_months(dense))
    assert table(got, "date", "user_id", "lifecycle_state") == table(plain, "date", "user_id", "lifecycle_state")
    assert got.count() == dense.count()


def test_streaks_of_several_months(dense):
    got = months.streaks_of_months(months.fold_months(dense))
    assert table(got) == table(streaks.streak_by_day(dense)) and got.count() == dense.count()


def test_transitions_of_several_months(dense):
    states = lifecycle.assign_lifecycle_state(dense)
    assert table(months.transitions_of_months(months.fold_months(states))) == table(lifecycle.lifecycle_transitions(states))


def test_days_without_rows_are_passed_over(spark):
    rows = [(day(d), 1, day("2025-01-30"), a, s) for d, a, s in [
        ("2025-01-30", 1, "New"), ("2025-01-31", None, None), ("2025-03-01", 1, "Resurrected"), ("2025-03-16", 0, "AtRiskMAU"),
        ("2025-03-17", 0, "AtRiskMAU"), ("2025-03-31", 1, "Reactivated")]]
    sparse = spark.createDataFrame(rows, DAYS + ", lifecycle_state string")
    folded = months.fold_months(sparse)
    assert table(months.transitions_of_months(folded), "state", "next_state", "transitions") == {
        ("New", "Resurrected", 1), ("Resurrected", "AtRiskMAU", 1), ("AtRiskMAU", "AtRiskMAU", 1), ("AtRiskMAU", "Reactivated", 1)}
    assert table(months.streaks_of_months(folded)) == table(streaks.streak_by_day(sparse))
    nothing = months.fold_months(sparse.limit(0))
    for of in (months.states_of_months, months.streaks_of_months, months.transitions_of_months):
        assert of(nothing).count() == 0


def test_only_rows_of_months_are_shuffled(dense, tmp_path):
    states = lifecycle.assign_lifecycle_state(dense)
    states.write.parquet(str(tmp_path / "fact"))
    stored = dense.sparkSession.read.parquet(str(tmp_path / "fact"))
    for of in (months.states_of_months, months.streaks_of_months, months.transitions_of_months):
        plan = of(months.fold_months(stored))._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.rindex("Exchange"):].splitlines()[1:]
        assert "HashAggregate(keys=[user_id" in below[0] and "partial_bit_or" in below[0]
        assert "Sort" not in "".join(below) and "Window" not in "".join(below)
        ordered = [line for line in plan.splitlines() if " Sort " in line]
        assert ordered and all("date" not in line.replace("signup_date", "") for line in ordered)
