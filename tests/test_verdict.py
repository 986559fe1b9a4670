"""Rows that were once lost or counted twice, and plans that once built the users-by-days table."""

import csv
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, table
from tidegauge.operators import experiment, fact, kpis, lifecycle, quality, sparse
from tidegauge.plans import build_tables
from tidegauge.sources.files import arranged


def test_arms_keep_every_user_and_refuse_null_dates(spark):
    rows = [(i, day("2024-01-01")) for i in range(9)] + [(9, None)]
    users = spark.createDataFrame(rows, "user_id bigint, signup_date date")
    good = experiment.assign_variant(users.dropna())
    assert good.count() == 9 and good.filter("variant = 'control'").count() == 4
    with pytest.raises(Exception, match="Not a calendar day"):
        experiment.assign_variant(users).collect()


def test_a_user_listed_twice_signs_up_once(frames):
    users = frames.users((1, "2024-01-01", "control"), (1, "2024-01-05", "control"), (2, "2024-01-05", "treatment"))
    assert table(kpis.daily_signups(users), "date", "signups") == {(day("2024-01-01"), 1), (day("2024-01-05"), 1)}
    assert table(experiment.signup_share(users), "date", "control", "treatment") == {
        (day("2024-01-01"), 1, 0), (day("2024-01-05"), 0, 1)}


@pytest.mark.parametrize("missing", [None, "", "  "])
def test_events_without_a_session_have_no_order(spark, missing):
    rows = [(1, missing, "2024-01-01 10:00:00", "lesson_completed"), (1, missing, "2024-03-01 10:00:00", "lesson_started")]
    events = spark.createDataFrame(rows, "user_id bigint, session_id string, t string, event_name string").withColumn(
        "event_time", F.col("t").cast("timestamp_ntz"))
    assert quality.lesson_order_violations(events).count() == 0


def test_a_repeated_fact_row_counts_its_user_once(spark):
    row = (day("2024-01-01"), 1, "control", "New")
    rows = spark.createDataFrame([row, row], "date date, user_id bigint, variant string, lifecycle_state string")
    assert table(lifecycle.build_agg_lifecycle_daily(rows), "users") == {(1,)}


def test_the_last_event_of_a_day_by_time_and_then_id(spark):
    rows = [
        (5, "2024-01-01 10:00:00", 1, True), (9, "2024-01-01 09:00:00", 2, False), (7, "2024-01-01 10:00:00", None, None),
        (-3, "1969-01-02 10:00:00", 4, True), (-9, "1969-01-02 10:00:00", 5, False), (1, "2024-01-03 10:00:00", 6, True),
        (0, None, 8, False)]
    events = spark.createDataFrame(rows, "event_id bigint, t string, streak_length int, is_premium boolean").select(
        "event_id", F.lit(1).alias("user_id"), F.col("t").cast("timestamp_ntz").alias("event_time"),
        F.coalesce(F.to_date("t"), F.lit("2024-01-03").cast("date")).alias("event_date"), F.lit("x").alias("event_name"),
        F.lit(0).alias("xp_delta"), F.lit(0).alias("hearts_delta"), "streak_length", "is_premium")
    columns = ["date", "streak_length_end_of_day", "is_premium"]
    numbered = fact.daily_event_features(events)
    named = fact.daily_event_features(events.withColumn("event_id", F.format_string("%05d", F.col("event_id") + 100)))
    assert table(numbered, *columns) == table(named, *columns) == {
        (day("2024-01-01"), None, None), (day("1969-01-02"), 4, True), (day("2024-01-03"), 8, False)}
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_guardrails_read_the_events_once(product, tmp_path, spark):
    users, events, sessions = product
    path = str(tmp_path / "events")
    events.write.parquet(path)
    out = experiment.guardrails(sessions, spark.read.parquet(path), users)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert out.count() > 0


@pytest.fixture
def product(frames):
    users = frames.users((1, "2024-01-01", "control", True), (2, "2024-01-03", "treatment"), (3, "2024-01-02", "control"))
    events = frames.full_events(
        ("a", 1, "2024-01-01 10:00:00", "app_open", 0, 0, 1, True, "control"),
        ("b", 1, "2024-01-20 10:00:00", "lesson_completed", 5, -1, 2, False, "control"),
        ("c", 2, "2024-02-25 10:00:00", "lesson_started", 0, -2, 0, True, "treatment"),
        ("d", 2, "2024-02-25 10:00:00", "streak_updated", 0, 0, 7, None, "treatment"),
        ("e", 9, "2024-03-25 10:00:00", "app_open", 0, 0, 7, None, "treatment"))
    sessions = frames.sessions(("s1", 1, "2024-01-01 10:00:00", "2024-01-01 10:05:00"), ("s2", 3, "2024-03-01 10:00:00", "2024-03-01 10:01:00"))
    return users, events, sessions


@pytest.mark.parametrize("bounds", [{}, {"date_min": "2024-01-10"}, {"date_max": "2024-02-01"},
                                    {"date_min": "2024-01-10", "date_max": "2024-02-27"}])
@pytest.mark.parametrize("keys", [("variant",), ()])
def test_sparse_forms_equal_the_fact_forms(product, bounds, keys):
    users, events, sessions = product
    built = fact.build_fact_user_daily(users, events, sessions, **bounds)
    tables = build_tables.build_dashboard_tables(users, events, sessions, group_cols=keys, **bounds)
    assert table(tables["fact_user_daily"]) == table(built)
    dense = kpis.build_agg_daily_kpis(built, users, events, group_cols=keys)
    assert table(tables["agg_daily_kpis"], *dense.columns) == table(dense)
    states = lifecycle.build_agg_lifecycle_daily(built, group_cols=keys)
    assert table(tables["agg_lifecycle_daily"], *states.columns) == table(states)
    days = sparse.daily_sums(fact.busy_spans(users, events, sessions, **bounds), ())
    report = lifecycle.decomposition_report(built)
    all_states = lifecycle.build_agg_lifecycle_daily(built, group_cols=())
    assert table(sparse.decomposition_of_days(days, all_states), *report.columns) == table(report)


def test_spans_cut_by_month_give_the_same_fact(product):
    spans = fact.busy_spans(*product)
    assert table(fact.fact_of_spans(fact.spans_by_month(spans))) == table(fact.fact_of_spans(spans))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _generates_days_below_aggregates(df):
    """Whether days are exploded from a span below an aggregation: the running totals explode after it."""
    lines = _plan(df).splitlines()
    depth = lambda line: len(re.match(r"[\s:+\-|]*", line)[0])
    found = []
    for i, line in enumerate(lines):
        if "Generate explode(sequence(" in line and "from_day" in line:
            found.append(any("Aggregate" in up and depth(up) < depth(line) for up in lines[:i]))
    return any(found)


def test_aggregates_do_not_build_the_dense_table(product):
    users, events, sessions = product
    tables = build_tables.build_dashboard_tables(users, events, sessions)
    days = sparse.daily_sums(fact.busy_spans(users, events, sessions))
    lift = experiment.kpi_lift(tables["agg_daily_kpis"], tables["agg_retention_cohort"], days)
    for df in (tables["agg_daily_kpis"], tables["agg_lifecycle_daily"], days, lift,
               sparse.streak_metrics_of_days(days), sparse.hearts_of_days(days)):
        assert not _generates_days_below_aggregates(df)
    dense = fact.build_fact_user_daily(users, events, sessions).groupBy("date").count()
    assert _generates_days_below_aggregates(dense)


def test_the_fact_is_written_without_shuffling_its_dense_rows(product):
    written = arranged(fact.fact_of_spans(fact.spans_by_month(fact.busy_spans(*product))), "date", balanced=True)
    plan = written._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("explode(sequence(from_day")]
    assert "Exchange" not in above and "Exchange" in plan


def test_bounds_read_only_the_days_that_can_matter(product, tmp_path, spark):
    users, events, sessions = product
    path = str(tmp_path / "events")
    events.write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    for bounds in ({"date_min": "2024-01-10"}, {"date_max": "2024-02-01"}):
        plan = lifecycle.compute_lifecycle_counts(stored, users, **bounds)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
        assert scans and all("event_date" in s for s in scans)
    plan = fact.build_fact_user_daily(users, stored, sessions, date_min="2024-01-10")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert scans and all("event_date" in s for s in scans)


def test_the_last_day_reads_each_table_once(product, tmp_path, spark):
    stored = []
    for name, df in zip(("users", "events", "sessions"), product):
        df.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    latest = spark.range(1).select(fact.last_fact_day(*stored).alias("day"))
    plan = _plan(latest)
    assert len(re.findall("Relation ", plan)) == 3 and len(re.findall("Join ", plan)) == 1, plan
    assert table(latest) == {(day("2024-03-01"),)}  # the event of an unknown user is later
    quiet = spark.range(1).select(fact.last_fact_day(stored[0], *[df.limit(0) for df in stored[1:]]).alias("day"))
    assert table(quiet) == {(day("2024-01-03"),)}


@pytest.fixture
def published(spark):
    """Published daily tables by their columns, from a folder named by GOLDEN_TABLES."""
    folder, found = os.environ.get("GOLDEN_TABLES"), {}
    for path in sorted(glob.glob(f"{folder}/*.csv")) if folder else ():
        with open(path, newline="") as lines:
            rows = list(csv.DictReader(lines))
        found.setdefault(tuple(rows[0]), rows)
    arms, summary = ("event_date", "control", "treatment"), ("metric", "control", "treatment", "diff_pct", "window")
    if arms not in found or summary not in found:
        pytest.skip("no published tables")
    daily = spark.createDataFrame(
        [(day(r["event_date"]), int(r["control"]), int(r["treatment"])) for r in found[arms]],
        "date date, control bigint, treatment bigint")
    return daily, found[summary]


def test_published_numbers(published):
    daily, summary = published
    want = {(r["window"], float(r["control"]), float(r["treatment"]), float(r["diff_pct"])) for r in summary if r["metric"] == "dau"}
    got = experiment.pre_post_summary({"dau": daily}, "2025-04-01")
    assert table(got, "window", "control", "treatment", "diff_pct") == want
    row = experiment.aa_check(daily, "2025-04-01").collect()[0]
    assert row["days"] == 82 and not (row["mean_ok"] or row["gap_ok"] or row["corr_ok"] or row["passed"])
