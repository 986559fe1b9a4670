"""One user with a third of all rows: joins of raw rows are split, everything else is reduced first."""

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import engagement, quality
from tidegauge.operators.prepare import prep_sessions, with_user_columns

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "12",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}
ROWS = 300_000


@pytest.fixture
def skewed(spark):
    """Settings under which the small data counts as skewed, and events with a hot user and slot."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    start = F.lit("2025-01-01").cast("timestamp_ntz")
    events = spark.range(0, ROWS, 1, 6).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("user_id"),
        F.timestamp_add("SECOND", F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(F.col("id")), start).alias("event_time"),
    )
    yield events
    for key, value in before.items():
        spark.conf.set(key, value)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_join_of_raw_events_with_users_is_split(spark, skewed):
    users = spark.range(5000).select(F.col("id").alias("user_id"), F.lit("control").alias("variant"))
    joined = quality.with_user_lookup(skewed, users).agg(F.count("u_known").alias("n"), F.max("event_time"))
    assert "skew=true" in _final_plan(joined) and joined.first()["n"] == ROWS


def test_a_hot_slot_is_split_when_events_get_their_session(skewed):
    named = engagement.assign_sessions(skewed).agg(F.count("session_id").alias("n"), F.max("event_id"))
    assert "skew=true" in _final_plan(named) and named.first()["n"] == ROWS


def test_slots_of_a_hot_user_are_reduced_before_the_window(skewed):
    starts = engagement._session_starts(skewed, "30 minutes", "event_time")
    assert starts.filter("user_id = 0").count() < 300
    assert starts.agg(F.sum("events")).first()[0] == ROWS


def test_events_of_a_hot_session_are_split(spark, skewed):
    events = skewed.withColumn("session_id", F.col("user_id").cast("string"))
    start = F.lit("2025-01-01").cast("timestamp_ntz")
    sessions = spark.range(5000).select(
        F.col("id").cast("string").alias("session_id"), start.alias("session_start"), start.alias("session_end"))
    met = quality.events_with_window(events, sessions).agg(F.count("session_start").alias("n"), F.max("event_time"))
    assert "skew=true" in _final_plan(met) and met.first()["n"] == ROWS


def test_sessions_of_a_hot_user_are_split_when_keys_are_joined(spark, skewed):
    sessions = skewed.select(
        F.col("event_id").cast("string").alias("session_id"), "user_id", F.col("event_time").alias("session_start"))
    users = spark.range(5000).select(F.col("id").alias("user_id"), F.lit("control").alias("variant"))
    keyed = with_user_columns(prep_sessions(sessions), users, ["variant"], "sessions").agg(
        F.count("variant").alias("n"), F.max("session_id"), F.max("session_start"))
    assert "skew=true" in _final_plan(keyed) and keyed.first()["n"] == ROWS


def test_facts_of_a_hot_user_are_split_against_signups(spark, skewed):
    later = F.lit("2030-01-01").cast("timestamp_ntz")
    users = spark.range(5000).select(F.col("id").alias("user_id"), later.alias("signup_time"))
    early = quality.before_signup(skewed, users, "event_time").agg(F.count("event_id").alias("n"), F.max("event_time"))
    assert "skew=true" in _final_plan(early) and early.first()["n"] == ROWS
