"""Telemetry tables derived from the test data set, in the layout of `tidegauge.schemas`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.operators.engagement import assign_sessions, sessions_from_events

# How the event types of the test data stand for product events.
EVENT_NAMES = {
    "view": "app_open",
    "click": "lesson_started",
    "purchase": "lesson_completed",
    "signup": "signup",
    "error": "question_answered",
}
SESSION_GAP = "4 hours"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _variant(user_id):
    return F.when(user_id % 2 == 0, "control").otherwise("treatment")


def product_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    name = F.lit(None).cast("string")
    for event_type, event_name in EVENT_NAMES.items():
        name = F.when(kind == event_type, event_name).otherwise(name)
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        name.alias("event_name"),
        F.when(kind == "purchase", F.floor("value")).otherwise(0).cast("int").alias("xp_delta"),
        F.when(kind == "error", -1).otherwise(0).alias("hearts_delta"),
        k.alias("streak_length"),
        (k >= 90).alias("is_premium"),
        _variant(F.col("user_id")).alias("variant"),
    )


def product_users(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Users are the customers with a `signup` event; the first one is their signup."""
    first = (
        events.filter(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(F.min("ts").alias("signup_time"))
    )
    names = nation.select("n_nationkey", F.col("n_name").alias("country"))
    people = customer.join(names, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("signup_channel"), "country"
    )
    return first.join(people, "user_id", "left").select(
        "user_id",
        F.to_date("signup_time").alias("signup_date"),
        "signup_time",
        "signup_channel",
        "country",
        F.lit(False).alias("is_premium_at_signup"),
        _variant(F.col("user_id")).alias("variant"),
    )


def product_lessons(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("lesson_id"), F.col("p_brand").alias("unit_id"),
        F.col("p_type").alias("skill"), F.col("p_size").alias("difficulty"), F.col("p_name").alias("topic"),
        F.lit(120).alias("expected_duration_sec"), F.lit(10).alias("expected_xp"),
    )


def product_sessions(product_events: DataFrame) -> DataFrame:
    return sessions_from_events(product_events, gap=SESSION_GAP).drop("events")


def events_in_sessions(product_events: DataFrame) -> DataFrame:
    return assign_sessions(product_events, gap=SESSION_GAP)


def order_events(orders: DataFrame) -> DataFrame:
    """Orders as events: every order status counts as activity."""
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderstatus").alias("event_name"),
    )


def order_users(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Customers with an order; the day of the first one is their signup."""
    first = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.to_date(F.min("o_orderdate")).alias("signup_date")
    )
    people = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return first.join(people, "user_id", "left")


ORDER_EVENTS = ["F", "O", "P"]
