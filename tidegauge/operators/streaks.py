"""Runs of consecutive active days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.operators.prepare import active_user_days


def streak_runs(
    events: DataFrame, *, active_event_names: Sequence[str] | None = None
) -> DataFrame:
    """user_id, streak_start, streak_end, streak_length. The day minus its rank is the same for all
    days of a run; a user has at most one row per calendar day."""
    days = active_user_days(events, active_event_names=active_event_names)
    per_user = W.partitionBy("user_id").orderBy("date")
    run = F.date_sub("date", F.row_number().over(per_user))
    return (
        days.withColumn("run", run)
        .groupBy("user_id", "run")
        .agg(
            F.min("date").alias("streak_start"),
            F.max("date").alias("streak_end"),
            F.count(F.lit(1)).alias("streak_length"),
        )
        .drop("run")
    )


def streak_by_day(fact_user_daily: DataFrame) -> DataFrame:
    """date, user_id, streak_length: one more on each consecutive active day, 0 on a quiet day."""
    require_columns(fact_user_daily, ["date", "user_id", "is_active"], "fact_user_daily")
    per_user = W.partitionBy("user_id").orderBy("date")
    so_far = per_user.rowsBetween(W.unboundedPreceding, W.currentRow)
    quiet = F.when(F.col("is_active") == 0, F.col("date"))
    since = F.coalesce(
        F.last(quiet, ignorenulls=True).over(so_far),
        F.date_sub(F.first("date").over(so_far), 1),
    )
    return fact_user_daily.select(
        "date", "user_id", F.datediff("date", since).cast("bigint").alias("streak_length")
    )
