"""The daily KPI table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions.scalars import divide_or_null, safe_divide, strict_date
from tidegauge.operators.activity import compute_active_users
from tidegauge.operators.prepare import group_keys, unique_users, with_user_columns


def daily_signups(users: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """date, keys, signups; a user counts once, on the earliest signup. Null keys are dropped."""
    members = unique_users(users, list(keys))
    if keys:
        members = members.dropna(subset=list(keys))
    return members.groupBy(F.col("signup_date").alias("date"), *keys).agg(F.count("user_id").alias("signups"))


def build_agg_daily_kpis(
    fact_user_daily: DataFrame,
    users: DataFrame,
    events: DataFrame,
    *,
    group_cols: Sequence[str] | None = ("variant",),
    active_event_names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per fact date and key: signups, active users, sessions, lessons, xp and premium.

    DAU, WAU and MAU come from one pass over the events; after a group's last active day they are 0.
    `avg_session_duration_sec` is the mean of the user-day totals, quiet days included.
    """
    keys = group_keys(group_cols)
    fact = with_user_columns(fact_user_daily, users, keys, "fact_user_daily")
    fact = fact.withColumn("date", strict_date(F.col("date"), "date"))
    if keys:
        fact = fact.dropna(subset=keys)
    daily = fact.groupBy("date", *keys).agg(
        F.sum("sessions_count").alias("sessions"),
        F.avg("session_duration_sec").alias("avg_session_duration_sec"),
        F.sum("lessons_completed").alias("lessons_completed"),
        F.sum("xp_earned").alias("xp_earned"),
        F.sum(F.col("is_premium").cast("bigint")).alias("premium_users"),
        F.sum(F.col("is_active").cast("bigint")).alias("active_users"),
    )
    return _with_actives(daily, users, events, keys, active_event_names)


def agg_daily_kpis_of_days(
    daily: DataFrame,
    users: DataFrame,
    events: DataFrame,
    *,
    group_cols: Sequence[str] | None = ("variant",),
    active_event_names: Sequence[str] | None = None,
) -> DataFrame:
    """The same table from daily sums (`sparse.daily_sums`): the users-by-days table is not built."""
    renamed = daily.select(
        "date", *group_keys(group_cols), F.col("sessions_count").alias("sessions"),
        divide_or_null(F.col("session_duration_sec"), F.col("user_days")).alias("avg_session_duration_sec"),
        "lessons_completed", "xp_earned", "premium_users", "active_users",
    )
    return _with_actives(renamed, users, events, group_keys(group_cols), active_event_names)


def _with_actives(daily, users, events, keys, active_event_names) -> DataFrame:
    """Signups, active users and ratios beside the daily sums."""
    signup_keys = [k for k in keys if k in users.columns]
    active = compute_active_users(
        events, active_event_names=active_event_names, group_cols=keys, users=users
    )
    joined = (
        daily.join(daily_signups(users, signup_keys), ["date", *signup_keys], "left")
        .join(active, ["date", *keys], "left")
        .fillna(0, subset=["signups", "dau", "wau", "mau"])
    )

    def per_active(column):
        return safe_divide(F.col(column), F.col("active_users"))

    return joined.select(
        "date", *keys, "signups", "dau", "wau", "mau",
        safe_divide(F.col("dau"), F.col("mau")).alias("dau_mau_ratio"),
        "sessions", "avg_session_duration_sec",
        per_active("sessions").alias("sessions_per_active_user"),
        "lessons_completed", per_active("lessons_completed").alias("lessons_per_active_user"),
        "xp_earned", per_active("xp_earned").alias("xp_per_active_user"),
        "premium_users", per_active("premium_users").alias("premium_share"),
    )
