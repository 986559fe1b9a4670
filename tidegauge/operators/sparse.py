"""Daily sums of the fact table from its busy days, without the users-by-days table.

A quiet day adds nothing to a sum, one to the user-days, and the signup status to the premium users. So
sums come from the busy days, and the other two from running totals over the ends of the spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions.scalars import divide_or_null
from tidegauge.operators.activity import running_totals
from tidegauge.operators.lifecycle import STATES, compute_lifecycle_counts
from tidegauge.operators.prepare import group_keys
from tidegauge.schemas import ACTIVE_STATES

MEASURES = [
    "sessions_count", "session_duration_sec", "lessons_completed", "xp_earned", "hearts_lost",
    "streak_length_end_of_day",
]


def daily_sums(spans: DataFrame, group_cols: Sequence[str] | None = ("variant",)) -> DataFrame:
    """date, keys, user_days, premium_users, active_users, active_new, on_streak and the sums of the
    measures, for every day of each group. Rows with a null key are dropped."""
    keys = group_keys(group_cols)
    rows = spans.dropna(subset=keys) if keys else spans
    at_signup = F.coalesce("is_premium_at_signup", F.lit(False)).cast("bigint")

    def end(day, label, change):
        return F.struct(day.alias("day"), F.lit(label).alias("label"), change.alias("change"))

    after, one = F.date_add("to_day", 1), F.lit(1).cast("bigint")
    ends = F.array(
        end(F.col("from_day"), "user_days", one), end(after, "user_days", -one),
        end(F.col("from_day"), "premium", at_signup), end(after, "premium", -at_signup),
    )
    changes = rows.select(*keys, F.col("last").alias("until"), F.explode(ends).alias("e")).select(*keys, "until", "e.*")
    totals = running_totals(changes, ["user_days", "premium"], keys)

    active = F.coalesce(F.col("is_active"), F.lit(0)).cast("bigint")
    premium = F.coalesce("is_premium", "is_premium_at_signup", F.lit(False)).cast("bigint")
    busy = rows.filter(F.col("f_date").isNotNull()).groupBy(F.col("f_date").alias("date"), *keys).agg(
        *[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in MEASURES],
        F.sum(active).alias("active_users"),
        F.sum(F.when(F.col("f_date") == F.col("signup_date"), active).otherwise(0)).alias("active_new"),
        F.count_if(F.col("streak_length_end_of_day") > 0).alias("on_streak"),
        F.sum(premium - at_signup).alias("premium_change"),
    )
    filled = totals.join(busy, ["date", *keys], "left").fillna(0)
    return filled.select(
        "date", *keys, "user_days", (F.col("premium") + F.col("premium_change")).alias("premium_users"),
        "active_users", "active_new", "on_streak", *MEASURES,
    )


def agg_lifecycle_of_days(
    users: DataFrame,
    events: DataFrame,
    *,
    group_cols: Sequence[str] | None = ("variant",),
    active_event_names: Sequence[str] | None = None,
    date_min=None,
    date_max=None,
    carried: bool = False,
) -> DataFrame:
    """date, state, keys, users as the fact table gives them, from spans of one state. The keys are those
    of the users; `date_max` is the last day of the fact. With `carried`, activity before `date_min` counts."""
    keys = group_keys(group_cols)
    counts = compute_lifecycle_counts(
        events.drop(*keys), users, active_event_names=active_event_names, group_cols=keys,
        date_min=date_min, date_max=date_max, history="signup" if carried else False,
    ).filter(F.col("users") > 0)
    return (counts.dropna(subset=keys) if keys else counts).select("date", "state", *keys, "users")


def streak_metrics_of_days(daily: DataFrame, group_cols: Sequence[str] = ("variant",)) -> DataFrame:
    """date, keys, avg_streak, share_on_streak over all user-days of daily sums."""
    return daily.select(
        "date", *group_cols,
        divide_or_null(F.col("streak_length_end_of_day"), F.col("user_days")).alias("avg_streak"),
        divide_or_null(F.col("on_streak"), F.col("user_days")).alias("share_on_streak"),
    )


def hearts_of_days(daily: DataFrame, group_cols: Sequence[str] = ("variant",)) -> DataFrame:
    """date, keys, hearts lost per active user of daily sums."""
    return daily.select(
        "date", *group_cols, divide_or_null(F.col("hearts_lost"), F.col("active_users")).alias("hearts_lost_per_user"))


def decomposition_of_days(daily: DataFrame, states: DataFrame) -> DataFrame:
    """The report of `lifecycle.decomposition_report` from daily sums and daily states, both without keys."""
    wide = states.groupBy("date").pivot("state", STATES).agg(F.sum("users")).fillna(0)
    active_states = sum((F.col(s) for s in ACTIVE_STATES[1:]), F.col(ACTIVE_STATES[0]))
    return daily.join(wide, "date").select(
        "date", "active_users", active_states.alias("active_state_users"),
        (F.col("New") - F.col("active_new")).alias("inactive_new"),
        (F.col("active_users") == active_states).alias("holds"),
    )
