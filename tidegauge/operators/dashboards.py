"""The data sets behind the dashboard charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.scalars import clip_at_zero, divide_or_null, flag, state_label
from tidegauge.operators.activity import compute_dau
from tidegauge.operators.prepare import active_names, group_keys, prep_events, prep_sessions, with_user_columns
from tidegauge.schemas import ACTIVE_STATES, HEALTH_STATES


def kpi_cards(kpis: DataFrame, retention: DataFrame) -> DataFrame:
    """metric, value: each KPI at the latest date, each retention horizon at its latest cohort,
    summed over the groups of that date."""
    measures = ["signups", "dau", "wau", "mau"]
    latest = kpis.groupBy("date").agg(*[F.sum(m).alias(m) for m in measures])
    cards = latest.agg(*[F.max_by(m, "date").cast("double").alias(m) for m in measures])
    cards = cards.withColumn("dau_mau_ratio", divide_or_null(F.col("dau"), F.col("mau")))
    names = [*measures, "dau_mau_ratio"]
    daily = cards.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names
    ])).alias("c")).select("c.metric", "c.value")
    cohorts = retention.groupBy("day_n", "cohort_date").agg(
        divide_or_null(F.sum("retained_users"), F.sum("cohort_size")).alias("rate")
    )
    kept = cohorts.groupBy("day_n").agg(F.max_by("rate", "cohort_date").alias("value")).select(
        F.concat(F.lit("d"), F.col("day_n"), F.lit("_retention")).alias("metric"), "value"
    )
    return daily.unionByName(kept)


def active_user_trend(kpis: DataFrame) -> DataFrame:
    """date, keys, signups, dau, wau and mau for the trend charts."""
    keys = [k for k in kpis.columns[1:kpis.columns.index("signups")]]
    return kpis.select("date", *keys, "signups", "dau", "wau", "mau")


def retention_trend(retention: DataFrame, day_n: int | Sequence[int] = (1, 7, 30)) -> DataFrame:
    days = [day_n] if isinstance(day_n, int) else list(day_n)
    return retention.filter(F.col("day_n").isin(days))


def _mix(lifecycle_daily: DataFrame, states: Sequence[str]) -> DataFrame:
    keys = [c for c in lifecycle_daily.columns if c not in ("date", "state", "users")]
    total = F.sum("users").over(W.partitionBy("date", *keys))
    return lifecycle_daily.filter(F.col("state").isin(list(states))).select(
        "date", *keys, "state", state_label(F.col("state")).alias("state_name"), "users",
        divide_or_null(F.col("users"), total).alias("share"),
    )


def active_mix(lifecycle_daily: DataFrame) -> DataFrame:
    """New, Current, Reactivated and Resurrected users with their share of the day."""
    return _mix(lifecycle_daily, ACTIVE_STATES)


def health_mix(lifecycle_daily: DataFrame) -> DataFrame:
    """Current, at-risk and dormant users with their share of the day."""
    return _mix(lifecycle_daily, HEALTH_STATES)


def lessons_per_session(kpis: DataFrame) -> DataFrame:
    keys = [k for k in kpis.columns[1:kpis.columns.index("signups")]]
    ratio = divide_or_null(F.col("lessons_completed"), F.col("sessions"))
    return kpis.select("date", *keys, ratio.alias("lessons_per_session"))


def premium_share_trend(kpis: DataFrame) -> DataFrame:
    keys = [k for k in kpis.columns[1:kpis.columns.index("signups")]]
    return kpis.select("date", *keys, "premium_users", "premium_share")


def _keyed_events(events: DataFrame, users, keys, names) -> DataFrame:
    """Events of the given names per day with their keys; keys from users are joined after the
    rows are reduced to one per user, day and event."""
    own = [k for k in keys if k in events.columns]
    counted = (
        prep_events(events).filter(F.col("event_name").isin(list(names)))
        .groupBy(F.col("event_date").alias("date"), "user_id", "event_name", *own)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keyed = with_user_columns(counted, users, keys, "events")
    return keyed.dropna(subset=list(keys)) if keys else keyed


def paywall_rate(
    events: DataFrame,
    users: DataFrame | None = None,
    *,
    group_cols: Sequence[str] | None = None,
    active_event_names: Sequence[str] | None = None,
    shown: str = "paywall_shown",
) -> DataFrame:
    """Users who saw the paywall over the active users of the day."""
    keys = group_keys(group_cols)
    saw = _keyed_events(events, users, keys, [shown]).groupBy("date", *keys).agg(
        F.count("user_id").alias("shown_users")
    )
    dau = compute_dau(events, active_event_names=active_event_names, group_cols=keys, users=users)
    joined = dau.join(saw, ["date", *keys], "left").fillna(0, subset=["shown_users"])
    return joined.withColumn("paywall_rate", divide_or_null(F.col("shown_users"), F.col("dau")))


def purchase_conversion(
    events: DataFrame,
    users: DataFrame | None = None,
    *,
    group_cols: Sequence[str] | None = None,
    shown: str = "paywall_shown",
    bought: str = "purchase",
) -> DataFrame:
    """Users who saw the paywall and bought on the same day, over the users who saw it."""
    keys = group_keys(group_cols)

    def did(name) -> Column:
        return F.max(flag(F.col("event_name") == name))

    per_user = _keyed_events(events, users, keys, [shown, bought]).filter(
        F.col("user_id").isNotNull()
    ).groupBy("date", "user_id", *keys).agg(did(shown).alias("saw"), did(bought).alias("paid"))
    daily = per_user.groupBy("date", *keys).agg(
        F.sum("saw").alias("shown_users"), F.sum(F.col("saw") * F.col("paid")).alias("buyers")
    )
    return daily.withColumn("purchase_conversion", divide_or_null(F.col("buyers"), F.col("shown_users")))


def streak_metrics(fact_user_daily: DataFrame, group_cols: Sequence[str] = ("variant",)) -> DataFrame:
    """Average streak and the share of users with a running streak, per day."""
    return fact_user_daily.groupBy("date", *group_cols).agg(
        F.avg("streak_length_end_of_day").alias("avg_streak"),
        F.avg(flag(F.col("streak_length_end_of_day") > 0)).alias("share_on_streak"),
    )


def session_duration(
    sessions: DataFrame, users: DataFrame | None = None, *, group_cols: Sequence[str] | None = None
) -> DataFrame:
    """Mean duration of one session, per day. Sessions are summed per user and day before the keys
    of the users are joined."""
    keys = group_keys(group_cols)
    own = [k for k in keys if k in sessions.columns]
    summed = prep_sessions(sessions).groupBy(F.col("session_date").alias("date"), "user_id", *own).agg(
        F.sum("session_duration_sec").alias("seconds"), F.count("session_duration_sec").alias("n")
    )
    keyed = with_user_columns(summed, users, keys, "sessions")
    if keys:
        keyed = keyed.dropna(subset=keys)
    daily = keyed.groupBy("date", *keys).agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n"))
    mean = divide_or_null(F.col("seconds"), F.col("n"))
    return daily.select("date", *keys, mean.alias("avg_session_duration_sec"))


def lesson_completion_rate(
    events: DataFrame, users: DataFrame | None = None, *, group_cols: Sequence[str] | None = None
) -> DataFrame:
    """Completed over started lessons, by event counts."""
    keys = group_keys(group_cols)
    counted = _keyed_events(events, users, keys, ["lesson_started", "lesson_completed"])

    def total(name):
        return F.sum(F.when(F.col("event_name") == name, F.col("n")).otherwise(0))

    daily = counted.groupBy("date", *keys).agg(
        total("lesson_started").alias("started"), total("lesson_completed").alias("completed")
    )
    rate = divide_or_null(F.col("completed"), F.col("started"))
    return daily.withColumn("lesson_completion_rate", rate)


def hearts_lost_per_user(
    events: DataFrame,
    users: DataFrame | None = None,
    *,
    group_cols: Sequence[str] | None = None,
    active_event_names: Sequence[str] | None = None,
) -> DataFrame:
    """Hearts lost over active users, per day, from the events."""
    keys = group_keys(group_cols)
    own = [k for k in keys if k in events.columns]
    is_active = F.col("event_name").isin(active_names(active_event_names))
    per_user = (
        prep_events(events).filter(F.col("user_id").isNotNull())
        .groupBy(F.col("event_date").alias("date"), "user_id", *own)
        .agg(
            F.sum(clip_at_zero(-F.col("hearts_delta"))).alias("lost"),
            F.max(flag(is_active)).alias("active"),
        )
    )
    keyed = with_user_columns(per_user, users, keys, "events")
    if keys:
        keyed = keyed.dropna(subset=keys)
    daily = keyed.groupBy("date", *keys).agg(F.sum("lost").alias("lost"), F.sum("active").alias("active"))
    rate = divide_or_null(F.col("lost"), F.col("active"))
    return daily.select("date", *keys, rate.alias("hearts_lost_per_user"))


def event_guardrails(
    events: DataFrame,
    users: DataFrame | None = None,
    *,
    group_cols: Sequence[str] | None = None,
    active_event_names: Sequence[str] | None = None,
    shown: str = "paywall_shown",
    bought: str = "purchase",
) -> DataFrame:
    """date, keys, lesson_completion_rate, hearts_lost_per_user and purchase_conversion, as the functions
    above define them, from one reduction of the events to user-days."""
    keys = group_keys(group_cols)
    own = [k for k in keys if k in events.columns]
    name, known = F.col("event_name"), F.col("user_id").isNotNull()

    def times(event) -> Column:
        return F.count_if(name == event)

    def did(condition) -> Column:
        return F.max(flag(condition & known))

    per_user = prep_events(events).groupBy(F.col("event_date").alias("date"), "user_id", *own).agg(
        times("lesson_started").alias("started"), times("lesson_completed").alias("completed"),
        F.sum(F.when(known, clip_at_zero(-F.col("hearts_delta")))).alias("lost"),
        did(name.isin(active_names(active_event_names))).alias("active"),
        did(name == shown).alias("saw"), did(name == bought).alias("paid"),
    )
    keyed = with_user_columns(per_user, users, keys, "events")
    if keys:
        keyed = keyed.dropna(subset=keys)
    daily = keyed.groupBy("date", *keys).agg(
        *[F.sum(c).alias(c) for c in ("started", "completed", "lost", "active", "saw")],
        F.sum(F.col("saw") * F.col("paid")).alias("buyers"), F.max(flag(known)).alias("any_user"),
    ).filter((F.col("any_user") == 1) | (F.col("started") + F.col("completed") > 0))
    return daily.select(
        "date", *keys, divide_or_null(F.col("completed"), F.col("started")).alias("lesson_completion_rate"),
        divide_or_null(F.col("lost"), F.col("active")).alias("hearts_lost_per_user"),
        divide_or_null(F.col("buyers"), F.col("saw")).alias("purchase_conversion"),
    )


def hearts_per_active_day(fact_user_daily: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Hearts lost over active users, per day, from the fact table."""
    sums = fact_user_daily.groupBy("date", *group_cols).agg(
        F.sum("hearts_lost").alias("lost"), F.sum(F.col("is_active").cast("bigint")).alias("active")
    )
    rate = divide_or_null(F.col("lost"), F.col("active"))
    return sums.select("date", *group_cols, rate.alias("hearts_lost_per_user"))
