"""Daily, weekly and monthly active users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.operators.prepare import active_names, active_user_days, group_keys, prep_events


def running_totals(changes: DataFrame, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Dense daily totals from signed changes.

    `changes` holds keys, day, label, change and until (the last day the group reports). The
    changes are summed per day with map-side combine; the window then sees at most one row per
    group and day, and the days between two changes are filled in by `sequence`.
    """
    daily = changes.groupBy(*keys, "day").agg(
        *[F.sum(F.when(F.col("label") == l, F.col("change")).otherwise(0)).alias(l) for l in labels],
        F.max("until").alias("until"),
    )
    group = W.partitionBy(*keys)
    in_order = group.orderBy("day")
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = (
        daily.select(
            *keys,
            "day",
            F.max("until").over(group).alias("until"),
            F.lead("day").over(in_order).alias("next_day"),
            *[F.sum(l).over(so_far).alias(l) for l in labels],
        )
        .filter(F.col("day") <= F.col("until"))
        .withColumn("until", F.least(F.date_sub("next_day", 1), F.col("until")))
    )
    return filled.select(F.explode(F.sequence("day", "until")).alias("date"), *keys, *labels)


def trailing_active_users(
    user_days: DataFrame, windows: Mapping[str, int], keys: Sequence[str]
) -> DataFrame:
    """Exact distinct users over trailing windows, one column per entry of `windows`.

    An active day counts its user from that day until the window has passed. Overlapping spans of
    one user merge, so only the first and last day of a merged span change the total. The work is
    linear in distinct user-days for any window length, and a user has at most one row per day.
    Each group runs from its first to its last active day.
    """
    if any(days <= 0 for days in windows.values()):
        raise ValueError("a trailing window spans at least one day")
    per_user = W.partitionBy("user_id", *keys).orderBy("date")
    since_last = F.datediff("date", F.lag("date").over(per_user))
    to_next = F.datediff(F.lead("date").over(per_user), "date")
    spans = user_days.filter(F.col("user_id").isNotNull()).select(
        *keys, "date", since_last.alias("since_last"), to_next.alias("to_next")
    )

    def change(day, label, amount, condition):
        row = F.struct(
            day.alias("day"), F.lit(label).alias("label"), F.lit(amount).alias("change")
        )
        return F.when(condition, row)

    rows = [change(F.col("date"), "", 0, F.lit(True))]
    for label, days in windows.items():
        starts = F.col("since_last").isNull() | (F.col("since_last") >= days)
        ends = F.col("to_next").isNull() | (F.col("to_next") >= days)
        rows.append(change(F.col("date"), label, 1, starts))
        rows.append(change(F.date_add("date", days), label, -1, ends))
    changes = spans.select(
        *keys, F.col("date").alias("until"), F.explode(F.array(*rows)).alias("c")
    ).filter(F.col("c").isNotNull())
    return running_totals(changes.select(*keys, "until", "c.*"), list(windows), keys)


def compute_dau(
    events: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    users: DataFrame | None = None,
) -> DataFrame:
    """date, keys, dau. Days without activity are absent; rows with a null key are dropped."""
    keys = group_keys(group_cols)
    days = active_user_days(
        events, active_event_names=active_event_names, group_cols=keys, users=users
    )
    return _users_per_day(days, keys, "dau")


def _users_per_day(user_days: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    if keys:
        user_days = user_days.dropna(subset=list(keys))
    return user_days.groupBy("date", *keys).agg(F.count("user_id").alias(name))


def _trailing(events, label, days, active_event_names, group_cols, users):
    keys = group_keys(group_cols)
    user_days = active_user_days(
        events, active_event_names=active_event_names, group_cols=keys, users=users
    )
    return trailing_active_users(user_days, {label: days}, keys)


def compute_wau(
    events: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    users: DataFrame | None = None,
) -> DataFrame:
    """date, keys, wau: users active in [t-6, t], for every day of each group. Null keys stay."""
    return _trailing(events, "wau", 7, active_event_names, group_cols, users)


def compute_mau(
    events: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    users: DataFrame | None = None,
) -> DataFrame:
    """date, keys, mau: users active in [t-29, t], for every day of each group. Null keys stay."""
    return _trailing(events, "mau", 30, active_event_names, group_cols, users)


def compute_active_users(
    events: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    users: DataFrame | None = None,
) -> DataFrame:
    """dau, wau and mau of every calendar day of each group, from one pass over the user-days."""
    keys = group_keys(group_cols)
    user_days = active_user_days(
        events, active_event_names=active_event_names, group_cols=keys, users=users
    )
    return trailing_active_users(user_days, {"dau": 1, "wau": 7, "mau": 30}, keys)


def daily_user_sketches(
    events: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    users: DataFrame | None = None,
    precision: int = 12,
) -> DataFrame:
    """date, keys, sketch: a mergeable sketch of the active users of each day and key, to be stored and added to
    day by day. It has at most 2^precision bytes, and its count a standard error of 1.04 / 2^(precision / 2).

    Where events have the keys, sketches are updated on the map side and users are never shuffled."""
    keys = group_keys(group_cols)
    names = active_names(active_event_names)
    prepared = prep_events(events, active_event_names=names).filter(F.col("event_name").isin(names))
    if any(k not in events.columns for k in keys):
        prepared = active_user_days(
            events, active_event_names=names, group_cols=keys, users=users).withColumnRenamed("date", "event_date")
    return prepared.groupBy(F.col("event_date").alias("date"), *keys).agg(
        F.hll_sketch_agg("user_id", precision).alias("sketch"))


def approx_active_users(
    sketches: DataFrame, windows: Mapping[str, int] = {"wau": 7, "mau": 30}, group_cols: Sequence[str] | None = ("variant",),
) -> DataFrame:
    """date, keys and an estimate of the distinct users of each trailing window, from stored daily sketches alone:
    a day's sketch is merged into every day it counts for. Each group runs from its first to its last day."""
    if any(days <= 0 for days in windows.values()):
        raise ValueError("a trailing window spans at least one day")
    keys = group_keys(group_cols)
    until = F.max("date").over(W.partitionBy(*keys))
    longest = max(windows.values())
    spread = sketches.withColumn("until", until).select(
        *keys, "sketch", F.col("date").alias("day"),
        F.explode(F.sequence("date", F.least("until", F.date_add("date", longest - 1)))).alias("date"))
    age = F.datediff("date", "day")
    return spread.groupBy("date", *keys).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(age < days, F.col("sketch")))), F.lit(0)).alias(name)
        for name, days in windows.items()])


def rolling_mean(daily: DataFrame, column: str, *, rows: int = 7, full_only: bool = False,
                 name: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over the last `rows` rows by date. A daily series is one row per day and key, so the
    window stays small. With `full_only`, rows with a shorter history are dropped."""
    frame = W.partitionBy(*keys).orderBy("date").rowsBetween(-(rows - 1), 0)
    name = name or f"{column}_{rows}d_avg"
    out = daily.withColumn(name, F.avg(column).over(frame))
    if not full_only:
        return out
    counted = out.withColumn("rows_seen", F.count(column).over(frame))
    return counted.filter(F.col("rows_seen") == rows).drop("rows_seen")


def daily_range(daily: DataFrame, column: str = "dau") -> DataFrame:
    """Lowest and highest daily value and the number of days."""
    return daily.agg(
        F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"),
        F.count(column).alias("days"),
    )
