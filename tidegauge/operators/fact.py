"""The user-by-day spine and the fact table on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.functions.scalars import clip_at_zero, flag
from tidegauge.operators.lifecycle import state_of_day
from tidegauge.operators.prepare import (
    as_date,
    check_order,
    checked_last_day,
    first_users,
    only_days,
    pick_columns,
    prep_events,
    prep_sessions,
    unique_users,
)
from tidegauge.schemas import FACT_USER_DAILY

FACT_COLUMNS = FACT_USER_DAILY.fieldNames()
_FLAGS = ["is_active", "had_app_open", "had_lesson_started", "had_lesson_completed"]
_SUMS = ["sessions_count", "session_duration_sec", "lessons_completed", "xp_earned", "hearts_lost"]
_LAST = ["streak_length_end_of_day"]


def _reported_days(members: DataFrame, date_min, date_max, latest: Column) -> tuple[Column, Column]:
    """First day of each user and last day of all; `latest` is used where no date_max is given."""
    check_order(date_min, date_max)
    if date_max is not None and date_min is not None:
        last = as_date(date_max)
    elif date_max is not None:
        last = checked_last_day(members.agg(F.min("signup_date")).scalar(), as_date(date_max))
    elif date_min is not None:
        last = checked_last_day(as_date(date_min), latest)
    else:
        last = latest
    start = F.col("signup_date")
    return (start if date_min is None else F.greatest(start, as_date(date_min))), last


def build_user_date_spine(
    users: DataFrame, *, date_min: str | None = None, date_max: str | None = None
) -> DataFrame:
    """date, user_id, signup_date, days_since_signup: one row per user and day from signup on.

    The spine is users times days. It is exploded in place from the user rows and stays
    partitioned by user_id.
    """
    members = unique_users(users)
    start, last = _reported_days(
        members, date_min, date_max, members.agg(F.max("signup_date")).scalar()
    )
    return (
        members.withColumns({"start": start, "last": last})
        .filter(F.col("start") <= F.col("last"))
        .select(
            F.explode(F.sequence("start", "last")).alias("date"), "user_id", "signup_date"
        )
        .withColumn("days_since_signup", F.datediff("date", "signup_date"))
    )


def _whole_ids(events: DataFrame) -> bool:
    return dict(events.dtypes).get("event_id") in ("tinyint", "smallint", "int", "bigint")


_STEP = "20000000000000000000"  # more than any 64-bit number and its negative are apart


def _micros() -> Column:
    """Time of an event as a number, unknown times last."""
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("event_time").cast("timestamp_ntz"))
    return F.coalesce(micros, F.lit(10**18))


def _packed(number: Column) -> Column:
    """Time and then a number as one decimal: a maximum over it is a hash aggregation, over a struct a sort
    aggregation."""
    time = _micros().cast("decimal(19,0)") * F.lit(_STEP).cast("decimal(20,0)")
    return (time + number.cast("decimal(19,0)")).cast("decimal(38,0)")


def _time_and_id() -> Column:
    return _packed(F.coalesce(F.col("event_id").cast("bigint"), F.lit(-(2**63))))


def _mark(events: DataFrame) -> Column:
    """A number from 0 to 2^63 - 1 for what tells events of one time apart."""
    of = [c for c in ("event_id",) if c in events.columns] + ["streak_length", "is_premium"]
    return F.expr(f"shiftrightunsigned(xxhash64({', '.join(of)}), 1)")


def _with_last_events(per_day: DataFrame, ev: DataFrame) -> DataFrame:
    """Settle the days whose latest time has several events: only those are looked up again, by their time, and
    ordered by id. `per_day` has the latest time and the highest and lowest mark at it."""
    step = F.lit(_STEP).cast("decimal(38,0)")
    tied = F.pmod(F.col("high"), step) + F.pmod(F.col("low"), step) != F.lit(2**63 - 1)
    marked = per_day.withColumn("tied", tied)
    ids = [F.col("event_id").desc_nulls_last()] if "event_id" in ev.columns else []
    order = W.partitionBy("user_id", "date").orderBy(
        *ids, F.desc_nulls_last("streak_length"), F.desc_nulls_last("is_premium"))
    rows = ev.select(
        F.col("user_id").alias("t_user"), F.col("event_date").alias("t_date"), _micros().alias("t_time"),
        *[c for c in ("event_id",) if c in ev.columns], "streak_length", "is_premium")
    same = (F.col("user_id") == F.col("t_user")) & (F.col("date") == F.col("t_date")) & (F.col("time") == F.col("t_time"))
    settled = (
        marked.where("tied").select("user_id", "date", "time").join(rows, same)
        .withColumn("place", F.row_number().over(order)).where("place = 1")
        .select("user_id", "date", F.col("streak_length").alias("s_streak"), F.col("is_premium").alias("s_premium")))
    joined = marked.join(settled, ["user_id", "date"], "left").withColumns({
        "streak_length_end_of_day": F.when(F.col("tied"), F.col("s_streak")).otherwise(F.col("streak_length_end_of_day")),
        "is_premium": F.when(F.col("tied"), F.col("s_premium")).otherwise(F.col("is_premium"))})
    return joined.drop("tied", "time", "high", "low", "s_streak", "s_premium")


def daily_event_features(
    events: DataFrame, *, active_event_names: Sequence[str] | None = None
) -> DataFrame:
    """user_id, date, activity and step flags, sums, and the last streak and premium status of the
    day. One map-side combined hash aggregation over the events. The last event is that of the latest time, of
    equal times the one with the largest id: whole-number ids are part of the order, others are looked up for
    the days with such ties only."""
    require_columns(
        events, ["xp_delta", "hearts_delta", "streak_length", "is_premium"], "events"
    )
    ev = prep_events(events, active_event_names=active_event_names)
    name = F.col("event_name")
    completed = flag(name == "lesson_completed")
    timing = {}
    if "event_time" in events.columns and _whole_ids(events):
        order = _time_and_id()
        streak, premium = (F.max_by(c, order) for c in ("streak_length", "is_premium"))
    elif "event_time" in events.columns:
        mark = _mark(events)
        high, low = _packed(mark), _packed(F.lit(2**63 - 1) - mark)
        streak, premium = (F.max_by(c, high) for c in ("streak_length", "is_premium"))
        timing = {"time": F.max(_micros()), "high": F.max(high), "low": F.max(low)}
    else:
        require_columns(events, ["event_id"], "events without event_time")

        def last_known(column):
            known = F.when(F.col(column).isNotNull(), F.col("event_id"))
            return F.max_by(column, known)

        streak, premium = last_known("streak_length"), last_known("is_premium")
    known = ev.filter(F.col("user_id").isNotNull())
    per_day = (
        known.groupBy("user_id", F.col("event_date").alias("date"))
        .agg(
            F.max(flag(F.col("is_active_event"))).alias("is_active"),
            F.max(flag(name == "app_open")).alias("had_app_open"),
            F.max(flag(name == "lesson_started")).alias("had_lesson_started"),
            F.max(completed).alias("had_lesson_completed"),
            F.sum(completed).alias("lessons_completed"),
            F.sum("xp_delta").alias("xp_earned"),
            F.sum(clip_at_zero(-F.col("hearts_delta"))).alias("hearts_lost"),
            streak.alias("streak_length_end_of_day"),
            premium.alias("is_premium"),
            *[c.alias(n) for n, c in timing.items()],
        )
    )
    return _with_last_events(per_day, known) if timing else per_day


def daily_session_features(sessions: DataFrame) -> DataFrame:
    """user_id, date, distinct sessions and their total duration."""
    require_columns(sessions, ["session_id", "session_duration_sec"], "sessions")
    return (
        prep_sessions(sessions)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("session_date").alias("date"))
        .agg(
            F.count_distinct("session_id").alias("sessions_count"),
            F.sum("session_duration_sec").alias("session_duration_sec"),
        )
    )


def _latest_day(members, events, sessions) -> Column:
    """Latest of signups and of the known users' events and sessions. Both tables together are reduced to one day
    per user, which meets the user table once."""
    days = prep_events(events).select("user_id", F.col("event_date").alias("day")).unionAll(
        prep_sessions(sessions).select("user_id", F.col("session_date").alias("day")))
    per_user = days.groupBy("user_id").agg(F.max("day").alias("day"))
    both = members.select("user_id", "signup_date").join(per_user, "user_id", "left")
    return both.agg(F.greatest(F.max("signup_date"), F.max("day"))).scalar()


def busy_spans(
    users: DataFrame,
    events: DataFrame,
    sessions: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    date_min: str | None = None,
    date_max: str | None = None,
    sample_n_users: int | None = None,
    keep_user_cols: Sequence[str] = (),
    carried: DataFrame | None = None,
) -> DataFrame:
    """The fact table before its quiet days are filled in: one row per user and busy day, on which
    something happened, standing for the days from `from_day` to `to_day`.

    Events and sessions are reduced to user-days, and only those are joined and ordered per user.
    Sums over the fact come from these rows without the users-by-days table, see `operators/sparse.py`.
    `carried` has the user_id and last_active day before `date_min` of users that were active before it, so that
    a build of a range goes on from the one before.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    attributes = [c for c in ("variant", "is_premium_at_signup") if c in users.columns]
    kept = [c for c in keep_user_cols if c not in FACT_COLUMNS]
    require_columns(users, kept, "users")
    members = unique_users(users, [*attributes, *kept])
    if sample_n_users is not None:
        members = first_users(members, sample_n_users)

    # Only reported days matter, also for the last one, so a build of a few days reads only their partitions.
    events = only_days(events, date_min, date_max, day="event_date", moment="event_time")
    sessions = only_days(sessions, date_min, date_max, day="session_date", moment="session_start")
    latest = None if date_max is not None else _latest_day(members, events, sessions)
    start, last = _reported_days(members, date_min, date_max, latest)
    reported = members.withColumns({"start": start, "last": last}).filter(
        F.col("start") <= F.col("last")
    )
    if carried is not None:
        before = carried.select("user_id", F.col("last_active").alias("carried_active"))
        reported = reported.join(before, "user_id", "left")
    features = daily_event_features(events, active_event_names=active_event_names).join(
        daily_session_features(sessions), ["user_id", "date"], "full"
    ).withColumnsRenamed({"user_id": "f_user", "date": "f_date"})
    busy = reported.join(
        features,
        (F.col("user_id") == F.col("f_user")) & F.col("f_date").between(F.col("start"), F.col("last")),
        "left",
    )
    at_signup = F.lit(None).cast("boolean") if "is_premium_at_signup" not in attributes else F.col("is_premium_at_signup")
    return _link(busy).withColumn("is_premium_at_signup", at_signup)


def _link(busy: DataFrame) -> DataFrame:
    """Stretch each busy day to the day before the next one. The first busy day of a user also
    covers the quiet days before it; a user without busy days has one row with a null f_date."""
    per_user = W.partitionBy("user_id").orderBy("f_date")
    up_to_here = per_user.rowsBetween(W.unboundedPreceding, W.currentRow)
    before_here = per_user.rowsBetween(W.unboundedPreceding, -1)
    active_day = F.when(F.col("is_active") == 1, F.col("f_date"))
    carried = F.col("carried_active") if "carried_active" in busy.columns else F.lit(None).cast("date")
    return busy.withColumns({
        "from_day": F.when(F.row_number().over(per_user) == 1, F.col("start")).otherwise(F.col("f_date")),
        "to_day": F.coalesce(F.date_sub(F.lead("f_date").over(per_user), 1), F.col("last")),
        "active_before": F.coalesce(F.last(active_day, ignorenulls=True).over(before_here), carried),
        "active_so_far": F.coalesce(F.last(active_day, ignorenulls=True).over(up_to_here), carried),
    })


def spans_by_month(spans: DataFrame) -> DataFrame:
    """Spans cut at month ends and dealt out by month, so that the days they stand for come out next to
    the days they are written with. Only these sparse rows are shuffled."""
    months = F.sequence(F.trunc("from_day", "MM"), F.trunc("to_day", "MM"), F.expr("INTERVAL 1 MONTH"))
    cut = spans.withColumn("month", F.explode(months)).withColumns({
        "from_day": F.greatest("from_day", "month"), "to_day": F.least("to_day", F.last_day("month")),
    })
    return cut.hint("rebalance", "month")


def fact_of_spans(spans: DataFrame, keep_user_cols: Sequence[str] = (), include_lifecycle: bool = True) -> DataFrame:
    """The fact table: every span filled with its days in place."""
    days = spans.withColumn("date", F.explode(F.sequence("from_day", "to_day")))
    busy_today = F.col("date") == F.col("f_date")
    # Before the first busy day, and for users without one, only what was carried over counts.
    last_active = F.when(F.col("date") > F.col("f_date"), F.col("active_so_far")).otherwise(F.col("active_before"))
    active = F.coalesce(busy_today & (F.col("is_active") == 1), F.lit(False))
    state = F.lit(None).cast("string")
    if include_lifecycle:
        state = state_of_day(
            F.col("date") == F.col("signup_date"), active, F.datediff("date", last_active)
        )
    kept = [c for c in keep_user_cols if c not in FACT_COLUMNS]
    today = {c: F.coalesce(F.when(busy_today, F.col(c)), F.lit(0)) for c in [*_FLAGS, *_SUMS, *_LAST]}
    fact = days.select(
        "date", "user_id", "signup_date", *[c for c in ("variant",) if c in spans.columns], *kept,
        F.datediff("date", "signup_date").alias("days_since_signup"),
        *[column.alias(c) for c, column in today.items()],
        F.coalesce(
            F.when(busy_today, F.col("is_premium")), "is_premium_at_signup", F.lit(False)).alias("is_premium"),
        state.alias("lifecycle_state"),
    )
    return pick_columns(fact, [*FACT_COLUMNS, *kept])


def last_fact_day(
    users: DataFrame, events: DataFrame, sessions: DataFrame, date_min: str | None = None,
    date_max: str | None = None,
) -> Column:
    """The last day of the fact table of these inputs, as a scalar column."""
    if date_max is not None:
        return as_date(date_max)
    events = only_days(events, date_min, None, day="event_date", moment="event_time")
    sessions = only_days(sessions, date_min, None, day="session_date", moment="session_start")
    return _latest_day(unique_users(users), events, sessions)


def build_fact_user_daily(
    users: DataFrame,
    events: DataFrame,
    sessions: DataFrame,
    *,
    include_lifecycle: bool = True,
    keep_user_cols: Sequence[str] = (),
    **options,
) -> DataFrame:
    """One row per user and day from signup on, with activity, sessions, progress and state.

    The dense table, users times days, comes out of the last projection and is never shuffled.
    `keep_user_cols` appends user attributes, so that the fact can be grouped by them; the other options
    are those of `busy_spans`.
    """
    spans = busy_spans(users, events, sessions, keep_user_cols=keep_user_cols, **options)
    return fact_of_spans(spans, keep_user_cols, include_lifecycle)
