"""The seven lifecycle states of a user: New, Current, Reactivated, Resurrected, AtRiskWAU,
AtRiskMAU and Dormant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.functions.scalars import divide_or_null, strict_date
from tidegauge.operators.activity import running_totals
from tidegauge.operators.prepare import (
    active_user_days,
    as_date,
    check_order,
    checked_last_day,
    group_keys,
    only_days,
    unique_users,
)
from tidegauge.schemas import ACTIVE_STATES, LIFECYCLE_STATES

STATES = list(LIFECYCLE_STATES)


def returning_state(gap: Column) -> Column:
    """State on an active day, from the days since the active day before it (null: none)."""
    return (
        F.when(gap <= 7, "Current").when(gap <= 30, "Reactivated").otherwise("Resurrected")
    )


def lapsing_state(gap: Column) -> Column:
    """State on an inactive day, from the days since the last active day (null: none)."""
    return F.when(gap <= 6, "AtRiskWAU").when(gap <= 29, "AtRiskMAU").otherwise("Dormant")


def state_of_day(is_signup_day: Column, is_active: Column, gap: Column) -> Column:
    """The signup day is New whether or not the user was active on it."""
    return (
        F.when(is_signup_day, "New")
        .when(is_active, returning_state(gap))
        .otherwise(lapsing_state(gap))
    )


def assign_lifecycle_state(fact_user_daily: DataFrame) -> DataFrame:
    """Add `lifecycle_state` to a user-by-day table, from the activity in that table alone."""
    require_columns(
        fact_user_daily, ["date", "user_id", "signup_date", "is_active"], "fact_user_daily"
    )
    active = F.col("is_active").cast("boolean")
    before = W.partitionBy("user_id").orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    dated = fact_user_daily.withColumns({
        "date": strict_date(F.col("date"), "date"),
        "signup_date": strict_date(F.col("signup_date"), "signup_date"),
    })
    last_active = F.last(F.when(active, F.col("date")), ignorenulls=True).over(before)
    gap = F.datediff("date", last_active)
    state = state_of_day(F.col("date") == F.col("signup_date"), active, gap)
    return dated.withColumn("lifecycle_state", state)


def compute_lifecycle_counts(
    events: DataFrame,
    users: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = ("variant",),
    date_min: str | None = None,
    date_max: str | None = None,
    history: bool | str = True,
) -> DataFrame:
    """date, state, users, keys: users per state for every day, group and state, zeros included.

    A user keeps one state over whole spans of days, so each active day is turned into the few spans
    up to the next active day and only their ends are counted. The user-by-day table is never
    built: the cost grows with active user-days, not with users times days. Activity before signup
    or before `date_min` counts as history, unless `history` is off: then states come from the
    reported days alone, as in the fact table. With `history="signup"` they come from all days since the
    signup, as in a fact table that is built range by range.
    """
    keys = group_keys(group_cols)
    spans = _state_spans(events, users, keys, active_event_names, date_min, date_max, history=history)
    ends = F.array(
        F.struct(F.col("start").alias("day"), F.lit(1).alias("change")),
        F.struct(F.col("stop").alias("day"), F.lit(-1).alias("change")),
    )
    changes = spans.select(*keys, "until", "label", F.explode(ends).alias("e"))
    counts = running_totals(changes.select(*keys, "until", "label", "e.*"), STATES, keys)
    return counts.unpivot(["date", *keys], STATES, "state", "users").select(
        "date", "state", "users", *keys
    )


def compute_lifecycle_transitions(
    events: DataFrame,
    users: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    group_cols: Sequence[str] | None = None,
    date_min: str | None = None,
    date_max: str | None = None,
) -> DataFrame:
    """keys, state, next_state, transitions, probability: moves from one day to the next.

    The same matrix as `lifecycle_transitions` of the fact table (activity before a user's first
    reported day is not seen), but from spans of days: a span of n days is n - 1 moves to itself and
    one to the next span. The user-by-day table is neither built nor sorted.
    """
    keys = group_keys(group_cols)
    spans = _state_spans(
        events, users, keys, active_event_names, date_min, date_max, history=False
    ).filter(F.col("label") != "")
    per_user = W.partitionBy("user_id").orderBy("start")
    moves = F.array(
        F.struct(F.col("label").alias("next_state"), (F.datediff("stop", "start") - 1).alias("n")),
        F.struct(F.lead("label").over(per_user).alias("next_state"), F.lit(1).alias("n")),
    )
    counts = (
        spans.withColumn("moves", moves)
        .select(*keys, F.col("label").alias("state"), F.explode("moves").alias("m"))
        .select(*keys, "state", "m.*")
        .filter(F.col("next_state").isNotNull() & (F.col("n") > 0))
        .groupBy(*keys, "state", "next_state")
        .agg(F.sum("n").alias("transitions"))
    )
    return transition_shares(counts, keys)


def _state_spans(
    events, users, keys, active_event_names, date_min, date_max, *, history: bool | str = True
) -> DataFrame:
    """user_id, keys, until, label, start, stop: the reported days of each user as spans of one state,
    `stop` being the day after, and one empty span per user on the first reported day."""
    require_columns(users, ["user_id", "signup_date", *keys], "users")
    check_order(date_min, date_max)
    members = unique_users(users, keys)
    own = [k for k in keys if k in events.columns]
    options = dict(active_event_names=active_event_names, group_cols=own)
    # The last day cannot lie before date_min, nor the first after date_max.
    reported = only_days(events, date_min, date_max, day="event_date", moment="event_time")
    first_day, last_day = _bounds(members, active_user_days(reported, **options), date_min, date_max)
    # No state looks back further than 30 days: with older activity, or none, it is the same.
    oldest = None if date_min is None else F.date_sub(as_date(date_min), 31)
    recent = only_days(events, oldest, date_max, day="event_date", moment="event_time")

    # A user whose key is null keeps its place in the counts but matches no activity.
    other = active_user_days(recent, **options).select(
        F.col("user_id").alias("a_user"), "date", *[F.col(k).alias(f"a_{k}") for k in own]
    )
    same = F.col("user_id") == F.col("a_user")
    for k in keys:
        same = same & (F.col(k) == F.col(f"a_{k}") if k in own else F.col(k).isNotNull())
    if not history:
        same = same & (F.col("date") >= F.greatest("signup_date", first_day))
    elif history == "signup":
        same = same & (F.col("date") >= F.col("signup_date"))
    rows = members.join(other, same, "left").select(
        "user_id", "signup_date", *keys, "date",
        first_day.alias("first_day"), last_day.alias("last_day"),
    )
    return _cut_spans(rows, keys)


def _bounds(members: DataFrame, active: DataFrame, date_min, date_max) -> tuple[Column, Column]:
    if date_min is not None:
        first = as_date(date_min)
    else:
        first = F.least(
            members.agg(F.min("signup_date")).scalar(), active.agg(F.min("date")).scalar()
        )
    if date_max is not None:
        last = as_date(date_max)
    else:
        last = F.greatest(
            members.agg(F.max("signup_date")).scalar(), active.agg(F.max("date")).scalar()
        )
    if date_min is not None and date_max is not None:
        return first, last
    return first, checked_last_day(first, last)


def _cut_spans(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows` has the active days of each user with signup_date, first_day and last_day; a user without
    activity has one row with a null date."""
    per_user = W.partitionBy("user_id").orderBy("date")
    previous, following = F.lag("date").over(per_user), F.lead("date").over(per_user)
    day, signup = F.col("date"), F.col("signup_date")
    after_signup = F.date_add(signup, 1)
    linked = rows.select(
        "user_id", *keys, "date", "signup_date", "first_day", "last_day",
        previous.alias("previous"),
        (F.row_number().over(per_user) == 1).alias("is_first"),
        F.coalesce(F.date_sub(following, 1), F.col("last_day")).alias("day_before_next"),
    )
    before_next = F.col("day_before_next")

    def span(state, start, end, condition=None):
        """The state over [start, end], cut to the reported days; null where nothing remains."""
        start = F.greatest(start, F.col("first_day"))
        end = F.least(end, F.col("last_day"))
        nonempty = start <= end
        if condition is not None:
            nonempty = condition & nonempty
        return F.when(
            nonempty,
            F.struct(state.alias("label"), start.alias("start"), F.date_add(end, 1).alias("stop")),
        )

    def later(start):
        return F.greatest(start, after_signup)

    active = day.isNotNull()
    first = F.col("is_first")
    spans = F.array(
        span(F.lit("New"), signup, signup, first),
        span(F.lit("Dormant"), after_signup, F.coalesce(F.date_sub(day, 1), F.col("last_day")), first),
        span(returning_state(F.datediff(day, F.col("previous"))), later(day), day, active),
        span(F.lit("AtRiskWAU"), later(F.date_add(day, 1)),
             F.least(F.date_add(day, 6), before_next), active),
        span(F.lit("AtRiskMAU"), later(F.date_add(day, 7)),
             F.least(F.date_add(day, 29), before_next), active),
        span(F.lit("Dormant"), later(F.date_add(day, 30)), before_next, active),
        # Every group reports from the first day on, whatever its users do.
        F.when(first & (F.col("first_day") <= F.col("last_day")), F.struct(
            F.lit("").alias("label"), F.col("first_day").alias("start"),
            F.col("first_day").alias("stop"))),
    )
    return (
        linked.select("user_id", *keys, F.col("last_day").alias("until"), F.explode(spans).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("user_id", *keys, "until", "s.*")
    )


def build_agg_lifecycle_daily(
    fact_user_daily: DataFrame,
    *,
    group_cols: Sequence[str] | None = ("variant",),
    unique_grain: bool = False,
) -> DataFrame:
    """date, state, keys, users: observed states only.

    Users are counted distinctly. A fact built by this package has one row per user and day; there
    `unique_grain=True` counts rows, which spares a shuffle of the largest table.
    """
    keys = group_keys(group_cols)
    count = F.count("user_id") if unique_grain else F.count_distinct("user_id")
    return (
        fact_user_daily.withColumn("date", strict_date(F.col("date"), "date"))
        .withColumnRenamed("lifecycle_state", "state")
        .dropna(subset=["state", *keys])
        .groupBy("date", "state", *keys)
        .agg(count.alias("users"))
    )


def lifecycle_wide(counts: DataFrame, *, variant: str | None = None) -> DataFrame:
    """States as columns by date, missing states 0; one arm, or the mean over the groups."""
    if variant is not None:
        counts = counts.filter(F.col("variant") == variant)
    return counts.groupBy("date").pivot("state", STATES).agg(F.avg("users")).fillna(0)


def lifecycle_by_arm(counts: DataFrame, arms: Sequence[str] = ("control", "treatment")) -> DataFrame:
    """One column per arm and state by date; cells without a row stay null."""
    cells = [f"{arm}_{state}" for arm in arms for state in STATES]
    keyed = counts.withColumn("cell", F.concat_ws("_", "variant", "state"))
    return keyed.groupBy("date").pivot("cell", cells).agg(F.avg("users"))


def lifecycle_transitions(fact_user_daily: DataFrame) -> DataFrame:
    """state, next_state, transitions, probability: moves from one day to the next, each row of the
    matrix adding up to one."""
    per_user = W.partitionBy("user_id").orderBy("date")
    moves = fact_user_daily.select(
        F.col("lifecycle_state").alias("state"),
        F.lead("lifecycle_state").over(per_user).alias("next_state"),
    )
    counts = (
        moves.filter(F.col("next_state").isNotNull())
        .groupBy("state", "next_state")
        .agg(F.count(F.lit(1)).alias("transitions"))
    )
    return transition_shares(counts)


def transition_shares(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counted moves with the share of each among the moves out of its state."""
    total = F.sum("transitions").over(W.partitionBy(*keys, "state"))
    return counts.withColumn("probability", divide_or_null(F.col("transitions"), total))


def decomposition_report(fact_user_daily: DataFrame) -> DataFrame:
    """Per day: active users, users in the four active states, and whether the two agree. They
    differ by the new users who were not active on their signup day."""
    in_active_state = F.col("lifecycle_state").isin(ACTIVE_STATES)
    daily = fact_user_daily.groupBy("date").agg(
        F.sum(F.col("is_active").cast("bigint")).alias("active_users"),
        F.count_if(in_active_state).alias("active_state_users"),
        F.count_if((F.col("lifecycle_state") == "New") & (F.col("is_active") == 0)).alias("inactive_new"),
    )
    return daily.withColumn("holds", F.col("active_users") == F.col("active_state_users"))
