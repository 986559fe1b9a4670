"""Comparison of experiment arms. Inputs are reduced to daily rows first; everything after that
works on at most one row per day and arm."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.functions.scalars import clip_at_zero, divide_or_null, flag, lift, strict_date, symmetric_gap
from tidegauge.operators.activity import rolling_mean
from tidegauge.operators.dashboards import event_guardrails, session_duration
from tidegauge.operators.prepare import (
    active_names,
    active_user_days,
    as_date,
    enough_volume,
    group_keys,
    in_window,
    prep_events,
    prep_sessions,
    unique_users,
    with_user_columns,
)

ARMS = ("control", "treatment")
CONTROL, TREATMENT = ARMS

# Limits of the pre-period comparison, daily and on 7-day means.
MAX_MEAN_DIFFERENCE = 0.01
MAX_P95_GAP = 0.15
MIN_CORRELATION = 0.97
MAX_P95_GAP_SMOOTH = 0.12
MIN_CORRELATION_SMOOTH = 0.98
MIN_DAYS = 10
# Fixed value: two-sided 5 % limit of the normal distribution.
SIGNIFICANT_Z = 1.96


def assign_variant(users: DataFrame, *, seed: int = 42, arms: Sequence[str] = ARMS) -> DataFrame:
    """Balanced arms within each signup date: a seeded random order, the first half (rounded down)
    is control, the rest treatment.

    The order is that of the MD5 of user and seed. Ranking one date in one task would not hold for a
    date with very many signups, so the order is cut into ranges of the hash: users are counted per
    range, and only ranks inside a range are windowed. A null signup date fails the job.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    position = F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.lit(str(seed))).cast("binary"))
    placed = users.withColumns({
        "signup_day": strict_date(F.col("signup_date"), "signup_date"), "position": position,
        "slice": F.substring(position, 1, 4),
    })
    sizes = placed.groupBy("signup_day", "slice").agg(F.count(F.lit(1)).alias("size"))
    by_date = W.partitionBy("signup_day")
    offsets = sizes.select(
        "signup_day", "slice",
        F.sum("size").over(by_date.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)).alias("before"),
        F.sum("size").over(by_date).alias("total"),
    )
    within = W.partitionBy("signup_day", "slice").orderBy("position", "user_id")
    ranked = placed.withColumn("rank", F.row_number().over(within)).join(offsets, ["signup_day", "slice"])
    first_half = F.col("rank") + F.coalesce("before", F.lit(0)) <= F.floor(F.col("total") / 2)
    variant = F.when(first_half, arms[0]).otherwise(arms[1])
    return ranked.withColumn("variant", variant).drop("signup_day", "position", "slice", "rank", "before", "total")


def rollout_date(users: DataFrame, days: int = 90) -> Column:
    """First signup date plus a number of days, as a scalar column."""
    first = users.agg(F.min(strict_date(F.col("signup_date"), "signup_date")))
    return F.date_add(first.scalar(), days)


def _user_days_by_arm(events, users, active_event_names=None) -> DataFrame:
    """Active user-days with the arm of the user table, whatever the events say."""
    return active_user_days(
        events.drop("variant"), active_event_names=active_event_names, group_cols=["variant"], users=users
    )


def _arm(measure, arm: str) -> Column:
    return F.when(F.col("variant") == arm, measure)


def dau_by_variant(
    events: DataFrame, users: DataFrame, *, active_event_names: Sequence[str] | None = None
) -> DataFrame:
    """date, control, treatment; null where an arm had no active user that day."""
    days = _user_days_by_arm(events, users, active_event_names).filter(F.col("variant").isNotNull())
    return days.groupBy("date").agg(*[
        F.nullif(F.count(_arm(F.col("user_id"), arm)), F.lit(0)).alias(arm) for arm in ARMS
    ])


def pre_period(daily: DataFrame, rollout) -> DataFrame:
    """Days strictly before the rollout on which both arms have a value."""
    return daily.filter(in_window(F.col("date"), end=rollout)).dropna(subset=list(ARMS))


def _comparison(daily: DataFrame) -> DataFrame:
    control, treatment = F.col(CONTROL).cast("double"), F.col(TREATMENT).cast("double")
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        divide_or_null(F.avg(treatment), F.avg(control)).alias("mean_ratio"),
        F.percentile(F.abs(symmetric_gap(treatment, control)), 0.95).alias("p95_abs_gap"),
        F.corr(control, treatment).alias("corr"),
    )


def aa_check(dau_wide: DataFrame, rollout, *, min_total: int = 50) -> DataFrame:
    """One row: days kept, mean ratio, 95th percentile of the absolute gap, correlation, and whether
    each rule holds. It reports; it never fails the job."""
    total = F.col(CONTROL) + F.col(TREATMENT)
    kept = pre_period(dau_wide, rollout).filter(enough_volume(total, min_total))
    rules = {
        "enough_days": F.col("days") > MIN_DAYS,
        "mean_ok": F.abs(F.col("mean_ratio") - 1.0) < MAX_MEAN_DIFFERENCE,
        "gap_ok": F.col("p95_abs_gap") < MAX_P95_GAP,
        "corr_ok": F.col("corr") > MIN_CORRELATION,
    }
    return _with_rules(_comparison(kept), rules)


def aa_check_smoothed(dau_wide: DataFrame, rollout, *, min_total: int = 50) -> DataFrame:
    """The same on 7-day means of the kept days; the rules are null with fewer than ten of them."""
    total = F.col(CONTROL) + F.col(TREATMENT)
    kept = pre_period(dau_wide, rollout).filter(enough_volume(total, min_total))
    for arm in ARMS:
        kept = rolling_mean(kept, arm, name=f"{arm}_avg", full_only=(arm == TREATMENT))
    smooth = kept.select("date", *[F.col(f"{arm}_avg").alias(arm) for arm in ARMS])
    enough = F.col("days") >= MIN_DAYS
    rules = {
        "corr_ok": F.when(enough, F.col("corr") > MIN_CORRELATION_SMOOTH),
        "gap_ok": F.when(enough, F.col("p95_abs_gap") < MAX_P95_GAP_SMOOTH),
    }
    return _with_rules(_comparison(smooth), rules)


def _with_rules(row: DataFrame, rules: dict[str, Column]) -> DataFrame:
    passed = F.lit(True)
    for name in rules:
        passed = passed & F.coalesce(F.col(name), F.lit(False))
    return row.withColumns(rules).withColumn("passed", passed)


def signup_share(users: DataFrame) -> DataFrame:
    """date, control, treatment, total, treat_share of the daily signups. A user counts once, on the
    earliest signup."""
    per_user = unique_users(users, ["variant"]).filter(F.col("variant").isNotNull())
    daily = per_user.groupBy(F.col("signup_date").alias("date")).agg(
        *[F.count(_arm(F.col("user_id"), arm)).alias(arm) for arm in ARMS]
    )
    total = F.col(CONTROL) + F.col(TREATMENT)
    return daily.withColumns({
        "total": total, "treat_share": divide_or_null(F.col(TREATMENT), total)
    })


def activity_rate(dau_wide: DataFrame, users: DataFrame, rollout=None) -> DataFrame:
    """DAU over the users signed up so far, per arm. A day without signups takes the last total."""
    base = dau_wide.dropna(subset=list(ARMS)) if rollout is None else pre_period(dau_wide, rollout)
    in_order = W.orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = signup_share(users).select(
        "date", *[F.sum(arm).over(in_order).alias(f"{arm}_cum") for arm in ARMS]
    )
    joined = base.join(totals, "date", "left")
    filled = joined.withColumns({
        f"{arm}_cum": F.last(f"{arm}_cum", ignorenulls=True).over(in_order) for arm in ARMS
    })
    return filled.withColumns({
        f"dau_rate_{arm}": divide_or_null(F.col(arm), F.col(f"{arm}_cum")) for arm in ARMS
    })


def activity_rate_correlation(rates: DataFrame) -> DataFrame:
    return rates.agg(F.corr(*[f"dau_rate_{arm}" for arm in ARMS]).alias("corr"))


def sessions_per_active_user(
    sessions: DataFrame,
    events: DataFrame,
    users: DataFrame | None = None,
    *,
    by_variant: bool = True,
    active_event_names: Sequence[str] | None = None,
) -> DataFrame:
    """date and sessions over active users, overall or one column per arm; null on days where one of
    the two is missing."""
    se = prep_sessions(sessions).withColumnRenamed("session_date", "date")
    if not by_variant:
        counted = se.groupBy("date").agg(F.count("session_id").alias("sessions"))
        active = active_user_days(events, active_event_names=active_event_names)
        active = active.groupBy("date").agg(F.count("user_id").alias("active"))
        ratio = divide_or_null(F.col("sessions"), F.col("active"))
        return counted.join(active, "date", "full").select("date", ratio.alias("sessions_per_active"))
    se = with_user_columns(se.drop("variant"), users, ["variant"], "sessions")
    counted = se.filter(F.col("variant").isNotNull()).groupBy("date").agg(*[
        F.nullif(F.count(_arm(F.col("session_id"), arm)), F.lit(0)).alias(f"s_{arm}") for arm in ARMS
    ])
    active = dau_by_variant(events, users, active_event_names=active_event_names)
    return counted.join(active, "date", "full").select("date", *[
        divide_or_null(F.col(f"s_{arm}"), F.col(arm)).alias(arm) for arm in ARMS
    ])


def average_streak(
    events: DataFrame,
    *,
    by_variant: bool = True,
    event_names: Sequence[str] = ("streak_incremented",),
) -> DataFrame:
    """Mean streak length of the streak events per day, overall or one column per arm."""
    ev = prep_events(events).filter(F.col("event_name").isin(list(event_names)))
    daily = ev.groupBy(F.col("event_date").alias("date"))
    if not by_variant:
        return daily.agg(F.avg("streak_length").alias("avg_streak"))
    return daily.agg(*[F.avg(_arm(F.col("streak_length"), arm)).alias(arm) for arm in ARMS])


def pre_post_summary(series: dict[str, DataFrame], rollout) -> DataFrame:
    """metric, control, treatment, diff_pct, window: mean of the daily values before and from the
    rollout on. Each series has date, control and treatment."""
    stacked = None
    for name, daily in series.items():
        part = daily.select(
            F.lit(name).alias("metric"), "date", *[F.col(arm).cast("double").alias(arm) for arm in ARMS]
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    window = F.when(in_window(F.col("date"), end=rollout), "pre").otherwise("post")
    means = stacked.groupBy("metric", window.alias("window")).agg(*[F.avg(arm).alias(arm) for arm in ARMS])
    return means.select(
        "metric", *ARMS, lift(F.col(TREATMENT), F.col(CONTROL)).alias("diff_pct"), "window"
    )


def opens_per_user(events: DataFrame, users: DataFrame, *, event_name: str = "app_open") -> DataFrame:
    """variant, opens_per_user over the users with at least one such event."""
    opens = (
        events.filter(F.col("event_name") == event_name)
        .groupBy("user_id").agg(F.count("event_id").alias("opens"))
    )
    arms = unique_users(users, ["variant"]).select("user_id", "variant")
    return (
        opens.join(arms, "user_id").filter(F.col("variant").isNotNull())
        .groupBy("variant").agg(F.avg("opens").alias("opens_per_user"))
    )


_KPI_MEASURES = ["dau", "wau", "mau", "sessions_per_active_user", "lessons_per_active_user"]


def kpi_lift(kpis: DataFrame, retention: DataFrame, days: DataFrame, start=None) -> DataFrame:
    """metric, control, treatment, lift: mean of the daily values per arm from `start` on, with
    retention by cohort day and the average streak of the user-days. `days` is a stored fact or its
    daily sums."""
    def since(df, column):
        return df if start is None else df.filter(F.col(column) >= as_date(start))

    daily = since(kpis, "date").groupBy("variant").agg(
        *[F.avg(F.col(m).cast("double")).alias(m) for m in _KPI_MEASURES]
    ).unpivot("variant", _KPI_MEASURES, "metric", "value")
    kept = (
        since(retention, "cohort_date")
        .groupBy("variant", F.concat(F.lit("d"), F.col("day_n"), F.lit("_retention")).alias("metric"))
        .agg(F.avg("retention_rate").alias("value"))
        .select("variant", "metric", "value")
    )
    user_days = F.sum("user_days") if "user_days" in days.columns else F.count("user_id")
    streak = since(days, "date").groupBy("variant").agg(
        divide_or_null(F.sum("streak_length_end_of_day"), user_days).alias("value")
    ).select("variant", F.lit("avg_streak").alias("metric"), "value")
    stacked = daily.unionByName(kept).unionByName(streak)
    return stacked.groupBy("metric").agg(
        *[F.max(_arm(F.col("value"), arm)).alias(arm) for arm in ARMS]
    ).withColumn("lift", lift(F.col(TREATMENT), F.col(CONTROL)))


GUARDRAILS = ["avg_session_duration_sec", "lesson_completion_rate", "hearts_lost_per_user", "purchase_conversion"]


def guardrails(
    sessions: DataFrame,
    events: DataFrame,
    users: DataFrame,
    *,
    group_cols: Sequence[str] = ("variant",),
    active_event_names: Sequence[str] | None = None,
    shown: str = "paywall_shown",
    bought: str = "purchase",
) -> DataFrame:
    """date, keys and the four guardrails: session duration, completions per start, hearts lost per
    active user and purchases per user who saw the paywall that day. The events are read once."""
    keys = group_keys(group_cols)
    of_events = event_guardrails(
        events, users, group_cols=keys, active_event_names=active_event_names, shown=shown, bought=bought
    )
    joined = session_duration(sessions, users, group_cols=keys).join(of_events, ["date", *keys], "full")
    return joined.select("date", *keys, *GUARDRAILS)


def guardrail_test(daily: DataFrame, metrics: Sequence[str] = tuple(GUARDRAILS), start=None) -> DataFrame:
    """metric, control, treatment, z, significant: two-sample z of the daily values of the arms."""
    if start is not None:
        daily = daily.filter(F.col("date") >= as_date(start))
    values = daily.select("variant", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        "variant", list(metrics), "metric", "value"
    )
    moments = values.groupBy("metric").agg(*[
        f(_arm(F.col("value"), arm)).alias(f"{name}_{arm}")
        for arm in ARMS
        for name, f in (("mean", F.avg), ("var", F.var_samp), ("n", F.count))
    ])
    error = F.sqrt(
        F.try_divide(F.col("var_control"), F.col("n_control"))
        + F.try_divide(F.col("var_treatment"), F.col("n_treatment"))
    )
    z = F.try_divide(F.col("mean_treatment") - F.col("mean_control"), error)
    return moments.select(
        "metric", F.col("mean_control").alias("control"), F.col("mean_treatment").alias("treatment"),
        z.alias("z"), (F.abs(z) > SIGNIFICANT_Z).alias("significant"),
    )


def user_guardrails(
    sessions: DataFrame,
    events: DataFrame,
    users: DataFrame,
    *,
    start=None,
    active_event_names: Sequence[str] | None = None,
    shown: str = "paywall_shown",
    bought: str = "purchase",
) -> DataFrame:
    """user_id, variant, metric, top, bottom: what each user adds to the two sums of each guardrail, which is their
    ratio: seconds per session, completions per started lesson, hearts lost per active day and days with a purchase
    per day on which the paywall was seen. Users without either sum are left out of a metric."""
    names = active_names(active_event_names)
    members = unique_users(users, ["variant"]).select("user_id", "variant")
    lengths = prep_sessions(sessions)
    days = prep_events(events, active_event_names=names)
    if start is not None:
        lengths = lengths.where(F.col("session_date") >= as_date(start))
        days = days.where(F.col("event_date") >= as_date(start))
    name = F.col("event_name")
    per_day = days.groupBy("user_id", "event_date").agg(
        F.count_if(name == "lesson_started").alias("started"), F.count_if(name == "lesson_completed").alias("completed"),
        F.sum(clip_at_zero(-F.col("hearts_delta"))).alias("hearts"),
        F.max(flag(F.col("is_active_event"))).alias("active"),
        F.max(flag(name == shown)).alias("saw"), F.max(flag(name == bought)).alias("paid"))
    of_events = per_day.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in ("started", "completed", "hearts", "active", "saw")],
        F.sum(F.col("saw") * F.col("paid")).alias("buying"))
    of_sessions = lengths.groupBy("user_id").agg(
        F.sum("session_duration_sec").alias("seconds"), F.count("session_duration_sec").alias("sessions"))
    sums = members.join(of_events, "user_id", "left").join(of_sessions, "user_id", "left")
    pairs = [("seconds", "sessions"), ("completed", "started"), ("hearts", "active"), ("buying", "saw")]
    metrics = F.array(*[
        F.struct(
            F.lit(m).alias("metric"), F.coalesce(F.col(a), F.lit(0)).cast("double").alias("top"),
            F.coalesce(F.col(b), F.lit(0)).cast("double").alias("bottom"))
        for m, (a, b) in zip(GUARDRAILS, pairs)])
    return sums.dropna(subset=["variant"]).select("user_id", "variant", F.explode(metrics).alias("m")).select(
        "user_id", "variant", "m.*").where((F.col("top") != 0) | (F.col("bottom") != 0))


def guardrail_by_user(user_sums: DataFrame) -> DataFrame:
    """metric, control, treatment, difference, low, high, z, significant: ratios of the sums of `user_guardrails` per
    arm, with a 95 % interval of their difference. Users are the independent units: the variance of a ratio comes from
    the variances and the covariance of its two sums over users (delta method), in one aggregation."""
    x, y = F.col("top"), F.col("bottom")
    n = F.count(F.lit(1))
    arms = user_sums.groupBy("metric", "variant").agg(
        n.alias("n"), F.avg(x).alias("x"), F.avg(y).alias("y"), F.var_samp(x).alias("xx"), F.var_samp(y).alias("yy"),
        F.covar_samp(x, y).alias("xy")).withColumn("ratio", F.try_divide(F.col("x"), F.col("y")))
    r = F.col("ratio")
    variance = F.try_divide(
        F.col("xx") - 2 * r * F.col("xy") + r * r * F.col("yy"), F.col("n") * F.col("y") * F.col("y"))
    both = arms.withColumn("variance", variance).groupBy("metric").agg(*[
        F.max(_arm(F.col(c), arm)).alias(f"{c}_{arm}") for c in ("ratio", "variance") for arm in ARMS])
    error = F.sqrt(F.greatest(F.col("variance_control") + F.col("variance_treatment"), F.lit(0.0)))
    difference = F.col("ratio_treatment") - F.col("ratio_control")
    z = F.try_divide(difference, error)
    return both.select(
        "metric", F.col("ratio_control").alias("control"), F.col("ratio_treatment").alias("treatment"),
        difference.alias("difference"), (difference - SIGNIFICANT_Z * error).alias("low"),
        (difference + SIGNIFICANT_Z * error).alias("high"), z.alias("z"), (F.abs(z) > SIGNIFICANT_Z).alias("significant"))


def guardrail_bootstrap(user_sums: DataFrame, rounds: int = 100, seed: int = 42, level: float = 0.95) -> DataFrame:
    """metric, difference, low, high: the interval of the difference of arms by a Poisson bootstrap over users.

    In each round a user counts 0, 1, 2, ... times, by a hash of the user, the round and the seed, the same in every
    metric and rerun. A user's sums are brought together first, so that a user is hashed once per round, whatever the
    number of metrics. Round 0 counts every user once and gives the difference itself. Weighted sums are combined on the
    map side; what is left is a row per round, metric and arm."""
    total, term = 0.0, math.exp(-1)
    steps = []
    for k in range(1, 18):
        total += term
        term /= k
        steps.append(total)
    per_user = user_sums.groupBy("user_id", "variant", "metric").agg(F.sum("top").alias("top"), F.sum("bottom").alias("bottom"))
    together = per_user.groupBy("user_id", "variant").agg(F.collect_list(F.struct("metric", "top", "bottom")).alias("sums"))
    turns = together.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds))))
    digest = F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.col("round"), F.lit(seed)))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0
    # A filter on the weight would be moved below the share and hash the user again for each of the steps.
    drawn = sum((flag(F.col("share") >= s) for s in steps), F.lit(0))
    weighed = turns.withColumn("share", F.when(F.col("round") > 0, share)).select(
        "variant", "round", F.explode("sums").alias("m"), F.when(F.col("round") == 0, 1).otherwise(drawn).alias("weight"))
    some = F.col("weight") > 0
    sums = weighed.groupBy("m.metric", "round", "variant").agg(
        *[F.sum(F.when(some, F.col("weight") * F.col(f"m.{c}"))).alias(c) for c in ("top", "bottom")],
        F.max("weight").alias("most")).where("most > 0").withColumn("ratio", F.try_divide("top", "bottom"))
    rounds_of = sums.groupBy("metric", "round").agg(*[F.max(_arm(F.col("ratio"), a)).alias(a) for a in ARMS]).withColumn(
        "gap", F.col(TREATMENT) - F.col(CONTROL))
    ends = [(1 - level) / 2, (1 + level) / 2]
    of_round = F.when(F.col("round") > 0, F.col("gap"))
    return rounds_of.where(F.col("metric").isNotNull()).groupBy("metric").agg(
        F.max(F.when(F.col("round") == 0, F.col("gap"))).alias("difference"),
        *[F.percentile(of_round, p).alias(e) for e, p in zip(("low", "high"), ends)],
        F.max("round").alias("drawn")).where("drawn > 0").drop("drawn")
