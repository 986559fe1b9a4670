"""Cohort retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.operators.prepare import active_user_days, unique_users


def compute_retention(
    users: DataFrame,
    events: DataFrame,
    n_days: int | Sequence[int] = (1, 7, 30),
    *,
    active_event_names: Sequence[str] | None = None,
    by_variant: bool = True,
    drop_incomplete: bool = True,
) -> DataFrame:
    """Share of each signup cohort active on exactly signup + n.

    Every user is probed for all horizons at once: the offsets are exploded on the (small) user
    side and joined on the columns the distinct user-days are already partitioned by, so the events
    are shuffled once. The horizon is the last active event day; pairs past it are dropped, or
    kept with `is_fully_observed`.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    split = ["variant"] if by_variant and "variant" in users.columns else []
    matched = [c for c in split if c in events.columns]
    offsets = [n_days] if isinstance(n_days, int) else list(n_days)

    active = (
        active_user_days(events, active_event_names=active_event_names, group_cols=matched)
        .withColumnRenamed("date", "target_date")
        .withColumn("hit", F.lit(1))
    )
    horizon = active.agg(F.max("target_date")).scalar()
    probes = (
        unique_users(users, split)
        .dropna(subset=split or None)
        .withColumn("day_n", F.explode(F.array(*[F.lit(int(n)) for n in offsets])))
        .withColumn("target_date", F.date_add("signup_date", F.col("day_n")))
        .withColumn("observable", F.col("target_date") <= horizon)
        .filter(F.col("observable") if drop_incomplete else F.col("observable").isNotNull())
    )
    measures = [
        F.sum(F.coalesce("hit", F.lit(0))).alias("retained_users"),
        F.count("user_id").alias("cohort_size"),
    ]
    if not drop_incomplete:
        measures.append(F.bool_and("observable").alias("is_fully_observed"))
    cohorts = (
        probes.join(active, ["user_id", *matched, "target_date"], "left")
        .groupBy("signup_date", *split, "day_n")
        .agg(*measures)
        .withColumnRenamed("signup_date", "cohort_date")
        .withColumn("retention_rate", F.col("retained_users") / F.col("cohort_size"))
    )
    columns = ["cohort_date", *split, "retained_users", "day_n", "cohort_size", "retention_rate"]
    return cohorts.select(*columns, *([] if drop_incomplete else ["is_fully_observed"]))


_WORD = 63  # bits of a long that are used, so that none is negative


def activity_bitmaps(
    users: DataFrame,
    events: DataFrame,
    last_day: int = 90,
    *,
    active_event_names: Sequence[str] | None = None,
    by_variant: bool = True,
) -> DataFrame:
    """user_id, signup_date, (variant), bits, last_offset, horizon: one row per user. Bit n of `bits` (63 to a
    long) says whether the user was active on signup + n, for n from 0 to `last_day`; `last_offset` is the largest
    such n of all, also beyond, and `horizon` the last active day of anyone.

    User-days are folded into bits by one aggregation after their join with the users, whatever the number of
    horizons that are asked for later."""
    require_columns(users, ["user_id", "signup_date"], "users")
    split = ["variant"] if by_variant and "variant" in users.columns else []
    matched = [c for c in split if c in events.columns]
    active = active_user_days(events, active_event_names=active_event_names, group_cols=matched)
    horizon = active.agg(F.max("date")).scalar()
    members = unique_users(users, split).dropna(subset=split or None)
    offset = F.datediff("date", "signup_date")
    placed = members.join(active, ["user_id", *matched], "left").withColumn("offset", F.when(offset >= 0, offset))
    words = [
        F.coalesce(F.bit_or(F.when(
            F.col("offset").between(w * _WORD, min((w + 1) * _WORD - 1, last_day)),
            F.expr(f"shiftleft(1L, offset - {w * _WORD})"))), F.lit(0).cast("bigint"))
        for w in range(last_day // _WORD + 1)]
    per_user = placed.groupBy("user_id", "signup_date", *split).agg(
        *[w.alias(f"w{i}") for i, w in enumerate(words)], F.max("offset").alias("last_offset"))
    return per_user.select(
        "user_id", "signup_date", *split, F.array(*[f"w{i}" for i in range(len(words))]).alias("bits"), "last_offset",
        horizon.alias("horizon"))


def retention_of_bitmaps(
    bitmaps: DataFrame, n_days: Sequence[int] = (1, 7, 30), *, drop_incomplete: bool = True, unbounded: bool = False,
) -> DataFrame:
    """The table of `compute_retention` from activity bitmaps, for any set of horizons at once. With `unbounded`, a
    user counts for day n if active on that day or any later one."""
    split = [c for c in ("variant",) if c in bitmaps.columns]
    def kept(n: int) -> Column:
        if unbounded:
            return F.coalesce(F.col("last_offset") >= n, F.lit(False)).cast("bigint")
        return F.expr(f"shiftright(bits[{n // _WORD}], {n % _WORD}) & 1L")

    offsets = sorted(set(map(int, n_days)))
    counts = bitmaps.groupBy("signup_date", *split).agg(
        F.count("user_id").alias("cohort_size"), F.max("horizon").alias("horizon"),
        *[F.sum(kept(n)).alias(f"d{n}") for n in offsets])
    days = F.array(*[
        F.struct(F.lit(n).alias("day_n"), F.col(f"d{n}").alias("retained_users")) for n in offsets])
    rows = counts.withColumn("day", F.explode(days)).select("*", "day.*").withColumn(
        "observable", F.date_add("signup_date", F.col("day_n")) <= F.col("horizon"))
    shown = rows.select(
        F.col("signup_date").alias("cohort_date"), *split, "retained_users", "day_n", "cohort_size",
        (F.col("retained_users") / F.col("cohort_size")).alias("retention_rate"),
        F.col("observable").alias("is_fully_observed"))
    return shown.where("is_fully_observed").drop("is_fully_observed") if drop_incomplete else shown


def build_agg_retention_cohort(
    users: DataFrame,
    events: DataFrame,
    *,
    n_days: int | Sequence[int] = (1, 7, 30),
    active_event_names: Sequence[str] | None = None,
    by_variant: bool = True,
) -> DataFrame:
    """The dashboard table: fully observable cohort and horizon pairs only."""
    return compute_retention(
        users, events, n_days, active_event_names=active_event_names, by_variant=by_variant
    )
