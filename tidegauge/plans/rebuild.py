"""The derived tables range by range: a build of some days replaces those days, keeps all others, and goes on from
the state of the users at the end of the day before."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.functions.checks import validate_minimum_columns
from tidegauge.operators.fact import FACT_COLUMNS, busy_spans, fact_of_spans, spans_by_month
from tidegauge.operators.funnel import build_agg_funnel_daily
from tidegauge.operators.kpis import agg_daily_kpis_of_days
from tidegauge.operators.prepare import active_user_days, as_date, group_keys, only_days, unique_users
from tidegauge.operators.retention import build_agg_retention_cohort
from tidegauge.operators.sparse import agg_lifecycle_of_days, daily_sums
from tidegauge.plans.build_tables import DEFAULT_GROUP_COLS, DEFAULT_RETENTION_DAYS
from tidegauge.schemas import USER_STATE
from tidegauge.session import has_checkpoint_dir, materialize
from tidegauge.sources.files import checked_format, read_raw_tables, read_table, require_paths, table_path, write_table

# Every table is split by the column whose values a range replaces.
SPLIT = {
    "fact_user_daily": "date", "agg_daily_kpis": "date", "agg_retention_cohort": "cohort_date",
    "agg_funnel_daily": "date", "agg_lifecycle_daily": "date",
}
STATE, AS_OF = "user_state", "as_of"
TOTALS = ["active_days", "sessions_count", "session_duration_sec", "lessons_completed", "xp_earned", "hearts_lost"]
_TRAILING = 29  # days before a day that still count for its monthly users


def _day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def user_state(spans: DataFrame, previous: DataFrame | None, horizon: Column) -> DataFrame:
    """One row per user at the end of the spans: last active day, last known premium status and totals since the
    signup, with the last day of the spans (`as_of`) and the last active day of all (`horizon`)."""
    busy = F.col("f_date")
    premium_day = F.when(F.col("is_premium").isNotNull(), busy)
    sums = {"active_days": F.col("is_active"), **{c: F.col(c) for c in TOTALS[1:]}}
    now = spans.groupBy("user_id").agg(
        F.max(F.when(F.col("is_active") == 1, busy)).alias("last_active"),
        F.max(premium_day).alias("last_premium_day"),
        F.max_by("is_premium", premium_day).alias("last_premium"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for name, c in sums.items()],
    )
    if previous is not None:
        old = previous.select("user_id", *[
            F.col(c).alias(f"old_{c}") for c in ("last_active", "last_premium_day", "last_premium", *TOTALS)])
        now = now.join(old, "user_id", "full").select(
            "user_id", F.coalesce("last_active", "old_last_active").alias("last_active"),
            F.coalesce("last_premium_day", "old_last_premium_day").alias("last_premium_day"),
            F.coalesce("last_premium", "old_last_premium").alias("last_premium"),
            *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"old_{c}", F.lit(0))).alias(c) for c in TOTALS],
        )
    return now.withColumns({"horizon": horizon, AS_OF: spans.agg(F.max("last")).scalar()})


def read_state(spark: SparkSession, out_dir: str, as_of: date, file_format: str) -> DataFrame:
    """The state at the end of a day; an error names the days there are if that one was never an end."""
    path = table_path(out_dir, STATE, file_format)
    require_paths(spark, {STATE: path}, file_format)
    stored = read_table(spark, path, file_format, USER_STATE)
    found = stored.where(F.col(AS_OF) == as_date(str(as_of)))
    if found.isEmpty():
        ends = ", ".join(str(r[0]) for r in stored.select(AS_OF).distinct().orderBy(AS_OF).collect())
        raise ValueError(f"No build has ended on {as_of}; builds have ended on {ends}")
    return found


def rebuild_days(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    *,
    date_min: str | date | None = None,
    date_max: str | date | None = None,
    retention_days: Sequence[int] = DEFAULT_RETENTION_DAYS,
    group_cols: Sequence[str] = DEFAULT_GROUP_COLS,
    file_format: str = "parquet",
    raw_format: str = "parquet",
    tables: Sequence[str] = tuple(SPLIT),
) -> dict[str, str]:
    """Build the days from `date_min` to `date_max` of the derived tables and leave all other days alone; returns
    the paths. Builds of consecutive ranges give the tables of one build over all their days.

    The first range has no `date_min`; any other starts on the day after some build ended, whose state it reads.
    Only partitions that a result can depend on are read: the range for the fact and the funnel, 31 days more for
    lifecycle states, and for retention the days since the first cohort that is still open. Two tables write some
    older partitions again: the KPIs of the 29 days before, as a group's trailing users are counted up to its
    last active day only, and the cohorts that were still open.

    Overwrites are dynamic, one partition of a table each, so that a rerun replaces what a lost run left. Days
    after the range keep what they had; where the activity of the range has changed, build them again too. A day
    that has lost all its rows keeps the old ones."""
    name = checked_format(file_format)
    unknown = sorted(set(tables) - set(SPLIT))
    if unknown:
        raise ValueError(f"unknown tables {unknown}; known are {list(SPLIT)}")
    users, sessions, events, _ = read_raw_tables(spark, data_dir, raw_format)
    validate_minimum_columns(users, sessions, events)
    keys = group_keys(group_cols)
    first, last = (None if d is None else _day(d) for d in (date_min, date_max))
    previous = None if first is None else read_state(spark, out_dir, first - timedelta(days=1), name)
    if previous is not None and has_checkpoint_dir(spark):
        previous = materialize(previous)  # the state is written to the table that it is read from

    def spans_from(start: date | None, carried: DataFrame | None = None) -> DataFrame:
        return busy_spans(
            users, events, sessions, date_min=start, date_max=last, carried=carried,
            keep_user_cols=[k for k in keys if k not in FACT_COLUMNS])

    def events_from(start: date | Column | None, end: date | Column | None = last) -> DataFrame:
        return only_days(events, start, end, day="event_date", moment="event_time")

    spans = spans_from(first, previous)
    if has_checkpoint_dir(spark):
        spans = materialize(spans)
    end = spans.agg(F.max("last")).first()[0]  # one date
    active = active_user_days(events_from(first, end)).agg(F.max("date")).first()[0]
    seen = None if previous is None else previous.agg(F.max("horizon")).first()[0]
    horizon = max((d for d in (active, seen) if d is not None), default=None)

    def kpis() -> DataFrame:
        start = None if first is None else first - timedelta(days=_TRAILING)
        days = daily_sums(spans if first is None else spans_from(start), keys)
        recent = events_from(None if start is None else start - timedelta(days=_TRAILING), end)
        return agg_daily_kpis_of_days(days, users, recent, group_cols=keys)

    def cohorts() -> DataFrame:
        members, recent = users, events_from(None, end)
        if first is not None:
            unseen = min(first, first if seen is None else seen + timedelta(days=1))
            oldest = unseen - timedelta(days=max(retention_days))
            ids = unique_users(users).where(F.col("signup_date") >= as_date(str(oldest)))
            members, recent = users.join(ids.select("user_id"), "user_id", "left_semi"), events_from(oldest, end)
        return build_agg_retention_cohort(members, recent, n_days=retention_days, by_variant="variant" in keys)

    made = {
        "fact_user_daily": lambda: fact_of_spans(spans_by_month(spans)),
        "agg_daily_kpis": kpis,
        "agg_retention_cohort": cohorts,
        "agg_funnel_daily": lambda: build_agg_funnel_daily(events_from(first, end), group_cols=keys),
        "agg_lifecycle_daily": lambda: agg_lifecycle_of_days(
            users, events, group_cols=keys, date_min=first, date_max=end, carried=first is not None),
    }
    for table in tables:
        write_table(
            made[table](), table_path(out_dir, table, name), name, partition_by=SPLIT[table],
            balanced=table == "fact_user_daily", only_these=True)
    # The state comes last, so that it stands only for a range whose tables are written.
    write_table(
        user_state(spans, previous, F.lit(horizon).cast("date")), table_path(out_dir, STATE, name), name,
        partition_by=AS_OF, only_these=True)
    return {t: table_path(out_dir, t, name) for t in (*tables, STATE)}
