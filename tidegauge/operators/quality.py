"""Data-quality checks. Every check is one row of a report: check, table, violations, passed.

Row checks of one table share one scan. Reference checks count rows per key on the map side before
they meet the other table, so a key with a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.scalars import blank_to_null, flag, is_one_of, seconds_between
from tidegauge.operators.prepare import active_names
from tidegauge.schemas import EVENT_TAXONOMY, FUNNEL_STEPS, LESSON_FLOW_EVENTS, PRIMARY_KEYS, RAW_TABLES

# Fixed value: stored and recomputed session durations may differ by this many seconds.
DURATION_TOLERANCE_SEC = 2


def _not(condition: Column) -> Column:
    """1 where the condition is false or null."""
    return flag(~F.coalesce(condition, F.lit(False)))


def _report(counts: DataFrame, table: str, checks: Sequence[str]) -> DataFrame:
    """A one-row frame of counts, one column per check, as report rows."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias("violations"))
        for c in checks
    ])).alias("r")
    return counts.select(rows).select(
        "r.check", F.lit(table).alias("table"), "r.violations", (F.col("r.violations") == 0).alias("passed")
    )


def _unanswerable(df: DataFrame, table: str, checks: Sequence[str]) -> list[DataFrame]:
    """Report rows for checks whose columns are missing: no count, not passed."""
    if not checks:
        return []
    spark = df.sparkSession
    rows = [(c, table, None, False) for c in checks]
    return [spark.createDataFrame(rows, "check string, table string, violations bigint, passed boolean")]


def row_checks(df: DataFrame, table: str, checks: dict[str, tuple[Sequence[str], Column]]) -> DataFrame:
    """One scan for all checks of a table. A check is its columns and a 0/1 violation expression."""
    usable = [c for c, (needs, _) in checks.items() if set(needs) <= set(df.columns)]
    parts = _unanswerable(df, table, [c for c in checks if c not in usable])
    if usable:
        counts = df.agg(*[F.sum(checks[c][1]).alias(c) for c in usable])
        parts.append(_report(counts, table, usable))
    return _union(parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is null or not unique, as one row with a count."""
    keys = [key] if isinstance(key, str) else list(key)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bad = F.when((F.col("n") > 1) | ~known, F.col("n"))
    return sizes.agg(F.coalesce(F.sum(bad), F.lit(0)).alias("violations"))


def check_key(df: DataFrame, table: str, key: str | Sequence[str]) -> DataFrame:
    name = f"unique_{key if isinstance(key, str) else '_'.join(key)}"
    return _report(key_violations(df, key).withColumnRenamed("violations", name), table, [name])


def reference_violations(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows of `df` whose non-null reference has no target, as one row with a count."""
    used = df.groupBy(F.col(column).alias("ref")).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(F.col(target_column).alias("ref"))
    missing = used.filter(F.col("ref").isNotNull()).join(known, "ref", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def check_reference(df, table: str, column: str, target, target_column: str, name: str) -> DataFrame:
    counted = reference_violations(df, column, target, target_column)
    return _report(counted.withColumnRenamed("violations", name), table, [name])


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Columns of the full layout that the table lacks; looks at names only."""
    return [c for c in RAW_TABLES[table].fieldNames() if c not in df.columns]


def check_columns(df: DataFrame, table: str) -> DataFrame:
    n = len(missing_columns(df, table))
    return df.sparkSession.createDataFrame(
        [("columns_present", table, n, n == 0)],
        "check string, table string, violations bigint, passed boolean",
    )


def check_users(users: DataFrame) -> DataFrame:
    known = {"signup_time": "signup_time_known", "signup_date": "signup_date_known"}
    return row_checks(users, "users", {
        name: ([c], flag(F.col(c).isNull())) for c, name in known.items()
    })


def duration_difference() -> Column:
    """Seconds between the stored and the recomputed session duration."""
    recomputed = seconds_between(F.col("session_start"), F.col("session_end"))
    return F.abs(recomputed - F.col("session_duration_sec"))


def with_user_lookup(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Facts with u_known, u_signup_time and u_variant of their user (null where there is none).

    One left join serves all checks against users; adaptive execution broadcasts a small user table
    and splits the partition of a hot or missing user otherwise.
    """
    wanted = {"signup_time": "u_signup_time", "variant": "u_variant"}
    found = {c: name for c, name in wanted.items() if c in users.columns}
    lookup = users.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.lit(True).alias("u_known"), *[F.min(c).alias(name) for c, name in found.items()]
    )
    return facts.join(lookup, "user_id", "left")


def _user_checks(time_col: str) -> dict[str, tuple[Sequence[str], Column]]:
    return {
        "user_exists": (["u_known"], flag(F.col("u_known").isNull())),
        "not_before_signup": (["u_signup_time", time_col], flag(F.col(time_col) < F.col("u_signup_time"))),
    }


def check_session_rows(sessions: DataFrame, users: DataFrame) -> DataFrame:
    window = ["session_start", "session_end"]
    return row_checks(with_user_lookup(sessions, users), "sessions", {
        **_user_checks("session_start"),
        "session_start_known": (["session_start"], flag(F.col("session_start").isNull())),
        "session_end_known": (["session_end"], flag(F.col("session_end").isNull())),
        "end_not_before_start": (window, _not(F.col("session_end") >= F.col("session_start"))),
        "duration_not_negative": (["session_duration_sec"], _not(F.col("session_duration_sec") >= 0)),
        "duration_matches": (
            [*window, "session_duration_sec"], _not(duration_difference() <= DURATION_TOLERANCE_SEC)
        ),
    })


def check_event_rows(
    events: DataFrame,
    users: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    taxonomy: Sequence[str] = tuple(EVENT_TAXONOMY),
    lesson_flow: Sequence[str] = tuple(LESSON_FLOW_EVENTS),
) -> DataFrame:
    name = F.col("event_name")
    in_flow = is_one_of(name, lesson_flow)
    completed = F.coalesce(name == "lesson_completed", F.lit(False))
    active = is_one_of(name, active_names(active_event_names))
    return row_checks(with_user_lookup(events, users), "events", {
        **_user_checks("event_time"),
        "active_rows_have_variant": (
            ["event_name", "u_variant"], flag(active & F.col("u_variant").isNull())
        ),
        "event_time_known": (["event_time"], flag(F.col("event_time").isNull())),
        "event_date_known": (["event_date"], flag(F.col("event_date").isNull())),
        "date_matches_time": (
            ["event_time", "event_date"], _not(F.to_date("event_time") == F.col("event_date").try_cast("date"))
        ),
        "name_in_taxonomy": (["event_name"], flag(~is_one_of(name, taxonomy))),
        "xp_not_negative": (
            ["event_name", "xp_delta"], flag(completed) * _not(F.col("xp_delta") >= 0)
        ),
        "streak_not_negative": (["streak_length"], _not(F.col("streak_length") >= 0)),
        "lesson_present": (
            ["event_name", "lesson_id"], flag(in_flow & blank_to_null(F.col("lesson_id")).isNull())
        ),
    })


def before_signup(facts: DataFrame, users: DataFrame, time_col: str) -> DataFrame:
    """Rows of `facts` earlier than the signup time of their user."""
    signup = users.groupBy("user_id").agg(F.min("signup_time").alias("signup_time"))
    return facts.join(signup, "user_id").filter(F.col(time_col) < F.col("signup_time"))


def _count(df: DataFrame, table: str, name: str) -> DataFrame:
    return _report(df.agg(F.count(F.lit(1)).alias(name)), table, [name])


def events_with_window(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events that name a session, with that session's start and end (null where it is unknown)."""
    named = events.filter(blank_to_null(F.col("session_id")).isNotNull())
    window = sessions.select("session_id", "session_start", "session_end")
    return named.join(window, "session_id", "left")


def check_session_window(events: DataFrame, sessions: DataFrame) -> DataFrame:
    time, start, end = F.col("event_time"), F.col("session_start"), F.col("session_end")
    counts = events_with_window(events, sessions).agg(
        F.sum(flag(start.isNull())).alias("session_found"),
        F.sum(flag(time < start)).alias("not_before_session"),
        F.sum(flag(time > end)).alias("not_after_session"),
    )
    return _report(counts, "events", ["session_found", "not_before_session", "not_after_session"])


def session_gaps(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events before the start of their session, with the (negative) gap in seconds."""
    early = events_with_window(events, sessions).filter(F.col("event_time") < F.col("session_start"))
    micros = F.timestamp_diff("MICROSECOND", F.col("session_start"), F.col("event_time"))
    return early.select(
        "event_id", "event_name", "user_id", "session_id", "event_time", "session_start",
        "session_end", (micros / F.lit(1_000_000.0)).alias("gap_sec"),
    )


def largest_session_gaps(events: DataFrame, sessions: DataFrame, n: int = 20) -> DataFrame:
    """The n events furthest before their session."""
    return session_gaps(events, sessions).orderBy("gap_sec", "event_id").limit(n)


def date_mismatches(events: DataFrame, n: int = 20) -> DataFrame:
    """Examples of events whose date is not the day of their time."""
    matches = F.to_date("event_time") == F.col("event_date")
    bad = events.filter(~F.coalesce(matches, F.lit(False)))
    return bad.select("event_id", "event_time", "event_date").orderBy("event_id").limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


_OCTAVE, _SLICES = 64, 4096  # ranges per factor of e, and slices of a range that holds a rank


def _range_of(v: Column) -> Column:
    """Number of the range of a value: it never falls where values rise, and there are at most 90,000 of them."""
    size = F.when(v < 0, -F.log1p(-v)).otherwise(F.log1p(v))
    return F.when(F.isnan(v), F.lit(2**62)).otherwise(F.greatest(
        F.lit(-(2**61)), F.least(F.lit(2**61), F.floor(size * _OCTAVE)))).cast("bigint")


def _slice_of(v: Column) -> Column:
    """Number of the slice of a value between the least and the greatest value of its range."""
    share = F.try_divide(v - F.col("low"), F.col("high") - F.col("low"))
    return F.when(share.isNull() | F.isnan(share), F.lit(0)).otherwise(F.floor(share * _SLICES)).cast("bigint")


def _holding(parts: DataFrame, within: Sequence[str], order: str, *kept: str) -> DataFrame:
    """The parts of each `within` that hold one of its `ranks`, with these counted from the part's own first row."""
    group = W.partitionBy(*within) if within else W.partitionBy()
    before = F.sum("n").over(group.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    counted = parts.withColumn("before", before)
    inside = F.transform(
        F.filter("ranks", lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n"))),
        lambda r: F.struct(r["place"].alias("place"), (r["rank"] - F.col("before")).alias("rank")))
    return counted.withColumn("ranks", inside).where(F.size("ranks") > 0).select(*within, order, "ranks", *kept)


def distribution(df: DataFrame, value: Column | str, percentages: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row: count, mean, std, min, exact percentiles p25.. and max; nulls do not count.

    Ranks are selected, values are not sorted: values are counted by ranges of a fixed width on a logarithmic
    scale, then only those of the ranges that hold a rank by equal slices, and then only those of the slices that
    hold one by value. Every count is combined on the map side, and no window sees more than the ranges, the slices
    of a range, or the distinct values of a slice. The input is read three times; store it first if it is dear.
    """
    column = F.col(value) if isinstance(value, str) else value
    values = df.select(column.cast("double").alias("v")).filter("v is not null").withColumn("range", _range_of(F.col("v")))
    ranges = values.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("mean"),
        F.var_pop("v").alias("var"))

    all_ranges = W.partitionBy()
    total = F.sum("n").over(all_ranges)
    places = [F.lit(float(p)) * (total - 1) for p in percentages]
    ranks = F.array(*[
        F.struct(F.lit(2 * i + up).alias("place"), f(place).cast("bigint").alias("rank"))
        for i, place in enumerate(places) for up, f in enumerate((F.floor, F.ceil))])
    held = _holding(ranges.withColumn("ranks", ranks), [], "range", "low", "high")
    slices = values.join(held.select("range", "low", "high"), "range").groupBy("range", _slice_of(F.col("v")).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"))
    sliced = _holding(slices.join(held.select("range", "ranks"), "range"), ["range"], "slice")
    bounds = sliced.join(held.select("range", "low", "high"), "range")
    found = values.join(bounds.select("range", "low", "high").distinct(), "range").withColumn("slice", _slice_of(F.col("v")))
    counts = found.join(sliced.select("range", "slice"), ["range", "slice"]).groupBy("range", "slice", "v").agg(
        F.count(F.lit(1)).alias("n"))
    picked = _holding(counts.join(sliced, ["range", "slice"]), ["range", "slice"], "v").select(
        "v", F.explode("ranks.place").alias("place"))

    moments = ranges.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean"),
        F.min("low").alias("min"), F.max("high").alias("max"),
        F.collect_list(F.struct("n", "mean", "var")).alias("parts"))
    spread = F.aggregate("parts", F.lit(0.0), lambda acc, x: acc + x["n"] * (x["var"] + F.pow(x["mean"] - F.col("mean"), 2)))
    summary = moments.select(
        "count", "mean", F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))).alias("std"), "min", "max")

    # The one row of moments and the few picked values meet in one small aggregation.
    rows = summary.unionByName(picked, allowMissingColumns=True)

    def percentile(i: int, p: float) -> Column:
        low, high = (F.max(F.when(F.col("place") == 2 * i + up, F.col("v"))) for up in (0, 1))
        place = F.lit(float(p)) * (F.max("count") - 1)
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    return rows.agg(
        F.max("count").alias("count"), F.max("mean").alias("mean"), F.max("std").alias("std"), F.max("min").alias("min"),
        *[percentile(i, p).alias(f"p{round(p * 100)}") for i, p in enumerate(percentages)], F.max("max").alias("max"))


def unknown_names(events: DataFrame, taxonomy: Sequence[str] = tuple(EVENT_TAXONOMY)) -> DataFrame:
    """Event names outside the taxonomy."""
    return events.select("event_name").distinct().filter(~is_one_of(F.col("event_name"), taxonomy))


def duration_differences(sessions: DataFrame) -> DataFrame:
    return distribution(sessions, duration_difference())


def _counts_by_user(events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per date, event and user: everything the daily pivots need, at one row per user."""
    return (
        events.filter(F.col("event_name").isin(list(names)))
        .groupBy("event_date", "event_name", "user_id").agg(F.count(F.lit(1)).alias("n"))
    )


def _cells(names: Sequence[str], measure: Column, suffix: str = "") -> list[Column]:
    return [
        F.sum(F.when(F.col("event_name") == n, measure).otherwise(0)).alias(n + suffix) for n in names
    ]


def event_counts_by_day(events: DataFrame, names: Sequence[str] = tuple(FUNNEL_STEPS[1:])) -> DataFrame:
    """Rows per date and event, events as columns, missing 0."""
    picked = events.filter(F.col("event_name").isin(list(names)))
    return picked.groupBy("event_date").agg(*_cells(names, F.lit(1)))


def event_users_by_day(events: DataFrame, names: Sequence[str] = tuple(FUNNEL_STEPS[1:])) -> DataFrame:
    """Distinct users per date and event, events as columns, missing 0."""
    known = flag(F.col("user_id").isNotNull())
    return _counts_by_user(events, names).groupBy("event_date").agg(*_cells(names, known))


def check_funnel_order(events: DataFrame) -> DataFrame:
    """Days on which a later step outnumbers the one before, by events and by users."""
    steps = FUNNEL_STEPS[1:]
    daily = _counts_by_user(events, steps).groupBy("event_date").agg(
        *_cells(steps, F.col("n"), "_events"), *_cells(steps, flag(F.col("user_id").isNotNull()), "_users")
    )
    checks = {
        f"{b}_within_{a}_{unit}": flag(F.col(f"{b}_{unit}") > F.col(f"{a}_{unit}"))
        for unit in ("events", "users") for a, b in zip(steps, steps[1:])
    }
    counts = daily.agg(*[F.sum(c).alias(n) for n, c in checks.items()])
    return _report(counts, "events", list(checks))


def lesson_order_violations(events: DataFrame) -> DataFrame:
    """Sessions whose first completion comes before the first start.

    The two minima of a session come out of one aggregation; the self join of starts and
    completions is not needed. Events without a session id belong to no session.
    """
    name, time = F.col("event_name"), F.col("event_time")
    in_session = blank_to_null(F.col("session_id")).isNotNull()
    firsts = (
        events.filter(name.isin("lesson_started", "lesson_completed") & in_session)
        .groupBy("user_id", "session_id")
        .agg(
            F.min(F.when(name == "lesson_started", time)).alias("t_started"),
            F.min(F.when(name == "lesson_completed", time)).alias("t_completed"),
        )
    )
    return firsts.filter(F.col("t_completed") < F.col("t_started"))


def check_lessons(events: DataFrame, lessons: DataFrame) -> DataFrame:
    """Lesson flow events that name a lesson nobody knows."""
    in_flow = events.filter(
        F.col("event_name").isin(LESSON_FLOW_EVENTS) & blank_to_null(F.col("lesson_id")).isNotNull()
    )
    return check_reference(in_flow, "events", "lesson_id", lessons, "lesson_id", "lesson_exists")


def quality_report(
    users: DataFrame,
    sessions: DataFrame,
    events: DataFrame,
    lessons: DataFrame | None = None,
    *,
    taxonomy: Sequence[str] = tuple(EVENT_TAXONOMY),
    active_event_names: Sequence[str] | None = None,
    full_layout: bool = False,
) -> DataFrame:
    """All checks that the given tables allow, as one frame. With `full_layout` the column sets of
    the tables are compared with the data model as well."""
    tables = {"users": users, "sessions": sessions, "events": events}
    if lessons is not None:
        tables["lessons"] = lessons
    parts = [check_key(df, name, PRIMARY_KEYS[name]) for name, df in tables.items()]
    if full_layout:
        parts += [check_columns(df, name) for name, df in tables.items()]
    parts += [
        check_users(users),
        check_session_rows(sessions, users),
        check_event_rows(
            events, users, active_event_names=active_event_names, taxonomy=taxonomy
        ),
        check_funnel_order(events),
    ]
    if "session_id" in events.columns:
        parts += [
            check_session_window(events, sessions),
            _count(lesson_order_violations(events), "events", "completed_after_started"),
        ]
    if lessons is not None and "lesson_id" in events.columns:
        parts.append(check_lessons(events, lessons))
    return _union(parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows: one count per table in one frame."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ])
