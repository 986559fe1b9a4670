"""Registered queries: each runs one operator over the whole test tables."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.operators import (
    activity,
    dashboards,
    engagement,
    experiment,
    fact,
    funnel,
    kpis,
    lifecycle,
    months,
    prepare,
    quality,
    retention,
    sparse,
    streaks,
)
from tidegauge.plans import build_tables, rebuild
from tidegauge.functions.scalars import percent_text
from tidegauge.session import scratch_folder
from tidegauge.sources import adapters, files, tables

# The test events cover 30 days, so the experiment is taken to start on day 15.
ROLLOUT_DAYS = 15
SHOWN, BOUGHT = "lesson_started", "lesson_completed"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of fractions depend on their order in the last digits, so they are compared to six."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


class Product:
    """The event data as product telemetry."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw_events(self):
        return adapters.table(self.spark, self.folder, "events")

    @cached_property
    def users(self):
        customer, nation = (adapters.table(self.spark, self.folder, n) for n in ("customer", "nation"))
        return adapters.product_users(self.raw_events, customer, nation)

    @cached_property
    def events(self):
        return adapters.product_events(self.raw_events)

    @cached_property
    def sessions(self):
        return adapters.product_sessions(self.events)

    @cached_property
    def events_in_sessions(self):
        return adapters.events_in_sessions(self.events)

    def fact(self, **options):
        return fact.build_fact_user_daily(self.users, self.events, self.sessions, **options)

    def last_day(self):
        return fact.last_fact_day(self.users, self.events, self.sessions)

    def days(self, keys=("variant",)):
        kept = [k for k in keys if k != "variant"]
        spans = fact.busy_spans(self.users, self.events, self.sessions, keep_user_cols=kept)
        return sparse.daily_sums(spans, keys)

    def kpis(self, keys=("variant",), days=None):
        days = self.days(keys) if days is None else days
        return kpis.agg_daily_kpis_of_days(days, self.users, self.events, group_cols=keys)

    def lifecycle_daily(self, keys=("variant",)):
        return sparse.agg_lifecycle_of_days(self.users, self.events, group_cols=keys, date_max=self.last_day())

    def tables(self, keys=("variant",)):
        return build_tables.build_dashboard_tables(self.users, self.events, self.sessions, group_cols=keys)

    def retention(self, n_days=(1, 7, 30)):
        return retention.build_agg_retention_cohort(self.users, self.events, n_days=n_days)

    def dau_wide(self):
        return experiment.dau_by_variant(self.events, self.users)

    def rollout(self):
        return experiment.rollout_date(self.users, ROLLOUT_DAYS)


class Orders:
    """The orders as telemetry: sparse activity over several years."""

    def __init__(self, spark: SparkSession, folder: str):
        orders, customer = (adapters.table(spark, folder, n) for n in ("orders", "customer"))
        self.users = adapters.order_users(orders, customer)
        self.events = adapters.order_events(orders)
        self.names = adapters.ORDER_EVENTS

    def sessions(self):
        """One session without duration per order."""
        start = F.col("event_time")
        return self.events.select(
            F.col("event_id").cast("string").alias("session_id"), "user_id",
            start.alias("session_start"), start.alias("session_end"),
            F.lit(0).alias("session_duration_sec"),
        )

    def fact(self):
        features = {
            "xp_delta": F.lit(0), "hearts_delta": F.lit(0), "streak_length": F.lit(0),
            "is_premium": F.lit(False),
        }
        return fact.build_fact_user_daily(
            self.users, self.events.withColumns(features), self.sessions(),
            active_event_names=self.names, keep_user_cols=["segment"],
        )


# --- active users -----------------------------------------------------------------------------

def dau(p):
    return activity.compute_dau(p.events)


def wau(p):
    return activity.compute_wau(p.events)


def mau(p):
    return activity.compute_mau(p.events)


def dau_all(p):
    return activity.compute_dau(p.events, group_cols=None)


def wau_all(p):
    return activity.compute_wau(p.events, group_cols=None)


def mau_all(p):
    return activity.compute_mau(p.events, group_cols=None)


def dau_country(p):
    return activity.compute_dau(p.events, group_cols=["country"], users=p.users)


def wau_country(p):
    return activity.compute_wau(p.events, group_cols=["country"], users=p.users)


def mau_orders(o):
    return activity.compute_mau(o.events, active_event_names=o.names, group_cols=None)


def active_users(p):
    return activity.compute_active_users(p.events)


def dau_rolling7(p):
    return rounded(activity.rolling_mean(dau_all(p), "dau"), "dau_7d_avg")


def dau_range(p):
    return activity.daily_range(dau_all(p))


def dau_segment(p):
    days = prepare.active_user_days(p.events)
    picked = prepare.filter_segment(
        days, p.users, date_from="2024-01-05", date_to="2024-01-25",
        signup_channel=["BUILDING", "MACHINERY"], variant="treatment",
    )
    return picked.groupBy("date").agg(F.count("user_id").alias("dau"))


# --- retention --------------------------------------------------------------------------------

def retention_variant(p):
    return retention.compute_retention(p.users, p.events)


def retention_all(p):
    return retention.compute_retention(p.users, p.events, by_variant=False)


def retention_incomplete(p):
    return retention.compute_retention(p.users, p.events, drop_incomplete=False)


def retention_curve(p):
    return retention.compute_retention(p.users, p.events, list(range(31)), by_variant=False)


def retention_orders(o):
    return retention.compute_retention(
        o.users, o.events, (1, 7, 30, 365), active_event_names=o.names
    )


def agg_retention_cohort(p):
    return p.retention()


def retention_trend(p):
    return dashboards.retention_trend(p.retention(), 7)


# --- sessions ---------------------------------------------------------------------------------

def sessionize(p):
    return engagement.sessions_from_events(p.events, gap=adapters.SESSION_GAP)


def session_of_event(p):
    return p.events_in_sessions.select("event_id", "user_id", "session_id")


def sessions_per_user(p):
    return engagement.compute_sessions_per_user(p.sessions, p.events, p.users)


def sessions_per_user_from_sessions(p):
    return engagement.compute_sessions_per_user(
        p.sessions, users=p.users, group_cols=["variant", "country"], active_user_source="sessions"
    )


# --- funnels ----------------------------------------------------------------------------------

def funnel_daily(p):
    return funnel.compute_lesson_funnel(p.events, by="date")


def funnel_cohort(p):
    return funnel.compute_lesson_funnel(p.events, users=p.users)


def funnel_cohort_country(p):
    return funnel.compute_lesson_funnel(p.events, users=p.users, group_cols=["country"])


def agg_funnel_daily(p):
    return funnel.build_agg_funnel_daily(p.events, group_cols=None)


# --- lifecycle and fact -----------------------------------------------------------------------

def lifecycle_counts(p):
    return lifecycle.compute_lifecycle_counts(p.events, p.users)


def lifecycle_counts_all(p):
    return lifecycle.compute_lifecycle_counts(
        p.events, p.users, group_cols=None, date_min="2024-01-10", date_max="2024-02-15"
    )


def lifecycle_counts_orders(o):
    return lifecycle.compute_lifecycle_counts(
        o.events, o.users, active_event_names=o.names, group_cols=["segment"]
    )


def lifecycle_recent_orders(o):
    """The last month of the calendar: only its events and the 31 days before are read."""
    return lifecycle.compute_lifecycle_counts(
        o.events, o.users, active_event_names=o.names, group_cols=None,
        date_min="2001-07-01", date_max="2001-07-31",
    )


def lifecycle_wide(p):
    return lifecycle.lifecycle_wide(lifecycle_counts(p), variant="control")


def lifecycle_by_arm(p):
    return lifecycle.lifecycle_by_arm(lifecycle_counts(p))


def lifecycle_since(p):
    return lifecycle.compute_lifecycle_counts(p.events, p.users, date_min="2024-01-12")


def fact_since(p):
    return p.fact(date_min="2024-01-12")


def user_spine_all(p):
    return fact.build_user_date_spine(p.users)


def user_spine(p):
    return fact.build_user_date_spine(p.users, date_min="2024-01-03", date_max="2024-01-30")


def fact_user_daily(p):
    return p.fact()


def fact_window(p):
    return p.fact(date_min="2024-01-08", date_max="2024-01-24")


def fact_first_users(p):
    return p.fact(sample_n_users=10, include_lifecycle=False)


def lifecycle_from_fact(p):
    plain = p.fact(include_lifecycle=False)
    return lifecycle.assign_lifecycle_state(plain).select("date", "user_id", "lifecycle_state")


def agg_daily_kpis(p):
    return p.kpis()


def agg_daily_kpis_country(p):
    return p.kpis(["country"])


def agg_lifecycle_daily(p):
    return p.lifecycle_daily()


def agg_lifecycle_orders(o):
    return sparse.agg_lifecycle_of_days(
        o.users, o.events, group_cols=["segment"], active_event_names=o.names,
        date_max=fact.last_fact_day(o.users, o.events, o.sessions()),
    )


def kpis_of_stored_fact(p):
    """The form for a fact that is there already."""
    return kpis.build_agg_daily_kpis(p.fact(), p.users, p.events)


def lifecycle_of_stored_fact(p):
    return lifecycle.build_agg_lifecycle_daily(p.fact())


def lifecycle_transitions(p):
    return lifecycle.lifecycle_transitions(p.fact())


def lifecycle_transitions_orders(o):
    return lifecycle.compute_lifecycle_transitions(
        o.events, o.users, active_event_names=o.names,
        date_max=fact.last_fact_day(o.users, o.events, o.sessions()),
    )


def transitions_from_spans(p):
    """Up to the last day of the fact, which is the last day of any event."""
    last_day = p.events.agg(F.max("event_date")).scalar()
    return lifecycle.compute_lifecycle_transitions(p.events, p.users, date_max=last_day)


def transitions_from_spans_orders(o):
    return lifecycle.compute_lifecycle_transitions(
        o.events, o.users, active_event_names=o.names
    )


def dau_decomposition(p):
    return sparse.decomposition_of_days(p.days(()), p.lifecycle_daily(()))


def decomposition_of_stored_fact(p):
    return lifecycle.decomposition_report(p.fact())


def streak_runs(p):
    return streaks.streak_runs(p.events)


def streak_days(p):
    return streaks.streak_by_day(p.fact())


def lifecycle_of_months(p):
    """States of a stored fact, of which only rows per user and month are shuffled."""
    return months.states_of_months(months.fold_months(p.fact(include_lifecycle=False)))


def streak_days_of_months(p):
    return months.streaks_of_months(months.fold_months(p.fact()))


def transitions_of_months(p):
    return months.transitions_of_months(months.fold_months(p.fact()))


def lifecycle_of_months_orders(o):
    days = months.states_of_months(months.fold_months(o.fact().drop("lifecycle_state")))
    return days.groupBy("date", F.col("lifecycle_state").alias("state")).agg(F.count("*").alias("users"))


def streaks_of_months_orders(o):
    """Streaks over several years, counted by month and length."""
    days = months.streaks_of_months(months.fold_months(o.fact()))
    return days.groupBy(F.trunc("date", "month").alias("month"), "streak_length").agg(F.count("*").alias("user_days"))


def transitions_of_months_orders(o):
    return months.transitions_of_months(months.fold_months(o.fact()))


# --- dashboards -------------------------------------------------------------------------------

def kpi_cards(p):
    return dashboards.kpi_cards(p.kpis(), p.retention())


def active_user_trend(p):
    return dashboards.active_user_trend(p.kpis())


def active_mix(p):
    return dashboards.active_mix(p.lifecycle_daily())


def health_mix(p):
    return dashboards.health_mix(p.lifecycle_daily(()))


def lessons_per_session(p):
    return dashboards.lessons_per_session(p.kpis())


def premium_share(p):
    shares = dashboards.premium_share_trend(p.kpis())
    return shares.withColumn("premium_text", percent_text(F.col("premium_share")))


def paywall_rate(p):
    return dashboards.paywall_rate(p.events, group_cols=["variant"], shown=SHOWN)


def purchase_conversion(p):
    return dashboards.purchase_conversion(p.events, shown=SHOWN, bought=BOUGHT)


def streak_by_variant(p):
    return sparse.streak_metrics_of_days(p.days())


def avg_session_duration(p):
    return dashboards.session_duration(p.sessions)


def completion_rate(p):
    return dashboards.lesson_completion_rate(p.events, p.users, group_cols=["country"])


def hearts_per_user(p):
    return sparse.hearts_of_days(p.days())


# --- experiment -------------------------------------------------------------------------------

def dau_by_variant_wide(p):
    return p.dau_wide()


def aa_check(p):
    return rounded(
        experiment.aa_check(p.dau_wide(), p.rollout()), "mean_ratio", "p95_abs_gap", "corr"
    )


def _smoothed(p, days):
    start = experiment.rollout_date(p.users, days)
    return rounded(experiment.aa_check_smoothed(p.dau_wide(), start), "mean_ratio", "p95_abs_gap", "corr")


def aa_check_smoothed(p):
    """A rollout late enough for ten smoothed days."""
    return _smoothed(p, 25)


def aa_check_smoothed_short(p):
    """Too few days: the rules are null."""
    return _smoothed(p, ROLLOUT_DAYS)


def signup_share(p):
    return experiment.signup_share(p.users)


def signup_share_distribution(p):
    shares = experiment.signup_share(p.users)
    points = (0.05, 0.25, 0.5, 0.75, 0.95)
    out = quality.distribution(shares, "treat_share", points)
    return rounded(out, "mean", "std", *[f"p{round(100 * x)}" for x in points])


def activity_rate(p):
    return experiment.activity_rate(p.dau_wide(), p.users)


def activity_rate_correlation(p):
    rates = experiment.activity_rate(p.dau_wide(), p.users, p.rollout())
    return rounded(experiment.activity_rate_correlation(rates), "corr")


def sessions_per_active(p):
    return experiment.sessions_per_active_user(p.sessions, p.events, by_variant=False)


def sessions_per_active_variant(p):
    return experiment.sessions_per_active_user(p.sessions, p.events, p.users)


def avg_streak(p):
    return experiment.average_streak(p.events, by_variant=False, event_names=["lesson_completed"])


def avg_streak_variant(p):
    return experiment.average_streak(p.events, event_names=["lesson_completed"])


def pre_post_summary(p):
    series = {
        "dau": p.dau_wide(),
        "sess_per_active": sessions_per_active_variant(p),
        "avg_streak": avg_streak_variant(p),
    }
    return rounded(
        experiment.pre_post_summary(series, p.rollout()), "control", "treatment", "diff_pct"
    )


def opens_per_user_variant(p):
    return experiment.opens_per_user(p.events, p.users)


def kpi_lift(p):
    days = p.days()
    out = experiment.kpi_lift(p.kpis(days=days), p.retention(), days)
    return rounded(out, "control", "treatment", "lift")


def guardrails(p):
    return experiment.guardrails(p.sessions, p.events, p.users, shown=SHOWN, bought=BOUGHT)


def guardrail_test(p):
    return rounded(
        experiment.guardrail_test(guardrails(p), start=p.rollout()), "control", "treatment", "z"
    )


def assign_variant(p):
    return experiment.assign_variant(p.users.drop("variant"))


def assigned_arms(o):
    """Size of the arms per signup date."""
    arms = experiment.assign_variant(o.users).groupBy("signup_date")
    return arms.agg(*[
        F.count_if(F.col("variant") == arm).alias(arm) for arm in experiment.ARMS
    ])


# --- quality ----------------------------------------------------------------------------------

def event_counts_pivot(p):
    return quality.event_counts_by_day(p.events)


def event_users_pivot(p):
    return quality.event_users_by_day(p.events)


def event_value_counts(p):
    return quality.value_counts(p.events, "event_name")


def quality_report(p):
    return quality.quality_report(p.users, p.sessions, p.events_in_sessions)


def session_gaps(p):
    """Sessions shortened at their start by ten minutes, so that events lie before them."""
    later = F.col("session_start") + F.expr("INTERVAL 10 minutes")
    return quality.session_gaps(p.events_in_sessions, p.sessions.withColumn("session_start", later))


def unknown_names(p):
    """Names outside a taxonomy that knows only the active events."""
    return quality.unknown_names(p.events, ["app_open", "lesson_started", "lesson_completed"])


def events_before_signup(p):
    early = quality.before_signup(p.events, p.users, "event_time")
    return early.select("event_id", "user_id", "event_time", "signup_time")


def duration_differences(p):
    """Distribution of the difference for durations that are wrong by a few seconds, by user."""
    longer = p.sessions.withColumn(
        "session_duration_sec", F.col("session_duration_sec") + F.col("user_id") % 5)
    return rounded(quality.duration_differences(longer), "mean", "std")


def _late_dates(p):
    """Events dated by the hour before, so that those of the first hour of a day differ."""
    return p.events.withColumn("event_date", F.to_date(F.col("event_time") - F.expr("INTERVAL 1 hour")))


def date_mismatches(p):
    return quality.date_mismatches(_late_dates(p))


def largest_session_gaps(p):
    later = F.col("session_start") + F.expr("INTERVAL 10 minutes")
    gaps = quality.largest_session_gaps(p.events_in_sessions, p.sessions.withColumn("session_start", later))
    return gaps.select("event_id", "session_id", "gap_sec")


def quality_report_layout(p):
    """With the column sets of the tables, of which these lack some."""
    report = quality.quality_report(p.users, p.sessions, _late_dates(p), full_layout=True)
    return report.filter(F.col("check").isin("columns_present", "date_matches_time", "unique_event_id"))


def lesson_order_violations(p):
    return quality.lesson_order_violations(p.events_in_sessions)


def session_lengths(p):
    out = quality.distribution(p.sessions, "session_duration_sec", (0.25, 0.5, 0.75, 0.95))
    return rounded(out, "mean", "std")


def lineitem_keys(spark, folder):
    lines = adapters.table(spark, folder, "lineitem")
    return quality.check_key(lines, "lineitem", ["l_orderkey", "l_linenumber"])


def orders_reference(spark, folder):
    return quality.check_reference(
        adapters.table(spark, folder, "orders"), "orders", "o_custkey",
        adapters.table(spark, folder, "customer"), "c_custkey", "customer_exists",
    )


def _lesson_lines(spark, folder):
    """Order lines as lesson events: open lines have no lesson, the others their part."""
    return adapters.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), F.lit("lesson_started").alias("event_name"),
        F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")).otherwise("").alias("lesson_id"),
    )


def lesson_present(spark, folder):
    users = adapters.table(spark, folder, "orders").select(F.col("o_orderkey").alias("user_id"))
    return quality.check_event_rows(_lesson_lines(spark, folder), users).filter("check = 'lesson_present'")


def lesson_exists(spark, folder):
    """Lines of closed orders against the parts up to a size; parts above are unknown lessons."""
    lessons = adapters.table(spark, folder, "part").filter("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("lesson_id"))
    return quality.check_lessons(_lesson_lines(spark, folder), lessons)


def shipped_before_ordered(spark, folder):
    """Facts before the start of their parent, on order lines."""
    lines = adapters.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("user_id"), "l_linenumber", F.col("l_shipdate").alias("shipped")
    )
    orders = adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("user_id"), F.col("o_orderdate").alias("signup_time")
    )
    early = quality.before_signup(lines, orders, "shipped")
    return early.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("violations"))


def table_rows(spark, folder):
    names = ["customer", "events", "lineitem", "nation", "orders"]
    return quality.row_counts({n: adapters.table(spark, folder, n) for n in names})


# --- kept range by range, written and read again ---------------------------------------------------

RANGES = [(None, "2024-01-10"), ("2024-01-11", "2024-01-17"), ("2024-01-18", None)]
_stored: dict[tuple, str] = {}


def _once(p, what: str, write) -> str:
    """A folder in the shared one, filled once per application and test folder."""
    key = (p.spark.sparkContext.applicationId, p.folder, what)
    if key not in _stored:
        folder = f"{scratch_folder(p.spark)}/{what}-{uuid.uuid4().hex}"
        write(folder)
        _stored[key] = folder
    return _stored[key]


def _raw_files(p, file_format: str) -> str:
    def write(folder):
        lessons = adapters.product_lessons(adapters.table(p.spark, p.folder, "part"))
        raw = {"users": p.users, "sessions": p.sessions, "events": p.events, "lessons": lessons}
        for name, df in raw.items():
            files.write_raw_table(df, files.table_path(folder, name, file_format), name, file_format)

    return _once(p, f"raw-{file_format}", write)


def _rebuilt(table):
    """A table from builds of consecutive ranges of days."""
    def write(p, out):
        for first, last in RANGES:
            rebuild.rebuild_days(p.spark, _raw_files(p, "parquet"), out, date_min=first, date_max=last)

    def run(p):
        out = _once(p, "ranges", lambda folder: write(p, folder))
        return files.read_table(p.spark, files.table_path(out, table, "parquet"), "parquet")

    return run


def _built(table):
    """A table of the whole job, from text files to text files."""
    def run(p):
        out = _once(p, "job", lambda folder: build_tables.run_build(p.spark, _raw_files(p, "csv"), folder))
        return files.read_table(p.spark, files.table_path(out, table, "csv"), "csv", files.LAYOUTS[table])

    return run


def rebuilt_user_state(p):
    state = _rebuilt(rebuild.STATE)(p)
    return state.where(F.col("as_of") == state.agg(F.max("as_of")).scalar()).drop("as_of", "horizon")


def _round_trip(name, file_format):
    """A table written and read back; text gets its types from the layout."""
    def run(spark, folder):
        df = adapters.table(spark, folder, name)
        path = f"{scratch_folder(spark)}/copy-{uuid.uuid4().hex}"
        files.write_table(df, path, file_format)
        return files.read_table(spark, path, file_format, df.schema)

    return run


def last_event_text_ids(p):
    """The last event of a day among events that share its only time."""
    events = p.events.withColumns({
        "event_id": F.format_string("evt_%09d", "event_id"), "event_time": F.date_trunc("day", "event_time").cast("timestamp_ntz")})
    return fact.daily_event_features(events).select("user_id", "date", "streak_length_end_of_day", "is_premium")


def fact_text_ids(p):
    events = p.events.withColumn("event_id", F.format_string("evt_%09d", "event_id"))
    return fact.build_fact_user_daily(p.users, events, p.sessions)


def _spoiled(orders):
    """Orders as text in which some dates and prices cannot be read and some customers are absent."""
    key = F.col("o_orderkey")
    return orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns]).withColumns({
        "o_orderdate": F.when(key % 7 == 0, "no day").otherwise(F.col("o_orderdate")),
        "o_totalprice": F.when(key % 11 == 0, "much").otherwise(F.col("o_totalprice")),
        "o_custkey": F.when(key % 13 == 0, None).otherwise(F.col("o_custkey"))})


def _checked_orders(spark, folder):
    orders = adapters.table(spark, folder, "orders")
    out = f"{scratch_folder(spark)}/checked-{uuid.uuid4().hex}"
    files.write_table(_spoiled(orders), f"{out}/orders.csv", "csv")
    return files.load_checked(
        spark, f"{out}/orders.csv", "orders", out, layout=orders.schema, key="o_orderkey", required=["o_custkey"])


def rejected_orders(spark, folder):
    paths = _checked_orders(spark, folder)
    return spark.read.parquet(paths["rejects"]).select("key", "column", "raw", "reason", "row_dropped")


def loaded_orders(spark, folder):
    return spark.read.parquet(_checked_orders(spark, folder)["loaded"])


def bucketed_events_before_signup(p):
    """Events against users from tables that are dealt out by user: the join shuffles nothing."""
    mark = uuid.uuid4().hex
    kept = {}
    for name, df in (("users", p.users), ("events", p.events)):
        kept[name] = f"{name}_{mark}"
        tables.save_catalog_table(
            df, kept[name], bucket_by="user_id", buckets=8, path=f"{scratch_folder(p.spark)}/{kept[name]}")
    return quality.before_signup(p.spark.table(kept["events"]), p.spark.table(kept["users"]), "event_time").select(
        "event_id", "user_id", "event_time", "signup_time")


def appended_customers(spark, folder):
    """Half of the customers, then all of them twice: each is there once."""
    customers, name = adapters.table(spark, folder, "customer"), f"customer_{uuid.uuid4().hex}"
    path = f"{scratch_folder(spark)}/{name}"
    tables.save_catalog_table(customers.where("c_custkey % 2 = 0"), name, path=path)
    for _ in range(2):
        tables.append_new_rows(customers, name, "c_custkey")
    return spark.table(name)


# --- measures with large domains, sketches and bitmaps ---------------------------------------------

def order_prices(spark, folder):
    prices = quality.distribution(adapters.table(spark, folder, "orders"), "o_totalprice", (0.01, 0.25, 0.5, 0.75, 0.99))
    return rounded(prices, "mean", "std", "p1", "p25", "p50", "p75", "p99")


def approx_actives(p):
    """Exact counts, and whether the merged sketches come within five percent of them."""
    sketches = activity.daily_user_sketches(p.events)
    near = activity.approx_active_users(sketches).withColumnsRenamed({"wau": "near_wau", "mau": "near_mau"})
    exact = activity.compute_active_users(p.events).join(near, ["date", "variant"])
    return exact.select("date", "variant", "wau", "mau", *[
        (F.abs(F.col(f"near_{c}") - F.col(c)) <= 0.05 * F.col(c)).alias(f"{c}_in_bounds") for c in ("wau", "mau")])


def _bitmaps(o):
    return retention.activity_bitmaps(o.users, o.events, 90, active_event_names=o.names)


def retention_bitmaps_orders(o):
    return retention.retention_of_bitmaps(_bitmaps(o), range(91))


def retention_bitmaps_variant(p):
    return retention.retention_of_bitmaps(
        retention.activity_bitmaps(p.users, p.events, 30), (1, 7, 30), drop_incomplete=False)


def return_on_or_after(o):
    return retention.retention_of_bitmaps(_bitmaps(o), (1, 7, 30, 90), unbounded=True)


def _user_sums(p):
    return experiment.user_guardrails(
        p.sessions, p.events, p.users, start=p.rollout(), shown=SHOWN, bought=BOUGHT)


def guardrail_by_user(p):
    return rounded(
        experiment.guardrail_by_user(_user_sums(p)), "control", "treatment", "difference", "low", "high", "z")


def guardrail_bootstrap(p):
    return rounded(experiment.guardrail_bootstrap(_user_sums(p)), "difference", "low", "high")


_PRODUCT = [
    rebuilt_user_state, bucketed_events_before_signup, last_event_text_ids, fact_text_ids, approx_actives, retention_bitmaps_variant,
    guardrail_by_user, guardrail_bootstrap,
    dau, wau, mau, dau_all, wau_all, mau_all, dau_country, wau_country, active_users, dau_rolling7,
    dau_range, dau_segment, retention_variant, retention_all, retention_incomplete, retention_curve,
    retention_trend, sessionize, session_of_event, sessions_per_user,
    sessions_per_user_from_sessions, funnel_daily, funnel_cohort, funnel_cohort_country,
    agg_funnel_daily, lifecycle_counts, lifecycle_counts_all, lifecycle_wide, lifecycle_by_arm,
    user_spine, fact_user_daily, fact_window, fact_first_users, lifecycle_from_fact, agg_daily_kpis,
    agg_daily_kpis_country, agg_lifecycle_daily, lifecycle_transitions, transitions_from_spans, dau_decomposition,
    streak_runs, streak_days, lifecycle_of_months, streak_days_of_months, transitions_of_months, kpi_cards, active_user_trend, active_mix, health_mix,
    lessons_per_session, premium_share, paywall_rate, purchase_conversion, streak_by_variant,
    avg_session_duration, completion_rate, hearts_per_user, dau_by_variant_wide, aa_check,
    aa_check_smoothed, signup_share, signup_share_distribution, activity_rate,
    activity_rate_correlation, sessions_per_active, sessions_per_active_variant, avg_streak,
    avg_streak_variant, pre_post_summary, opens_per_user_variant, kpi_lift, guardrails,
    guardrail_test, assign_variant, agg_retention_cohort, aa_check_smoothed_short, lifecycle_since, fact_since,
    user_spine_all, kpis_of_stored_fact, lifecycle_of_stored_fact, decomposition_of_stored_fact,
    duration_differences, date_mismatches, largest_session_gaps, quality_report_layout, event_counts_pivot, event_users_pivot, event_value_counts,
    quality_report, session_gaps, unknown_names, events_before_signup, lesson_order_violations, session_lengths,
]
_ORDERS = [
    mau_orders, retention_orders, lifecycle_counts_orders, agg_lifecycle_orders,
    lifecycle_transitions_orders, transitions_from_spans_orders, lifecycle_recent_orders, assigned_arms,
    retention_bitmaps_orders, return_on_or_after, lifecycle_of_months_orders, streaks_of_months_orders,
    transitions_of_months_orders,
]
_TABLES = [order_prices, rejected_orders, loaded_orders, appended_customers, lineitem_keys, orders_reference, lesson_present, lesson_exists, shipped_before_ordered, table_rows]
# The tables of the build job, by arm and by country.
_JOB_TABLES = [
    "fact_user_daily", "agg_daily_kpis", "agg_retention_cohort", "agg_funnel_daily", "agg_lifecycle_daily"]
_JOB_KEYS = {"job": ("variant",), "job_country": ("country",)}


def _job_table(keys, table):
    return lambda p: p.tables(keys)[table]


def _on(kind, query):
    return lambda spark, folder: query(kind(spark, folder))


def all_queries():
    return {
        **{q.__name__: _on(Product, q) for q in _PRODUCT},
        **{q.__name__: _on(Orders, q) for q in _ORDERS},
        **{
            f"{name}_{table}": _on(Product, _job_table(keys, table))
            for name, keys in _JOB_KEYS.items() for table in _JOB_TABLES
            if not (name == "job_country" and table == "agg_funnel_daily")
        },
        **{f"{kind}_{table}": _on(Product, make(table)) for kind, make in (("rebuilt", _rebuilt), ("files", _built))
           for table in _JOB_TABLES},
        **{f"{name}_{kind}": _round_trip(name, kind) for name in ("orders", "customer") for kind in files.FORMATS},
        **{q.__name__: q for q in _TABLES},
    }
