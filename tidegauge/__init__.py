"""Product-growth metrics on Spark: lazy functions from DataFrames to a DataFrame."""

from tidegauge.operators.activity import (
    compute_active_users,
    compute_dau,
    compute_mau,
    compute_wau,
    rolling_mean,
)
from tidegauge.operators.engagement import (
    assign_sessions,
    compute_sessions_per_user,
    sessions_from_events,
)
from tidegauge.operators.fact import build_fact_user_daily, build_user_date_spine
from tidegauge.operators.funnel import build_agg_funnel_daily, compute_lesson_funnel
from tidegauge.operators.kpis import build_agg_daily_kpis
from tidegauge.operators.lifecycle import (
    assign_lifecycle_state,
    build_agg_lifecycle_daily,
    compute_lifecycle_counts,
    compute_lifecycle_transitions,
    lifecycle_transitions,
)
from tidegauge.operators.quality import quality_report
from tidegauge.operators.retention import build_agg_retention_cohort, compute_retention
from tidegauge.operators.streaks import streak_by_day, streak_runs
from tidegauge.plans.build_tables import (
    build_all_derived_tables,
    build_dashboard_tables,
    run_build,
)
from tidegauge.plans.load_tables import load_tables
from tidegauge.plans.rebuild import rebuild_days
from tidegauge.session import spark_session

__all__ = [
    "assign_lifecycle_state", "assign_sessions", "build_agg_daily_kpis", "build_agg_funnel_daily",
    "build_agg_lifecycle_daily", "build_agg_retention_cohort", "build_all_derived_tables",
    "build_dashboard_tables", "build_fact_user_daily", "build_user_date_spine",
    "compute_active_users", "compute_dau", "compute_lesson_funnel", "compute_lifecycle_counts",
    "compute_lifecycle_transitions",
    "compute_mau", "compute_retention", "compute_sessions_per_user", "compute_wau",
    "lifecycle_transitions", "load_tables", "quality_report", "rebuild_days", "rolling_mean", "run_build",
    "sessions_from_events", "spark_session", "streak_by_day", "streak_runs",
]
