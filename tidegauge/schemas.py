"""Column types of the raw and derived tables, and the columns each table must have."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _layout(columns: str) -> T.StructType:
    """A struct from `name TYPE, ...`, without the session that Spark's own parser needs."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# The table layouts of the data model.
USERS = _layout(
    "user_id BIGINT, signup_date DATE, signup_time TIMESTAMP_NTZ, signup_channel STRING, "
    "campaign_id STRING, country STRING, language_target STRING, device_os STRING, "
    "app_version STRING, timezone STRING, signup_platform STRING, is_premium_at_signup BOOLEAN, "
    "variant STRING"
)
SESSIONS = _layout(
    "session_id STRING, user_id BIGINT, session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, "
    "session_duration_sec INT, device_os STRING, app_version STRING"
)
EVENTS = _layout(
    "event_id STRING, user_id BIGINT, session_id STRING, event_time TIMESTAMP_NTZ, event_date DATE, "
    "event_name STRING, screen STRING, language_target STRING, lesson_id STRING, xp_delta INT, "
    "hearts_delta INT, streak_length INT, is_premium BOOLEAN, experiment_id STRING, variant STRING"
)
LESSONS = _layout(
    "lesson_id STRING, unit_id STRING, skill STRING, difficulty INT, topic STRING, "
    "expected_duration_sec INT, expected_xp INT"
)
FACT_USER_DAILY = _layout(
    "date DATE, user_id BIGINT, variant STRING, signup_date DATE, days_since_signup INT, "
    "is_active INT, had_app_open INT, had_lesson_started INT, had_lesson_completed INT, "
    "sessions_count BIGINT, session_duration_sec BIGINT, lessons_completed BIGINT, xp_earned BIGINT, "
    "hearts_lost BIGINT, streak_length_end_of_day INT, is_premium BOOLEAN, lifecycle_state STRING"
)
AGG_DAILY_KPIS = _layout(
    "date DATE, variant STRING, signups BIGINT, dau BIGINT, wau BIGINT, mau BIGINT, "
    "dau_mau_ratio DOUBLE, sessions BIGINT, avg_session_duration_sec DOUBLE, "
    "sessions_per_active_user DOUBLE, lessons_completed BIGINT, lessons_per_active_user DOUBLE, "
    "xp_earned BIGINT, xp_per_active_user DOUBLE, premium_users BIGINT, premium_share DOUBLE"
)
AGG_RETENTION_COHORT = _layout(
    "cohort_date DATE, variant STRING, retained_users BIGINT, day_n INT, cohort_size BIGINT, "
    "retention_rate DOUBLE"
)
AGG_FUNNEL_DAILY = _layout(
    "date DATE, variant STRING, n_signup BIGINT, n_app_open BIGINT, n_lesson_started BIGINT, "
    "n_lesson_completed BIGINT, cr_app_open_given_signup DOUBLE, "
    "cr_lesson_started_given_app_open DOUBLE, cr_lesson_completed_given_lesson_started DOUBLE"
)
AGG_LIFECYCLE_DAILY = _layout("date DATE, state STRING, variant STRING, users BIGINT")

# What a build of a range of days hands on to the next one.
USER_STATE = _layout(
    "user_id BIGINT, last_active DATE, last_premium_day DATE, last_premium BOOLEAN, active_days BIGINT, "
    "sessions_count BIGINT, session_duration_sec BIGINT, lessons_completed BIGINT, xp_earned BIGINT, "
    "hearts_lost BIGINT, horizon DATE, as_of DATE"
)

RAW_TABLES = {"users": USERS, "sessions": SESSIONS, "events": EVENTS, "lessons": LESSONS}
DERIVED_TABLES = {
    "fact_user_daily": FACT_USER_DAILY,
    "agg_daily_kpis": AGG_DAILY_KPIS,
    "agg_retention_cohort": AGG_RETENTION_COHORT,
    "agg_funnel_daily": AGG_FUNNEL_DAILY,
    "agg_lifecycle_daily": AGG_LIFECYCLE_DAILY,
}

PRIMARY_KEYS = {
    "users": "user_id",
    "sessions": "session_id",
    "events": "event_id",
    "lessons": "lesson_id",
}

MINIMUM_COLUMNS = {
    "users": ["user_id", "signup_date"],
    "sessions": ["session_id", "user_id", "session_start", "session_end", "session_duration_sec"],
    "events": ["event_id", "user_id", "event_time", "event_name"],
}

# The event names the product may emit.
EVENT_TAXONOMY = [
    "signup", "onboarding_completed", "paywall_shown", "purchase",
    "app_open", "app_background", "push_received", "push_opened",
    "lesson_started", "question_answered", "lesson_completed",
    "streak_incremented", "streak_broken", "streak_repaired",
]
ACTIVE_EVENTS = ["app_open", "lesson_started", "lesson_completed"]
FUNNEL_STEPS = ["signup", "app_open", "lesson_started", "lesson_completed"]
LESSON_FLOW_EVENTS = ["lesson_started", "question_answered", "lesson_completed"]

# Lifecycle states and their display names.
LIFECYCLE_STATES = {
    "New": "New",
    "Current": "Current",
    "Reactivated": "Reactivated",
    "Resurrected": "Resurrected",
    "AtRiskWAU": "At Risk WAU",
    "AtRiskMAU": "At Risk MAU",
    "Dormant": "Dormant",
}
ACTIVE_STATES = ["New", "Current", "Reactivated", "Resurrected"]
HEALTH_STATES = ["Current", "AtRiskWAU", "AtRiskMAU", "Dormant"]

LAYOUTS_BY_GROUP = {"raw": RAW_TABLES, "derived": DERIVED_TABLES}
