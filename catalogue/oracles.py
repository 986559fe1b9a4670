"""DuckDB SQL with the definition of each registered query.

The statements are written the plain way (calendars, range joins, distinct counts over windows of
days), not the way the operators compute, so that agreement means something.
"""

from __future__ import annotations

ACTIVE = "('app_open', 'lesson_started', 'lesson_completed')"
STATES = "('New'), ('Current'), ('Reactivated'), ('Resurrected'), ('AtRiskWAU'), ('AtRiskMAU'), ('Dormant')"

# --- the test tables as product telemetry -------------------------------------------------------

E = """e AS (
  SELECT event_id, user_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
    CASE event_type WHEN 'view' THEN 'app_open' WHEN 'click' THEN 'lesson_started'
      WHEN 'purchase' THEN 'lesson_completed' WHEN 'signup' THEN 'signup'
      WHEN 'error' THEN 'question_answered' END AS event_name,
    CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS xp_delta,
    CASE WHEN event_type = 'error' THEN -1 ELSE 0 END AS hearts_delta,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS streak_length,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) >= 90 AS is_premium,
    CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant
  FROM events)"""

U = """u AS (
  SELECT f.user_id, CAST(f.signup_time AS DATE) AS signup_date, f.signup_time,
    c.c_mktsegment AS signup_channel, n.n_name AS country, FALSE AS is_premium_at_signup,
    CASE WHEN f.user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant
  FROM (SELECT user_id, min(ts) AS signup_time FROM events WHERE event_type = 'signup' GROUP BY 1) f
  LEFT JOIN customer c ON c.c_custkey = f.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""

# Sessions by definition: row by row, a pause of more than four hours opens the next one.
ES = """marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id)
      <= INTERVAL 4 HOUR THEN 0 ELSE 1 END AS opens FROM e),
es AS (
  SELECT * EXCLUDE (opens), user_id || '-' || CAST(sum(opens) OVER (
    PARTITION BY user_id ORDER BY event_time, event_id) AS BIGINT) AS session_id FROM marked)"""
S = ES + """,
s AS (
  SELECT session_id, user_id, min(event_time) AS session_start, max(event_time) AS session_end,
    CAST(round_even(date_diff('microsecond', min(event_time), max(event_time)) / 1e6, 0) AS BIGINT)
      AS session_duration_sec, count(*) AS events
  FROM es GROUP BY 1, 2)"""

UD = f"ud AS (SELECT DISTINCT user_id, event_date AS date, variant FROM e WHERE event_name IN {ACTIVE})"
UDC = f"""ud AS (SELECT DISTINCT e.user_id, event_date AS date, country
  FROM e LEFT JOIN u USING (user_id) WHERE event_name IN {ACTIVE})"""

OE = "oe AS (SELECT o_orderkey AS event_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS date FROM orders)"
OU = """ou AS (
  SELECT f.user_id, f.signup_date, c.c_mktsegment AS segment
  FROM (SELECT o_custkey AS user_id, min(CAST(o_orderdate AS DATE)) AS signup_date FROM orders GROUP BY 1) f
  LEFT JOIN customer c ON c.c_custkey = f.user_id)"""
OUD = "ud AS (SELECT DISTINCT user_id, date FROM oe)"


def days(first: str, last: str) -> str:
    return f"CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE)"


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- fragments ----------------------------------------------------------------------------------

def trailing(name: str, window: int, key: str | None) -> str:
    """Distinct users in [t - window + 1, t] for each day of each group's own calendar."""
    k, on = (f"{key},", f"ud.{key} IS NOT DISTINCT FROM cal.{key} AND") if key else ("", "")
    ck = f"cal.{key}," if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""SELECT cal.date, {ck} count(DISTINCT ud.user_id) AS {name}
FROM (SELECT {k} {days('min(date)', 'max(date)')} AS date FROM ud {group}) cal
LEFT JOIN ud ON {on} ud.date BETWEEN cal.date - {window - 1} AND cal.date
GROUP BY cal.date{', cal.' + key if key else ''}"""


def state_case(t: str, signup: str) -> str:
    """State from counts of active days in windows around t."""
    return f"""CASE WHEN {t} = {signup} THEN 'New'
      WHEN today > 0 AND prev7 > 0 THEN 'Current'
      WHEN today > 0 AND prev30 > 0 THEN 'Reactivated'
      WHEN today > 0 THEN 'Resurrected'
      WHEN incl7 > 0 THEN 'AtRiskWAU'
      WHEN incl30 > 0 THEN 'AtRiskMAU'
      ELSE 'Dormant' END"""


WINDOW_COUNTS = """count(*) FILTER (a.date = c.date) AS today,
    count(*) FILTER (a.date BETWEEN c.date - 7 AND c.date - 1) AS prev7,
    count(*) FILTER (a.date BETWEEN c.date - 30 AND c.date - 1) AS prev30,
    count(*) FILTER (a.date BETWEEN c.date - 6 AND c.date) AS incl7,
    count(*) FILTER (a.date BETWEEN c.date - 29 AND c.date) AS incl30"""


def state_counts(users: str, key: str | None, first: str, last: str, match: str = "") -> str:
    k = f", {key}" if key else ""
    gk = f", g.{key}" if key else ""
    ck = f", c.{key}" if key else ""
    same = f" AND w.{key} IS NOT DISTINCT FROM g.{key}" if key else ""
    return f"""cal AS (SELECT {days(first, last)} AS date),
w AS (
  SELECT c.user_id, c.date, c.signup_date{ck}, {WINDOW_COUNTS}
  FROM (SELECT * FROM {users} JOIN cal ON cal.date >= {users}.signup_date) c
  LEFT JOIN ud a ON a.user_id = c.user_id {match} AND a.date BETWEEN c.date - 30 AND c.date
  GROUP BY c.user_id, c.date, c.signup_date{ck}),
w2 AS (SELECT *, {state_case('date', 'signup_date')} AS state FROM w),
grid AS (SELECT date, state{k} FROM cal CROSS JOIN (VALUES {STATES}) st(state)
  {f'CROSS JOIN (SELECT DISTINCT {key} FROM {users}) k' if key else ''}),
lc AS (SELECT g.date, g.state, count(w.user_id) AS users{gk} FROM grid g
  LEFT JOIN w2 w ON w.date = g.date AND w.state = g.state{same} GROUP BY g.date, g.state{gk})"""


EV_BOUNDS = (
    "(SELECT least((SELECT min(signup_date) FROM u), (SELECT min(date) FROM ud)))",
    "(SELECT greatest((SELECT max(signup_date) FROM u), (SELECT max(date) FROM ud)))",
)
LC = state_counts("u", "variant", *EV_BOUNDS, match="AND a.variant = c.variant")

LAST_DAY = """(SELECT greatest((SELECT max(signup_date) FROM u),
  (SELECT max(event_date) FROM e WHERE user_id IN (SELECT user_id FROM u)),
  (SELECT max(CAST(session_start AS DATE)) FROM s WHERE user_id IN (SELECT user_id FROM u))))"""


def fact(first: str | None = None, last: str = LAST_DAY, users: str = "u") -> str:
    start = f"greatest(signup_date, {first})" if first else "signup_date"
    return f"""spine AS (
  SELECT *, {days(start, last)} AS date FROM {users} WHERE {start} <= {last}),
ed AS (
  SELECT user_id, event_date AS date, max(CASE WHEN event_name IN {ACTIVE} THEN 1 ELSE 0 END) AS is_active,
    max(CASE WHEN event_name = 'app_open' THEN 1 ELSE 0 END) AS had_app_open,
    max(CASE WHEN event_name = 'lesson_started' THEN 1 ELSE 0 END) AS had_lesson_started,
    max(CASE WHEN event_name = 'lesson_completed' THEN 1 ELSE 0 END) AS had_lesson_completed,
    sum(CASE WHEN event_name = 'lesson_completed' THEN 1 ELSE 0 END) AS lessons_completed,
    sum(xp_delta) AS xp_earned, sum(greatest(-hearts_delta, 0)) AS hearts_lost
  FROM e GROUP BY 1, 2),
el AS (
  SELECT user_id, event_date AS date, streak_length, is_premium FROM e
  QUALIFY row_number() OVER (PARTITION BY user_id, event_date ORDER BY event_time DESC, event_id DESC) = 1),
sd AS (
  SELECT user_id, CAST(session_start AS DATE) AS date, count(DISTINCT session_id) AS sessions_count,
    sum(session_duration_sec) AS session_duration_sec FROM s GROUP BY 1, 2),
f0 AS (
  SELECT p.date, p.user_id, p.variant, p.country, p.signup_date,
    CAST(p.date - p.signup_date AS INTEGER) AS days_since_signup,
    CAST(coalesce(is_active, 0) AS INTEGER) AS is_active,
    CAST(coalesce(had_app_open, 0) AS INTEGER) AS had_app_open,
    CAST(coalesce(had_lesson_started, 0) AS INTEGER) AS had_lesson_started,
    CAST(coalesce(had_lesson_completed, 0) AS INTEGER) AS had_lesson_completed,
    CAST(coalesce(sessions_count, 0) AS BIGINT) AS sessions_count,
    CAST(coalesce(session_duration_sec, 0) AS BIGINT) AS session_duration_sec,
    CAST(coalesce(lessons_completed, 0) AS BIGINT) AS lessons_completed,
    CAST(coalesce(xp_earned, 0) AS BIGINT) AS xp_earned,
    CAST(coalesce(hearts_lost, 0) AS BIGINT) AS hearts_lost,
    CAST(coalesce(streak_length, 0) AS INTEGER) AS streak_length_end_of_day,
    coalesce(is_premium, is_premium_at_signup, FALSE) AS is_premium
  FROM spine p LEFT JOIN ed USING (user_id, date) LEFT JOIN el USING (user_id, date)
  LEFT JOIN sd USING (user_id, date)),
fw AS (
  SELECT c.user_id, c.date, c.signup_date, {WINDOW_COUNTS}
  FROM f0 c LEFT JOIN (SELECT user_id, date FROM f0 WHERE is_active = 1) a
    ON a.user_id = c.user_id AND a.date BETWEEN c.date - 30 AND c.date
  GROUP BY c.user_id, c.date, c.signup_date),
fact AS (
  SELECT f0.*, {state_case('fw.date', 'fw.signup_date')} AS lifecycle_state
  FROM f0 JOIN fw ON fw.user_id = f0.user_id AND fw.date = f0.date)"""


FACT = [E, U, S, fact()]
FACT_COLS = """date, user_id, variant, signup_date, days_since_signup, is_active, had_app_open,
  had_lesson_started, had_lesson_completed, sessions_count, session_duration_sec, lessons_completed,
  xp_earned, hearts_lost, streak_length_end_of_day, is_premium, lifecycle_state"""


def div(a: str, b: str) -> str:
    """Ratio of two whole numbers, null on zero."""
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def div0(a: str, b: str) -> str:
    return f"coalesce({div(a, b)}, 0.0)"


def mean(column: str, condition: str = "TRUE") -> str:
    return f"CAST(sum({column}) FILTER ({condition}) AS DOUBLE) / count({column}) FILTER ({condition})"


def kpis(key: str) -> str:
    return f"""wau AS ({trailing('wau', 7, key)}), mau AS ({trailing('mau', 30, key)}),
dau AS (SELECT date, {key}, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1, 2),
su AS (SELECT signup_date AS date, {key}, count(DISTINCT user_id) AS signups FROM u GROUP BY 1, 2),
fd AS (SELECT date, {key}, sum(sessions_count) AS sessions, sum(session_duration_sec) AS seconds,
    count(*) AS user_days, sum(lessons_completed) AS lessons, sum(xp_earned) AS xp,
    sum(CAST(is_premium AS INTEGER)) AS premium, sum(is_active) AS active FROM fact GROUP BY 1, 2),
kpi AS (SELECT date, {key}, coalesce(signups, 0) AS signups, coalesce(dau, 0) AS dau,
    coalesce(wau, 0) AS wau, coalesce(mau, 0) AS mau, {div0('dau', 'mau')} AS dau_mau_ratio,
    CAST(sessions AS BIGINT) AS sessions, {div('seconds', 'user_days')} AS avg_session_duration_sec,
    {div0('sessions', 'active')} AS sessions_per_active_user, CAST(lessons AS BIGINT) AS lessons_completed,
    {div0('lessons', 'active')} AS lessons_per_active_user, CAST(xp AS BIGINT) AS xp_earned,
    {div0('xp', 'active')} AS xp_per_active_user, CAST(premium AS BIGINT) AS premium_users,
    {div0('premium', 'active')} AS premium_share
  FROM fd LEFT JOIN su USING (date, {key}) LEFT JOIN dau USING (date, {key})
  LEFT JOIN wau USING (date, {key}) LEFT JOIN mau USING (date, {key}))"""


KPI = [*FACT, UD, kpis("variant")]
LCD = "lcd AS (SELECT date, lifecycle_state AS state, variant, count(DISTINCT user_id) AS users FROM fact GROUP BY 1, 2, 3)"


def cohorts(offsets: str, by_variant: bool = True, incomplete: bool = False) -> str:
    """Each user probed on signup + n against the active days."""
    v = ", variant" if by_variant else ""
    match = "AND ud.variant = p.variant" if by_variant else ""
    keep = "" if incomplete else "WHERE signup_date + n <= (SELECT max(date) FROM ud)"
    flag = ", bool_and(signup_date + n <= (SELECT max(date) FROM ud)) AS is_fully_observed" if incomplete else ""
    return f"""ret AS (
  SELECT signup_date AS cohort_date{v}, CAST(count(*) FILTER (hit) AS BIGINT) AS retained_users,
    CAST(n AS INTEGER) AS day_n, count(DISTINCT user_id) AS cohort_size,
    {div('count(*) FILTER (hit)', 'count(DISTINCT user_id)')} AS retention_rate{flag}
  FROM (SELECT p.*, EXISTS (SELECT 1 FROM ud WHERE ud.user_id = p.user_id {match}
      AND ud.date = p.signup_date + p.n) AS hit
    FROM (SELECT u.*, n FROM u CROSS JOIN (SELECT CAST(unnest({offsets}) AS INTEGER) AS n) {keep}) p)
  GROUP BY signup_date, n{v})"""


RET = cohorts("[1, 7, 30]")

STEPS = ["signup", "app_open", "lesson_started", "lesson_completed"]
RATES = ",\n    ".join(f"{div0('n_' + b, 'n_' + a)} AS cr_{b}_given_{a}" for a, b in zip(STEPS, STEPS[1:]))


def daily_funnel(key: str | None) -> str:
    k = f", {key}" if key else ""
    counts = ", ".join(
        f"count(DISTINCT user_id) FILTER (event_name = '{s}') AS n_{s}" for s in STEPS
    )
    return f"""SELECT *, {RATES} FROM (SELECT event_date AS date{k}, {counts} FROM e
WHERE event_name IN {tuple(STEPS)} GROUP BY event_date{k})"""


def cohort_funnel(key: str, matched: bool) -> str:
    own = "AND e.variant = u.variant" if matched else ""
    reached = ", ".join(
        f"count(DISTINCT u.user_id) FILTER (EXISTS (SELECT 1 FROM e WHERE e.user_id = u.user_id {own} "
        f"AND e.event_name = '{s}')) AS n_{s}" for s in STEPS[1:]
    )
    return f"""SELECT *, {RATES} FROM (SELECT signup_date AS cohort_date, {key},
  count(DISTINCT user_id) AS n_signup, {reached} FROM u GROUP BY signup_date, {key})"""


WIDE = """wide AS (
  SELECT date, nullif(count(DISTINCT user_id) FILTER (variant = 'control'), 0) AS control,
    nullif(count(DISTINCT user_id) FILTER (variant = 'treatment'), 0) AS treatment
  FROM (SELECT ud.user_id, ud.date, u.variant FROM ud JOIN u USING (user_id)) GROUP BY date)"""
ROLL = "(SELECT min(signup_date) + 15 FROM u)"
SPA = f"""spa AS (
  SELECT date, {div('sc', 'wide.control')} AS control, {div('st', 'wide.treatment')} AS treatment
  FROM (SELECT CAST(session_start AS DATE) AS date,
      nullif(count(session_id) FILTER (u.variant = 'control'), 0) AS sc,
      nullif(count(session_id) FILTER (u.variant = 'treatment'), 0) AS st
    FROM s JOIN u USING (user_id) GROUP BY 1) FULL JOIN wide USING (date))"""
AST = f"""ast AS (
  SELECT event_date AS date, {mean('streak_length', "variant = 'control'")} AS control,
    {mean('streak_length', "variant = 'treatment'")} AS treatment
  FROM e WHERE event_name = 'lesson_completed' GROUP BY 1)"""
SHARE = f"""share AS (
  SELECT signup_date AS date, count(DISTINCT user_id) FILTER (variant = 'control') AS control,
    count(DISTINCT user_id) FILTER (variant = 'treatment') AS treatment,
    count(DISTINCT user_id) AS total,
    {div("count(DISTINCT user_id) FILTER (variant = 'treatment')", 'count(DISTINCT user_id)')} AS treat_share
  FROM u GROUP BY 1)"""
RATE = f"""rate AS (
  SELECT date, control, treatment, CAST(control_cum AS BIGINT) AS control_cum,
    CAST(treatment_cum AS BIGINT) AS treatment_cum, {div('control', 'control_cum')} AS dau_rate_control,
    {div('treatment', 'treatment_cum')} AS dau_rate_treatment
  FROM (SELECT wide.*,
      (SELECT sum(share.control) FROM share WHERE share.date <= wide.date) AS control_cum,
      (SELECT sum(share.treatment) FROM share WHERE share.date <= wide.date) AS treatment_cum
    FROM wide WHERE control IS NOT NULL AND treatment IS NOT NULL))"""


def comparison(source: str) -> str:
    return f"""SELECT count(*) AS days, avg(treatment) / avg(control) AS mean_ratio,
    quantile_cont(abs((treatment - control) / (0.5 * (treatment + control))), 0.95) AS p95_abs_gap,
    corr(control, treatment) AS corr FROM {source}"""


DURATION = f"""SELECT CAST(session_start AS DATE) AS date{{k}}, {div('sum(session_duration_sec)', 'count(*)')}
  AS avg_session_duration_sec FROM s {{join}} GROUP BY ALL"""

PER = """per AS (
  SELECT event_date AS date, variant, user_id, max(CAST(event_name = 'lesson_started' AS INTEGER)) AS saw,
    max(CAST(event_name = 'lesson_completed' AS INTEGER)) AS paid FROM e
  WHERE event_name IN ('lesson_started', 'lesson_completed') GROUP BY 1, 2, 3)"""

GUARD = f"""dur AS ({DURATION.format(k=', u.variant', join='JOIN u USING (user_id)')}),
com AS (SELECT event_date AS date, variant, {div("count(*) FILTER (event_name = 'lesson_completed')",
    "count(*) FILTER (event_name = 'lesson_started')")} AS lesson_completion_rate
  FROM e WHERE event_name IN ('lesson_started', 'lesson_completed') GROUP BY 1, 2),
hea AS (SELECT event_date AS date, variant, {div('sum(greatest(-hearts_delta, 0))',
    f'count(DISTINCT user_id) FILTER (event_name IN {ACTIVE})')} AS hearts_lost_per_user FROM e GROUP BY 1, 2),
{PER},
con AS (SELECT date, variant, {div('sum(saw * paid)', 'sum(saw)')} AS purchase_conversion FROM per GROUP BY 1, 2),
guard AS (SELECT * FROM dur FULL JOIN com USING (date, variant) FULL JOIN hea USING (date, variant)
  FULL JOIN con USING (date, variant))"""

GUARD_NAMES = ["avg_session_duration_sec", "lesson_completion_rate", "hearts_lost_per_user", "purchase_conversion"]


def lift(metric: str, value: str, source: str) -> str:
    c, t = (f"avg({value}) FILTER (variant = '{a}')" for a in ("control", "treatment"))
    return f"""SELECT '{metric}' AS metric, round({c}, 6) AS control, round({t}, 6) AS treatment,
  round(CASE WHEN {c} > 0 THEN {t} / {c} - 1 END, 6) AS lift FROM {source}"""


def pre_post(metric: str, source: str) -> str:
    return f"""SELECT '{metric}' AS metric, round(avg(control), 6) AS control,
  round(avg(treatment), 6) AS treatment, round(avg(treatment) / avg(control) - 1, 6) AS diff_pct, "window"
FROM (SELECT *, CASE WHEN date < {ROLL} THEN 'pre' ELSE 'post' END AS "window" FROM {source}) GROUP BY "window" """


def check(name: str, table: str, count: str) -> str:
    """One row of the report from a scalar count."""
    return f"""SELECT '{name}' AS "check", '{table}' AS "table", CAST(n AS BIGINT) AS violations, n = 0 AS passed
FROM (SELECT coalesce(({count}), 0) AS n)"""


def repeated(table: str, *keys: str) -> str:
    k = ", ".join(keys)
    return f"SELECT sum(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {k} HAVING count(*) > 1)"


def bad(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def worse_days(source: str, later: str, earlier: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {later} > {earlier}"


def event_pivot(count: str) -> str:
    names = ["app_open", "lesson_started", "lesson_completed"]
    cells = ", ".join(f"{count} FILTER (event_name = '{n}') AS {n}" for n in names)
    return f"SELECT event_date, {cells} FROM e WHERE event_name IN {ACTIVE} GROUP BY 1"


LESSON_ORDER = """lo AS (
  SELECT user_id, session_id, min(a.event_time) AS t_started, min(b.event_time) AS t_completed
  FROM (SELECT * FROM es WHERE event_name = 'lesson_started') a
  JOIN (SELECT * FROM es WHERE event_name = 'lesson_completed') b USING (user_id, session_id)
  GROUP BY 1, 2)"""


def report() -> str:
    in_session = "(SELECT es.*, s.session_start, s.session_end FROM es LEFT JOIN s USING (session_id))"
    signup = "(SELECT {t}.*, u.signup_time FROM {t} JOIN u USING (user_id))"
    parts = [
        check("unique_user_id", "users", repeated("u", "user_id")),
        check("unique_session_id", "sessions", repeated("s", "session_id")),
        check("unique_event_id", "events", repeated("e", "event_id")),
        check("user_exists", "sessions", bad("s", "user_id NOT IN (SELECT user_id FROM u)")),
        check("user_exists", "events", bad("e", "user_id NOT IN (SELECT user_id FROM u)")),
        check("signup_time_known", "users", bad("u", "signup_time IS NULL")),
        check("signup_date_known", "users", bad("u", "signup_date IS NULL")),
        check("session_start_known", "sessions", bad("s", "session_start IS NULL")),
        check("session_end_known", "sessions", bad("s", "session_end IS NULL")),
        check("end_not_before_start", "sessions", bad("s", "session_end < session_start")),
        check("duration_not_negative", "sessions", bad("s", "session_duration_sec < 0")),
        check("duration_matches", "sessions", bad(
            "s", "abs(date_diff('microsecond', session_start, session_end) / 1e6 - session_duration_sec) > 2.5")),
        check("event_time_known", "events", bad("e", "event_time IS NULL")),
        check("event_date_known", "events", bad("e", "event_date IS NULL")),
        check("date_matches_time", "events", bad("e", "CAST(event_time AS DATE) <> event_date")),
        check("name_in_taxonomy", "events", bad("e", "event_name IS NULL")),
        check("xp_not_negative", "events", bad("e", "event_name = 'lesson_completed' AND xp_delta < 0")),
        check("streak_not_negative", "events", bad("e", "streak_length < 0")),
        # The test events have no lesson ids, so this check cannot be answered.
        """SELECT 'lesson_present' AS "check", 'events' AS "table", CAST(NULL AS BIGINT) AS violations, FALSE AS passed""",
        check("lesson_started_within_app_open_events", "events", worse_days("pe", "lesson_started", "app_open")),
        check("lesson_completed_within_lesson_started_events", "events", worse_days("pe", "lesson_completed", "lesson_started")),
        check("lesson_started_within_app_open_users", "events", worse_days("pu", "lesson_started", "app_open")),
        check("lesson_completed_within_lesson_started_users", "events", worse_days("pu", "lesson_completed", "lesson_started")),
        check("session_found", "events", bad(in_session, "session_start IS NULL")),
        check("not_before_session", "events", bad(in_session, "event_time < session_start")),
        check("not_after_session", "events", bad(in_session, "event_time > session_end")),
        check("completed_after_started", "events", bad("lo", "t_completed < t_started")),
        check("not_before_signup", "sessions", bad(signup.format(t="s"), "session_start < signup_time")),
        check("not_before_signup", "events", bad(signup.format(t="e"), "event_time < signup_time")),
        check("active_rows_have_variant", "events", bad(
            "e", f"event_name IN {ACTIVE} AND user_id NOT IN (SELECT user_id FROM u)")),
    ]
    pivots = [f"pe AS ({event_pivot('count(*)')})", f"pu AS ({event_pivot('count(DISTINCT user_id)')})"]
    return query(E, U, S, *pivots, LESSON_ORDER, select="\nUNION ALL\n".join(parts))


def mix(states: str, key: str = "") -> str:
    k = f", {key}" if key else ""
    return f"""SELECT date{k}, state, CASE state WHEN 'AtRiskWAU' THEN 'At Risk WAU'
    WHEN 'AtRiskMAU' THEN 'At Risk MAU' ELSE state END AS state_name, users,
  CAST(users AS DOUBLE) / CAST(sum(users) OVER (PARTITION BY date{k}) AS DOUBLE) AS share
FROM (SELECT date, lifecycle_state AS state{k}, count(*) AS users FROM fact
  WHERE lifecycle_state IN {states} GROUP BY ALL)"""


ACTIVE_STATES = "('New', 'Current', 'Reactivated', 'Resurrected')"
HEALTH_STATES = "('Current', 'AtRiskWAU', 'AtRiskMAU', 'Dormant')"
STATE_NAMES = ["New", "Current", "Reactivated", "Resurrected", "AtRiskWAU", "AtRiskMAU", "Dormant"]

# Orders as a fact: activity only inside the table, from each customer's first order on.
OFACT = f"""spine AS (SELECT *, {days('signup_date', '(SELECT max(date) FROM oe)')} AS date FROM ou),
fw AS (
  SELECT c.user_id, c.date, c.signup_date, c.segment, {WINDOW_COUNTS}
  FROM spine c LEFT JOIN ud a ON a.user_id = c.user_id AND a.date BETWEEN c.date - 30 AND c.date
  GROUP BY c.user_id, c.date, c.signup_date, c.segment),
fact AS (SELECT *, {state_case('date', 'signup_date')} AS lifecycle_state FROM fw)"""

TRANSITIONS = """SELECT state, next_state, transitions, CAST(transitions AS DOUBLE) /
  CAST(sum(transitions) OVER (PARTITION BY state) AS DOUBLE) AS probability
FROM (SELECT a.lifecycle_state AS state, b.lifecycle_state AS next_state, count(*) AS transitions
  FROM fact a JOIN fact b ON b.user_id = a.user_id AND b.date = a.date + 1 GROUP BY 1, 2)"""


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # active users
    o["dau"] = query(E, UD, select="SELECT date, variant, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1, 2")
    o["wau"] = query(E, UD, select=trailing("wau", 7, "variant"))
    o["mau"] = query(E, UD, select=trailing("mau", 30, "variant"))
    o["dau_all"] = query(E, UD, select="SELECT date, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1")
    o["wau_all"] = query(E, UD, select=trailing("wau", 7, None))
    o["mau_all"] = query(E, UD, select=trailing("mau", 30, None))
    o["dau_country"] = query(E, U, UDC, select="""SELECT date, country, count(DISTINCT user_id) AS dau
FROM ud WHERE country IS NOT NULL GROUP BY 1, 2""")
    o["wau_country"] = query(E, U, UDC, select=trailing("wau", 7, "country"))
    o["mau_orders"] = query(OE, OUD, select=trailing("mau", 30, None))
    o["active_users"] = query(
        E, UD, f"d AS ({trailing('dau', 1, 'variant')})", f"w AS ({trailing('wau', 7, 'variant')})",
        f"m AS ({trailing('mau', 30, 'variant')})",
        select="SELECT date, variant, dau, wau, mau FROM d JOIN w USING (date, variant) JOIN m USING (date, variant)")
    o["dau_rolling7"] = query(
        E, UD, "d AS (SELECT date, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1)",
        select="""SELECT date, dau, round(avg(dau) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6)
  AS dau_7d_avg FROM d""")
    o["dau_range"] = query(E, UD, "d AS (SELECT date, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1)",
        select="SELECT min(dau) AS min_dau, max(dau) AS max_dau, count(*) AS days FROM d")
    o["dau_segment"] = query(E, U, UD, select="""SELECT date, count(DISTINCT user_id) AS dau FROM ud
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND variant = 'treatment'
  AND user_id IN (SELECT user_id FROM u WHERE signup_channel IN ('BUILDING', 'MACHINERY')) GROUP BY 1""")

    # retention
    o["retention_variant"] = query(E, U, UD, RET, select="SELECT * FROM ret")
    o["retention_all"] = query(E, U, UD, cohorts("[1, 7, 30]", by_variant=False), select="SELECT * FROM ret")
    o["retention_incomplete"] = query(E, U, UD, cohorts("[1, 7, 30]", incomplete=True), select="SELECT * FROM ret")
    o["retention_curve"] = query(E, U, UD, cohorts("range(31)", by_variant=False), select="SELECT * FROM ret")
    o["retention_trend"] = query(E, U, UD, RET, select="SELECT * FROM ret WHERE day_n = 7")
    o["retention_orders"] = query(
        OE, OU, "u AS (SELECT * FROM ou)", OUD, cohorts("[1, 7, 30, 365]", by_variant=False),
        select="SELECT * FROM ret")

    # sessions
    o["sessionize"] = query(E, S, select="SELECT * FROM s")
    o["session_of_event"] = query(E, ES, select="SELECT event_id, user_id, session_id FROM es")
    o["sessions_per_user"] = query(E, U, S, UD, select=f"""
SELECT date, variant, coalesce(sessions, 0) AS sessions, coalesce(active_users, 0) AS active_users,
  {div0('sessions', 'active_users')} AS sessions_per_user
FROM (SELECT CAST(session_start AS DATE) AS date, u.variant, count(DISTINCT session_id) AS sessions
    FROM s JOIN u USING (user_id) GROUP BY 1, 2)
FULL JOIN (SELECT date, variant, count(DISTINCT user_id) AS active_users FROM ud GROUP BY 1, 2)
  USING (date, variant)""")
    o["sessions_per_user_from_sessions"] = query(E, U, S, select=f"""
SELECT *, {div0('sessions', 'active_users')} AS sessions_per_user FROM (
  SELECT CAST(session_start AS DATE) AS date, u.variant, u.country, count(DISTINCT session_id) AS sessions,
    count(DISTINCT user_id) AS active_users
  FROM s JOIN u USING (user_id) WHERE u.country IS NOT NULL GROUP BY 1, 2, 3)""")

    # funnels
    o["funnel_daily"] = query(E, select=daily_funnel("variant"))
    o["agg_funnel_daily"] = query(E, select=daily_funnel(None))
    o["funnel_cohort"] = query(E, U, select=cohort_funnel("variant", True))
    o["funnel_cohort_country"] = query(E, U, select=cohort_funnel("country", False))

    # lifecycle and fact
    o["lifecycle_counts"] = query(E, U, UD, LC, select="SELECT * FROM lc")
    o["lifecycle_counts_all"] = query(
        E, U, UD, state_counts("u", None, "DATE '2024-01-10'", "DATE '2024-02-15'"), select="SELECT * FROM lc")
    o["lifecycle_counts_orders"] = query(
        OE, OU, OUD,
        state_counts("ou", "segment", "(SELECT min(date) FROM oe)", "(SELECT max(date) FROM oe)"),
        select="SELECT * FROM lc")
    o["lifecycle_recent_orders"] = query(
        OE, OU, OUD, state_counts("ou", None, "DATE '2001-07-01'", "DATE '2001-07-31'"), select="SELECT * FROM lc")
    o["lifecycle_wide"] = query(E, U, UD, LC, select="SELECT date, " + ", ".join(
        f"CAST(coalesce(sum(users) FILTER (state = '{s}'), 0) AS DOUBLE) AS {s}" for s in STATE_NAMES
    ) + " FROM lc WHERE variant = 'control' GROUP BY date")
    o["lifecycle_by_arm"] = query(E, U, UD, LC, select="SELECT date, " + ", ".join(
        f"CAST(sum(users) FILTER (state = '{s}' AND variant = '{a}') AS DOUBLE) AS {a}_{s}"
        for a in ("control", "treatment") for s in STATE_NAMES
    ) + " FROM lc GROUP BY date")
    o["user_spine"] = query(U, select=f"""SELECT date, user_id, signup_date,
  CAST(date - signup_date AS INTEGER) AS days_since_signup
FROM (SELECT *, {days("greatest(signup_date, DATE '2024-01-03')", "DATE '2024-01-30'")} AS date FROM u)""")
    o["user_spine_all"] = query(U, select=f"""SELECT date, user_id, signup_date,
  CAST(date - signup_date AS INTEGER) AS days_since_signup
FROM (SELECT *, {days('signup_date', '(SELECT max(signup_date) FROM u)')} AS date FROM u)""")
    o["fact_since"] = query(E, U, S, fact("DATE '2024-01-12'"), select=f"SELECT {FACT_COLS} FROM fact")
    o["lifecycle_since"] = query(E, U, UD, state_counts(
        "u", "variant", "DATE '2024-01-12'", EV_BOUNDS[1], match="AND a.variant = c.variant"), select="SELECT * FROM lc")
    o["fact_user_daily"] = query(*FACT, select=f"SELECT {FACT_COLS} FROM fact")
    o["fact_window"] = query(
        E, U, S, fact("DATE '2024-01-08'", "DATE '2024-01-24'"), select=f"SELECT {FACT_COLS} FROM fact")
    first_users = "few AS (SELECT * FROM u ORDER BY user_id LIMIT 10)"
    last_of_few = LAST_DAY.replace("FROM u)", "FROM few)")
    o["fact_first_users"] = query(
        E, U, S, first_users, fact(last=last_of_few, users="few"),
        select=f"SELECT {FACT_COLS.replace('lifecycle_state', 'CAST(NULL AS VARCHAR) AS lifecycle_state')} FROM fact")
    o["lifecycle_from_fact"] = query(*FACT, select="SELECT date, user_id, lifecycle_state FROM fact")
    o["agg_daily_kpis"] = query(*KPI, select="SELECT * FROM kpi")
    o["agg_daily_kpis_country"] = query(*FACT, UDC, kpis("country"), select="SELECT * FROM kpi")
    o["agg_lifecycle_daily"] = query(*FACT, LCD, select="SELECT * FROM lcd")
    o["agg_lifecycle_orders"] = query(OE, OU, OUD, OFACT, select="""
SELECT date, lifecycle_state AS state, segment, count(DISTINCT user_id) AS users FROM fact GROUP BY 1, 2, 3""")
    o["lifecycle_transitions"] = query(*FACT, select=TRANSITIONS)
    o["lifecycle_transitions_orders"] = query(OE, OU, OUD, OFACT, select=TRANSITIONS)
    o["transitions_from_spans"] = o["lifecycle_transitions"]
    o["transitions_from_spans_orders"] = o["lifecycle_transitions_orders"]
    o["dau_decomposition"] = query(*FACT, select=f"""
SELECT *, active_users = active_state_users AS holds FROM (
  SELECT date, CAST(sum(is_active) AS BIGINT) AS active_users,
    count(*) FILTER (lifecycle_state IN {ACTIVE_STATES}) AS active_state_users,
    count(*) FILTER (lifecycle_state = 'New' AND is_active = 0) AS inactive_new FROM fact GROUP BY date)""")
    # A run starts on an active day without an active day before it and ends on one without one after it.
    o["streak_runs"] = query(E, UD, "a AS (SELECT DISTINCT user_id, date FROM ud)", select="""
SELECT user_id, streak_start, streak_end, CAST(streak_end - streak_start + 1 AS BIGINT) AS streak_length FROM (
  SELECT s.user_id, s.date AS streak_start,
    (SELECT min(t.date) FROM a t WHERE t.user_id = s.user_id AND t.date >= s.date
      AND NOT EXISTS (SELECT 1 FROM a n WHERE n.user_id = t.user_id AND n.date = t.date + 1)) AS streak_end
  FROM a s WHERE NOT EXISTS (SELECT 1 FROM a p WHERE p.user_id = s.user_id AND p.date = s.date - 1))""")
    o["streak_days"] = query(*FACT, select="""
SELECT f.date, f.user_id, CAST(CASE WHEN f.is_active = 0 THEN 0 ELSE f.date - coalesce(max(q.date), f.signup_date - 1)
  END AS BIGINT) AS streak_length
FROM fact f LEFT JOIN fact q ON q.user_id = f.user_id AND q.date < f.date AND q.is_active = 0
GROUP BY f.date, f.user_id, f.is_active, f.signup_date""")

    o["lifecycle_of_months"] = o["lifecycle_from_fact"]
    o["streak_days_of_months"] = o["streak_days"]
    o["transitions_of_months"] = o["lifecycle_transitions"]
    o["lifecycle_of_months_orders"] = query(OE, OU, OUD, OFACT, select="""
SELECT date, lifecycle_state AS state, count(*) AS users FROM fact GROUP BY 1, 2""")
    # The active days of a user that follow each other have the same difference of day and rank.
    o["streaks_of_months_orders"] = query(OE, OU, OUD, OFACT, """r AS (SELECT date, user_id, today > 0 AS act,
  date - CAST(row_number() OVER (PARTITION BY user_id, today > 0 ORDER BY date) AS INTEGER) AS run FROM fact)""", select="""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, streak_length, count(*) AS user_days FROM (
  SELECT date, CASE WHEN act THEN row_number() OVER (PARTITION BY user_id, act, run ORDER BY date) ELSE 0
    END AS streak_length FROM r) GROUP BY 1, 2""")
    o["transitions_of_months_orders"] = o["lifecycle_transitions_orders"]

    o["kpis_of_stored_fact"] = o["job_agg_daily_kpis"] = o["agg_daily_kpis"]
    o["lifecycle_of_stored_fact"] = o["job_agg_lifecycle_daily"] = o["agg_lifecycle_daily"]
    o["decomposition_of_stored_fact"] = o["dau_decomposition"]
    o["job_fact_user_daily"] = o["job_country_fact_user_daily"] = o["fact_user_daily"]
    o["agg_retention_cohort"] = o["job_agg_retention_cohort"] = o["retention_variant"]
    o["job_country_agg_retention_cohort"] = o["retention_all"]
    o["job_country_agg_daily_kpis"] = o["agg_daily_kpis_country"]
    o["job_country_agg_lifecycle_daily"] = query(*FACT, select="""SELECT date, lifecycle_state AS state, country,
  count(DISTINCT user_id) AS users FROM fact WHERE country IS NOT NULL GROUP BY 1, 2, 3""")
    o["job_agg_funnel_daily"] = o["funnel_daily"]

    # dashboards
    o["kpi_cards"] = query(*KPI, RET, "k AS (SELECT * FROM kpi WHERE date = (SELECT max(date) FROM kpi))", select="""
SELECT 'signups' AS metric, CAST(sum(signups) AS DOUBLE) AS value FROM k
UNION ALL SELECT 'dau', CAST(sum(dau) AS DOUBLE) FROM k
UNION ALL SELECT 'wau', CAST(sum(wau) AS DOUBLE) FROM k
UNION ALL SELECT 'mau', CAST(sum(mau) AS DOUBLE) FROM k
UNION ALL SELECT 'dau_mau_ratio', CAST(sum(dau) AS DOUBLE) / CAST(sum(mau) AS DOUBLE) FROM k
UNION ALL SELECT 'd' || day_n || '_retention', CAST(sum(retained_users) AS DOUBLE) / CAST(sum(cohort_size) AS DOUBLE)
  FROM ret r WHERE cohort_date = (SELECT max(cohort_date) FROM ret l WHERE l.day_n = r.day_n) GROUP BY day_n""")
    o["active_user_trend"] = query(*KPI, select="SELECT date, variant, signups, dau, wau, mau FROM kpi")
    o["active_mix"] = query(*FACT, select=mix(ACTIVE_STATES, "variant"))
    o["health_mix"] = query(*FACT, select=mix(HEALTH_STATES))
    o["lessons_per_session"] = query(
        *KPI, select=f"SELECT date, variant, {div('lessons_completed', 'sessions')} AS lessons_per_session FROM kpi")
    o["premium_share"] = query(*KPI, select="""SELECT date, variant, premium_users, premium_share,
  printf('%.2f%%', premium_share * 100) AS premium_text FROM kpi""")
    o["paywall_rate"] = query(E, UD, select=f"""SELECT date, variant, dau, coalesce(shown, 0) AS shown_users,
  {div('coalesce(shown, 0)', 'dau')} AS paywall_rate
FROM (SELECT date, variant, count(DISTINCT user_id) AS dau FROM ud GROUP BY 1, 2)
LEFT JOIN (SELECT event_date AS date, variant, count(DISTINCT user_id) AS shown FROM e
  WHERE event_name = 'lesson_started' GROUP BY 1, 2) USING (date, variant)""")
    o["purchase_conversion"] = query(E, PER, select=f"""SELECT date, CAST(sum(saw) AS BIGINT) AS shown_users, CAST(sum(saw * paid) AS BIGINT) AS buyers,
  {div('sum(saw * paid)', 'sum(saw)')} AS purchase_conversion FROM per GROUP BY date""")
    o["streak_by_variant"] = query(*FACT, select=f"""SELECT date, variant,
  {mean('streak_length_end_of_day')} AS avg_streak,
  {div('count(*) FILTER (streak_length_end_of_day > 0)', 'count(*)')} AS share_on_streak FROM fact GROUP BY 1, 2""")
    o["avg_session_duration"] = query(E, S, select=DURATION.format(k="", join=""))
    o["completion_rate"] = query(E, U, select=f"""SELECT *, {div('completed', 'started')} AS lesson_completion_rate
FROM (SELECT event_date AS date, country, count(*) FILTER (event_name = 'lesson_started') AS started,
    count(*) FILTER (event_name = 'lesson_completed') AS completed
  FROM e JOIN u USING (user_id) WHERE event_name IN ('lesson_started', 'lesson_completed')
    AND country IS NOT NULL GROUP BY 1, 2)""")
    o["hearts_per_user"] = query(*FACT, select=f"""SELECT date, variant,
  {div('sum(hearts_lost)', 'sum(is_active)')} AS hearts_lost_per_user FROM fact GROUP BY 1, 2""")

    # experiment
    o["dau_by_variant_wide"] = query(E, U, UD, WIDE, select="SELECT * FROM wide")
    kept = f"kept AS (SELECT * FROM wide WHERE date < {ROLL} AND control + treatment >= 50)"
    o["aa_check"] = query(E, U, UD, WIDE, kept, f"c AS ({comparison('kept')})", select="""
SELECT days, round(mean_ratio, 6) AS mean_ratio, round(p95_abs_gap, 6) AS p95_abs_gap, round(corr, 6) AS corr,
  days > 10 AS enough_days, abs(mean_ratio - 1) < 0.01 AS mean_ok, p95_abs_gap < 0.15 AS gap_ok, corr > 0.97 AS corr_ok,
  coalesce(days > 10 AND abs(mean_ratio - 1) < 0.01 AND p95_abs_gap < 0.15 AND corr > 0.97, FALSE) AS passed FROM c""")
    smooth = """sm AS (SELECT date, avg(control) OVER w AS control, avg(treatment) OVER w AS treatment, count(*) OVER w AS n
  FROM wide WHERE date < (SELECT min(signup_date) + {days} FROM u) AND control + treatment >= 50
  WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
    for name, n in (("aa_check_smoothed", 25), ("aa_check_smoothed_short", 15)):
        o[name] = query(E, U, UD, WIDE, smooth.format(days=n), f"c AS ({comparison('sm WHERE n = 7')})", select="""
SELECT days, round(mean_ratio, 6) AS mean_ratio, round(p95_abs_gap, 6) AS p95_abs_gap, round(corr, 6) AS corr,
  CASE WHEN days >= 10 THEN corr > 0.98 END AS corr_ok, CASE WHEN days >= 10 THEN p95_abs_gap < 0.12 END AS gap_ok,
  coalesce(days >= 10 AND corr > 0.98 AND p95_abs_gap < 0.12, FALSE) AS passed FROM c""")
    o["signup_share"] = query(U, SHARE, select="SELECT * FROM share")
    points = ", ".join(
        f"round(quantile_cont(treat_share, {p}), 6) AS p{round(100 * p)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
    o["signup_share_distribution"] = query(U, SHARE, select=f"""SELECT count(treat_share) AS "count",
  round(avg(treat_share), 6) AS mean, round(stddev_samp(treat_share), 6) AS std, min(treat_share) AS min, {points},
  max(treat_share) AS max FROM share""")
    o["activity_rate"] = query(E, U, UD, WIDE, SHARE, RATE, select="SELECT * FROM rate")
    o["activity_rate_correlation"] = query(E, U, UD, WIDE, SHARE, RATE, select=f"""
SELECT round(corr(dau_rate_control, dau_rate_treatment), 6) AS corr FROM rate WHERE date < {ROLL}""")
    o["sessions_per_active"] = query(E, S, UD, select=f"""SELECT date, {div('n', 'a')} AS sessions_per_active
FROM (SELECT CAST(session_start AS DATE) AS date, count(session_id) AS n FROM s GROUP BY 1)
FULL JOIN (SELECT date, count(DISTINCT user_id) AS a FROM ud GROUP BY 1) USING (date)""")
    o["sessions_per_active_variant"] = query(E, U, S, UD, WIDE, SPA, select="SELECT * FROM spa")
    o["avg_streak"] = query(E, select=f"""SELECT event_date AS date, {mean('streak_length')} AS avg_streak
FROM e WHERE event_name = 'lesson_completed' GROUP BY 1""")
    o["avg_streak_variant"] = query(E, AST, select="SELECT * FROM ast")
    o["pre_post_summary"] = query(E, U, S, UD, WIDE, SPA, AST, select="\nUNION ALL\n".join(
        pre_post(m, t) for m, t in (("dau", "wide"), ("sess_per_active", "spa"), ("avg_streak", "ast"))))
    o["opens_per_user_variant"] = query(E, U, select=f"""SELECT variant, {mean('opens')} AS opens_per_user
FROM (SELECT user_id, count(*) AS opens FROM e WHERE event_name = 'app_open' GROUP BY 1) JOIN u USING (user_id)
GROUP BY 1""")
    measures = ["dau", "wau", "mau", "sessions_per_active_user", "lessons_per_active_user"]
    o["assign_variant"] = query(U, select="""SELECT * EXCLUDE (variant), CASE WHEN row_number() OVER (
    PARTITION BY signup_date ORDER BY md5(user_id || ':42'), user_id) <= count(*) OVER (PARTITION BY signup_date) // 2
  THEN 'control' ELSE 'treatment' END AS variant FROM u""")
    o["assigned_arms"] = query(OU, select="""SELECT signup_date, CAST(count(*) // 2 AS BIGINT) AS control,
  CAST(count(*) - count(*) // 2 AS BIGINT) AS treatment FROM ou GROUP BY 1""")
    o["kpi_lift"] = query(*KPI, RET, select="\nUNION ALL\n".join([
        *[lift(m, m, "kpi") for m in measures],
        *[lift(f"d{n}_retention", "retention_rate", f"ret WHERE day_n = {n} HAVING count(*) > 0") for n in (1, 7, 30)],
        lift("avg_streak", "streak_length_end_of_day", "fact"),
    ]))
    o["guardrails"] = query(E, U, S, GUARD, select=f"SELECT date, variant, {', '.join(GUARD_NAMES)} FROM guard")
    moments = "\nUNION ALL\n".join(f"""SELECT '{m}' AS metric, avg({m}) FILTER (variant = 'control') AS c,
  avg({m}) FILTER (variant = 'treatment') AS t, sqrt(var_samp({m}) FILTER (variant = 'control')
    / count({m}) FILTER (variant = 'control') + var_samp({m}) FILTER (variant = 'treatment')
    / count({m}) FILTER (variant = 'treatment')) AS err FROM guard WHERE date >= {ROLL}"""
        for m in GUARD_NAMES)
    o["guardrail_test"] = query(E, U, S, GUARD, f"m AS ({moments})", select="""SELECT metric, round(c, 6) AS control,
  round(t, 6) AS treatment, round((t - c) / err, 6) AS z, abs((t - c) / err) > 1.96 AS significant FROM m""")

    # quality
    o["event_counts_pivot"] = query(E, select=event_pivot("count(*)"))
    o["event_users_pivot"] = query(E, select=event_pivot("count(DISTINCT user_id)"))
    o["event_value_counts"] = query(E, select='SELECT event_name, count(*) AS "count" FROM e GROUP BY 1')
    o["quality_report"] = report()
    o["session_gaps"] = query(E, S, select="""
SELECT event_id, event_name, es.user_id, session_id, event_time, session_start + INTERVAL 10 MINUTE AS session_start,
  session_end, CAST(date_diff('microsecond', session_start + INTERVAL 10 MINUTE, event_time) AS DOUBLE) / 1e6 AS gap_sec
FROM es JOIN s USING (session_id) WHERE event_time < session_start + INTERVAL 10 MINUTE""")
    o["unknown_names"] = query(E, select=f"SELECT DISTINCT event_name FROM e WHERE event_name NOT IN {ACTIVE}")
    o["events_before_signup"] = query(E, U, select="""SELECT event_id, user_id, event_time, signup_time
FROM e JOIN u USING (user_id) WHERE event_time < signup_time""")
    o["lesson_order_violations"] = query(E, S, LESSON_ORDER, select="SELECT * FROM lo WHERE t_completed < t_started")
    lengths = ", ".join(f"quantile_cont(session_duration_sec, {p}) AS p{round(100 * p)}" for p in (0.25, 0.5, 0.75, 0.95))
    o["session_lengths"] = query(E, S, select=f"""SELECT count(session_duration_sec) AS "count",
  round(avg(session_duration_sec), 6) AS mean, round(stddev_samp(session_duration_sec), 6) AS std,
  CAST(min(session_duration_sec) AS DOUBLE) AS min, {lengths}, CAST(max(session_duration_sec) AS DOUBLE) AS max FROM s""")
    gap = "abs(date_diff('microsecond', session_start, session_end) / 1e6 - session_duration_sec - user_id % 5)"
    o["duration_differences"] = query(E, S, f"d AS (SELECT round({gap}, 0) AS v FROM s)", select="""
SELECT count(v) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, CAST(min(v) AS DOUBLE) AS min,
  quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, CAST(max(v) AS DOUBLE) AS max
FROM d""")
    o["date_mismatches"] = query(E, select="""SELECT event_id, event_time, CAST(event_time - INTERVAL 1 HOUR AS DATE) AS event_date
FROM e WHERE CAST(event_time - INTERVAL 1 HOUR AS DATE) <> event_date ORDER BY event_id LIMIT 20""")
    o["largest_session_gaps"] = query(E, S, select="""
SELECT event_id, session_id, CAST(date_diff('microsecond', session_start + INTERVAL 10 MINUTE, event_time) AS DOUBLE) / 1e6 AS gap_sec
FROM es JOIN s USING (session_id) WHERE event_time < session_start + INTERVAL 10 MINUTE ORDER BY gap_sec, event_id LIMIT 20""")
    lacking = [("users", 6), ("sessions", 2), ("events", 5)]
    o["quality_report_layout"] = query(E, select="\nUNION ALL\n".join([
        check("unique_event_id", "events", repeated("e", "event_id")),
        *[check("columns_present", t, f"SELECT {n}") for t, n in lacking],
        check("date_matches_time", "events", bad("e", "CAST(event_time - INTERVAL 1 HOUR AS DATE) <> event_date"))]))
    o["lesson_present"] = check("lesson_present", "events", bad("lineitem", "l_linestatus <> 'F'"))
    o["lesson_exists"] = check("lesson_exists", "events", bad(
        "lineitem", "l_linestatus = 'F' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)"))
    o["lineitem_keys"] = check(
        "unique_l_orderkey_l_linenumber", "lineitem", repeated("lineitem", "l_orderkey", "l_linenumber"))
    o["orders_reference"] = check(
        "customer_exists", "orders", bad("orders", "o_custkey NOT IN (SELECT c_custkey FROM customer)"))
    o["shipped_before_ordered"] = """SELECT l_linenumber, count(*) AS violations
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate GROUP BY 1"""
    # kept range by range, files
    for table in ("fact_user_daily", "agg_daily_kpis", "agg_retention_cohort", "agg_funnel_daily", "agg_lifecycle_daily"):
        o[f"rebuilt_{table}"] = o[f"files_{table}"] = o[f"job_{table}"]
    for table in ("orders", "customer"):
        o[f"{table}_csv"] = o[f"{table}_parquet"] = f"SELECT * FROM {table}"
    o["rebuilt_user_state"] = query(*FACT, select="""
SELECT u.user_id, max(f.date) FILTER (is_active = 1) AS last_active, max(p.date) AS last_premium_day,
  max_by(p.is_premium, p.date) AS last_premium, CAST(sum(is_active) AS BIGINT) AS active_days,
  CAST(sum(f.sessions_count) AS BIGINT) AS sessions_count, CAST(sum(f.session_duration_sec) AS BIGINT) AS session_duration_sec,
  CAST(sum(f.lessons_completed) AS BIGINT) AS lessons_completed, CAST(sum(f.xp_earned) AS BIGINT) AS xp_earned,
  CAST(sum(f.hearts_lost) AS BIGINT) AS hearts_lost
FROM u JOIN fact f USING (user_id) LEFT JOIN (SELECT * FROM el WHERE is_premium IS NOT NULL) p USING (user_id, date) GROUP BY 1""")
    o["fact_text_ids"] = o["fact_user_daily"]
    o["last_event_text_ids"] = query(E, select="""
SELECT user_id, event_date AS date, streak_length AS streak_length_end_of_day, is_premium FROM e
QUALIFY row_number() OVER (PARTITION BY user_id, event_date ORDER BY event_id DESC) = 1""")

    o["rejected_orders"] = """WITH r AS (
  SELECT o_orderkey, 'o_orderdate' AS "column", 'no day' AS raw, 'not a timestamp_ntz' AS reason FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, 'o_totalprice', 'much', 'not a double' FROM orders WHERE o_orderkey % 11 = 0
  UNION ALL SELECT o_orderkey, 'o_custkey', NULL, 'missing' FROM orders WHERE o_orderkey % 13 = 0)
SELECT CAST(o_orderkey AS VARCHAR) AS "key", "column", raw, reason, o_orderkey % 13 = 0 AS row_dropped FROM r"""
    o["loaded_orders"] = """SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_orderdate,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 13 <> 0"""
    o["appended_customers"] = "SELECT * FROM customer"

    # measures with large domains, sketches and bitmaps
    points = ", ".join(f"round(quantile_cont(o_totalprice, {p}), 6) AS p{round(100 * p)}" for p in (0.01, 0.25, 0.5, 0.75, 0.99))
    o["order_prices"] = f"""SELECT count(o_totalprice) AS "count", round(avg(o_totalprice), 6) AS mean,
  round(stddev_samp(o_totalprice), 6) AS std, min(o_totalprice) AS min, {points}, max(o_totalprice) AS max FROM orders"""
    o["approx_actives"] = query(
        E, UD, f"w AS ({trailing('wau', 7, 'variant')})", f"m AS ({trailing('mau', 30, 'variant')})", select="""
SELECT date, variant, wau, mau, TRUE AS wau_in_bounds, TRUE AS mau_in_bounds FROM w JOIN m USING (date, variant)""")
    o["retention_bitmaps_orders"] = query(
        OE, OU, "u AS (SELECT * FROM ou)", OUD, cohorts("range(91)", by_variant=False), select="SELECT * FROM ret")
    o["retention_bitmaps_variant"] = o["retention_incomplete"]
    o["return_on_or_after"] = query(OE, OU, OUD, select=f"""
SELECT signup_date AS cohort_date, CAST(count(*) FILTER (last >= signup_date + n) AS BIGINT) AS retained_users, n AS day_n,
  count(*) AS cohort_size, {div('count(*) FILTER (last >= signup_date + n)', 'count(*)')} AS retention_rate
FROM ou JOIN (SELECT user_id, max(date) AS last FROM ud GROUP BY 1) USING (user_id)
  CROSS JOIN (SELECT CAST(unnest([1, 7, 30, 90]) AS INTEGER) AS n)
WHERE signup_date + n <= (SELECT max(date) FROM ud) GROUP BY signup_date, n""")
    by_user = f"""pd AS (SELECT user_id, event_date, count(*) FILTER (event_name = 'lesson_started') AS started,
    count(*) FILTER (event_name = 'lesson_completed') AS completed, sum(greatest(-hearts_delta, 0)) AS hearts,
    max(CASE WHEN event_name IN {ACTIVE} THEN 1 ELSE 0 END) AS active, bool_or(event_name = 'lesson_started') AS saw,
    bool_or(event_name = 'lesson_completed') AS paid FROM e WHERE event_date >= {ROLL} GROUP BY 1, 2),
pu AS (SELECT user_id, sum(started) AS started, sum(completed) AS completed, sum(hearts) AS hearts, sum(active) AS active,
    count(*) FILTER (saw) AS saw, count(*) FILTER (saw AND paid) AS buying FROM pd GROUP BY 1),
ps AS (SELECT user_id, sum(session_duration_sec) AS seconds, count(*) AS sessions FROM s
  WHERE CAST(session_start AS DATE) >= {ROLL} GROUP BY 1),
su AS (SELECT * FROM (SELECT user_id, variant, unnest([
    {{'metric': '{GUARD_NAMES[0]}', 'x': coalesce(seconds, 0)::DOUBLE, 'y': coalesce(sessions, 0)::DOUBLE}},
    {{'metric': '{GUARD_NAMES[1]}', 'x': coalesce(completed, 0)::DOUBLE, 'y': coalesce(started, 0)::DOUBLE}},
    {{'metric': '{GUARD_NAMES[2]}', 'x': coalesce(hearts, 0)::DOUBLE, 'y': coalesce(active, 0)::DOUBLE}},
    {{'metric': '{GUARD_NAMES[3]}', 'x': coalesce(buying, 0)::DOUBLE, 'y': coalesce(saw, 0)::DOUBLE}}], recursive := true)
  FROM u LEFT JOIN pu USING (user_id) LEFT JOIN ps USING (user_id)) WHERE x <> 0 OR y <> 0)"""
    o["guardrail_by_user"] = query(E, U, S, by_user, """av AS (SELECT metric, variant, avg(x) / avg(y) AS r,
    (var_samp(x) - 2 * avg(x) / avg(y) * covar_samp(x, y) + pow(avg(x) / avg(y), 2) * var_samp(y)) / count(*) / avg(y) / avg(y) AS v
  FROM su GROUP BY 1, 2),
d AS (SELECT metric, c.r AS control, t.r AS treatment, t.r - c.r AS diff, sqrt(c.v + t.v) AS err
  FROM (SELECT * FROM av WHERE variant = 'control') c JOIN (SELECT * FROM av WHERE variant = 'treatment') t USING (metric))""",
        select="""SELECT metric, round(control, 6) AS control, round(treatment, 6) AS treatment, round(diff, 6) AS difference,
  round(diff - 1.96 * err, 6) AS low, round(diff + 1.96 * err, 6) AS high, round(diff / err, 6) AS z,
  abs(diff / err) > 1.96 AS significant FROM d""")
    o["guardrail_bootstrap"] = query(E, U, S, by_user, """
po AS (SELECT k, sum(exp(-1) / gamma(k + 1)) OVER (ORDER BY k) AS upto FROM range(17) t(k)),
w AS (SELECT su.*, i, (SELECT count(*) FROM po WHERE upto <= share) AS n FROM (SELECT su.*, i,
    CAST('0x' || substr(md5(user_id || ':' || i || ':42'), 1, 8) AS BIGINT) / 4294967296 AS share FROM su, range(1, 101) t(i)) su),
b AS (SELECT metric, i, variant, sum(n * x) / sum(n * y) AS r FROM w GROUP BY ALL),
db AS (SELECT metric, t.r - c.r AS diff FROM (SELECT * FROM b WHERE variant = 'control') c
  JOIN (SELECT * FROM b WHERE variant = 'treatment') t USING (metric, i)),
a AS (SELECT metric, sum(x) FILTER (variant = 'treatment') / sum(y) FILTER (variant = 'treatment')
    - sum(x) FILTER (variant = 'control') / sum(y) FILTER (variant = 'control') AS difference FROM su GROUP BY 1)""",
        select="""SELECT metric, round(difference, 6) AS difference, round(quantile_cont(diff, 0.025), 6) AS low,
  round(quantile_cont(diff, 0.975), 6) AS high FROM a JOIN db USING (metric) GROUP BY metric, difference""")

    o["bucketed_events_before_signup"] = o["events_before_signup"]
    o["table_rows"] = "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS "table", count(*) AS "rows" FROM {t}""" for t in ("customer", "events", "lineitem", "nation", "orders"))
    return o
