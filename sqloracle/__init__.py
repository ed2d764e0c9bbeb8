"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL against the driver's test tables (views ``customer``,
``nation``, ``orders``, ``lineitem``, ``part``, ``events``): the adapter CTEs
derive the nine source tables, the model CTEs are written from the models'
definitions - what a row is and what each column says about it - with EXISTS
for "did it ever happen", aggregates as correlated lookups and small tables for
buckets and tiers, so the oracle shares no plan with the Spark side.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
CAP = "DATE '2001-06-01'"
CAP_END = "DATE '2001-06-30'"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def week(d: str, start: str = "sunday") -> str:
    if start == "monday":
        return f"CAST(date_trunc('week', CAST({d} AS DATE)) AS DATE)"
    return f"(CAST({d} AS DATE) - CAST(dayofweek(CAST({d} AS DATE)) AS INTEGER))"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def hash32(key_sql: str) -> str:
    return f"CAST(('0x' || substr(md5({key_sql}), 1, 8)) AS BIGINT)"


def bucket(key_sql: str) -> str:
    return f"({hash32(key_sql)} % 100)"


# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


# ---------------------------------------------------------------- adapters
cte(
    "f_plans",
    """SELECT * FROM (VALUES
        (1, 'Basic', CAST(7.99 AS DECIMAL(8,2)), 'monthly', 1, 'HD'),
        (2, 'Standard', CAST(12.99 AS DECIMAL(8,2)), 'monthly', 2, 'HD'),
        (3, 'Premium', CAST(17.99 AS DECIMAL(8,2)), 'monthly', 4, '4K'),
        (4, 'Annual', CAST(119.99 AS DECIMAL(8,2)), 'annual', 4, '4K'))
      AS t(plan_id, plan_name, price_monthly, billing_period, max_streams, resolution)""",
)
cte(
    "f_channel_cac",
    """SELECT * FROM (VALUES ('automobile', 0), ('building', 7), ('furniture', 13), ('household', 31))
      AS t(acquisition_channel, channel_cac)""",
)
cte(
    "f_users",
    """SELECT c.c_custkey AS user_id,
         DATE '1995-01-01' + CAST((c.c_custkey * 37) % 540 AS INTEGER) AS signup_date,
         CAST(DATE '1995-01-01' + CAST((c.c_custkey * 37) % 540 AS INTEGER) AS TIMESTAMP) AS signup_timestamp,
         lower(c.c_mktsegment) AS acquisition_channel,
         n.n_name AS country,
         CASE c.c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS primary_device,
         CAST(16 + c.c_custkey % 60 AS INTEGER) AS age,
         CAST(NULL AS VARCHAR) AS email
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
cte(
    "f_subscriptions",
    """SELECT o.o_orderkey AS subscription_id,
         CASE WHEN o.o_orderkey % 50 = 7 THEN -o.o_custkey ELSE o.o_custkey END AS user_id,
         CAST(1 + o.o_orderkey % 4 AS INTEGER) AS plan_id,
         CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 23 = 0 THEN 'active'
              WHEN o.o_orderstatus = 'F' THEN 'churned' WHEN o.o_orderstatus = 'O' THEN 'active'
              WHEN o.o_orderstatus = 'P' THEN 'trial_expired' END AS status,
         CAST(o.o_orderdate AS TIMESTAMP) AS started_at,
         CASE o.o_orderstatus
           WHEN 'F' THEN CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST(30 * (1 + o.o_orderkey % 24) AS INTEGER))
           WHEN 'P' THEN CAST(o.o_orderdate AS TIMESTAMP) + to_days(7)
         END AS ended_at,
         o.o_orderstatus = 'P' AS is_trial,
         o.o_orderstatus <> 'P' AS converted_to_paid,
         CASE WHEN o.o_orderstatus = 'P' THEN CAST(0 AS DECIMAL(8,2))
              ELSE CAST(CASE WHEN p.billing_period = 'annual' THEN CAST(round(p.price_monthly / 12, 2) AS DECIMAL(8,2))
                             ELSE p.price_monthly END
                        - CASE WHEN o.o_orderkey % 19 = 3 THEN 1 ELSE 0 END AS DECIMAL(8,2)) END AS mrr
       FROM orders o LEFT JOIN f_plans p ON p.plan_id = 1 + o.o_orderkey % 4""",
    "f_plans",
)
cte(
    "f_events",
    """SELECT e.event_id, e.user_id,
         CASE WHEN m.stage IS NULL THEN e.event_type WHEN e.user_id % m.n = m.r THEN 'page_view' ELSE m.stage END
           AS event_type,
         CAST(e.ts AS TIMESTAMP) AS event_timestamp
       FROM events e
       LEFT JOIN (VALUES ('signup', 'signup_completed', 1, 1), ('view', 'trial_started', 7, 0),
                         ('error', 'paywall_view', 4, 1), ('click', 'subscribe_clicked', 3, 2),
                         ('purchase', 'subscribed', 2, 1)) AS m(name, stage, n, r) ON m.name = e.event_type""",
)
cte(
    "f_lines",
    """SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS line_id,
         o.o_custkey AS user_id,
         DATE '1995-01-01'
           + CAST(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) % 547 AS INTEGER) AS line_date,
         l.l_partkey, l.l_quantity, l.l_discount, l.l_returnflag
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
)
cte(
    "f_sessions",
    """SELECT line_id AS session_id, user_id, line_date AS session_date,
         CAST(line_date AS TIMESTAMP) AS session_start,
         CAST(l_quantity * 4 AS INTEGER) AS duration_minutes,
         l_returnflag AS device
       FROM f_lines""",
    "f_lines",
)
cte(
    "f_content_views",
    """SELECT line_id AS view_id, user_id, line_id AS session_id, l_partkey AS content_id,
         line_date AS view_date,
         CAST(l_discount * 10 AS DECIMAL(4,2)) AS watch_percentage,
         CAST(l_discount * 10 AS DECIMAL(4,2)) >= CAST(0.9 AS DECIMAL(4,2)) AS completed
       FROM f_lines""",
    "f_lines",
)
cte(
    "f_content_catalog",
    """SELECT p_partkey AS content_id, p_name AS title,
         CASE WHEN p_partkey % 2 = 0 THEN 'movie' ELSE 'series' END AS content_type,
         p_type AS genre,
         CAST(2018 + p_partkey % 8 AS INTEGER) AS release_year,
         CAST(p_size AS INTEGER) AS duration_minutes,
         p_partkey % 3 = 0 AS is_original
       FROM part""",
)
cte(
    "f_experiments",
    """SELECT experiment_id, experiment_name, variant, start_date, end_date, variant LIKE 'control%' AS is_control, place
       FROM (VALUES
        ('trial_weeks', 'Weeks of trial', 'control_one', DATE '1995-03-01', DATE '1995-09-30', 0),
        ('trial_weeks', 'Weeks of trial', 'four', DATE '1995-03-01', DATE '1995-09-30', 1),
        ('trial_weeks', 'Weeks of trial', 'two', DATE '1995-03-01', DATE '1995-09-30', 2),
        ('tile_order', 'Order of home tiles', 'control_fixed', DATE '1995-08-01', DATE '1996-04-30', 0),
        ('tile_order', 'Order of home tiles', 'shuffled', DATE '1995-08-01', DATE '1996-04-30', 1),
        ('price_note', 'Note beside the price', 'control_none', DATE '1996-02-01', DATE '1996-06-15', 0),
        ('price_note', 'Note beside the price', 'long_note', DATE '1996-02-01', DATE '1996-06-15', 1),
        ('price_note', 'Note beside the price', 'short_note', DATE '1996-02-01', DATE '1996-06-15', 2))
      AS t(experiment_id, experiment_name, variant, start_date, end_date, place)""",
)
cte(
    "f_effects",
    """SELECT experiment_id, variant, CAST(signup_lift AS DECIMAL(6,3)) AS signup_lift,
         CAST(d30_retention_lift AS DECIMAL(6,3)) AS d30_retention_lift
       FROM (VALUES ('trial_weeks', 'two', 0.015, 0.04), ('trial_weeks', 'four', 0.035, -0.01),
                    ('tile_order', 'shuffled', -0.02, 0.005), ('price_note', 'short_note', 0.07, 0.0))
         AS t(experiment_id, variant, signup_lift, d30_retention_lift)""",
)
cte(
    "f_eligible",
    """SELECT w.experiment_id, u.user_id, u.signup_timestamp
       FROM f_users u
       JOIN (SELECT experiment_id, min(start_date) AS s, max(end_date) AS e FROM f_experiments GROUP BY 1) w
         ON u.signup_timestamp >= CAST(w.s AS TIMESTAMP) AND u.signup_timestamp <= CAST(w.e AS TIMESTAMP)""",
    "f_users",
    "f_experiments",
)
cte(
    "f_assignments",
    f"""SELECT g.experiment_id, g.user_id, x.variant, g.signup_timestamp AS assigned_at
       FROM f_eligible g
       JOIN f_experiments x
         ON x.experiment_id = g.experiment_id
        AND x.place = {hash32("g.experiment_id || ':v:' || CAST(g.user_id AS VARCHAR)")}
            % (SELECT count(*) FROM f_experiments n WHERE n.experiment_id = g.experiment_id)
       JOIN (VALUES (1), (2)) AS logged(i) ON logged.i = 1 OR g.user_id % 83 = 5
       WHERE {bucket("g.experiment_id || ':' || CAST(g.user_id AS VARCHAR)")} < 80""",
    "f_eligible",
    "f_experiments",
)

# The export of subscriptions with planted faults: one row for each row of the files.
cte(
    "f_raw",
    """SELECT CAST(subscription_id AS VARCHAR) AS subscription_id,
         CASE WHEN fault <> 3 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN fault = 1 THEN 'x' ELSE '' END || plan_id AS plan_id,
         CASE WHEN fault = 2 THEN status || ' since the "twentieth" of the month'
              WHEN fault = 5 AND time = 2 THEN 'paused, "for now"' ELSE status END AS status,
         CASE WHEN fault = 6 THEN 'yesterday' ELSE strftime(started_at, '%Y-%m-%d %H:%M:%S') END AS started_at,
         strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS ended_at,
         CASE WHEN is_trial THEN 'True' ELSE 'False' END AS is_trial,
         CASE WHEN converted_to_paid THEN 'True' ELSE 'False' END AS converted_to_paid,
         CASE fault WHEN 6 THEN '1e99' WHEN 7 THEN '12345678.90' ELSE CAST(mrr AS VARCHAR) END AS mrr,
         fault
       FROM (SELECT *, subscription_id % 97 AS fault FROM f_subscriptions)
       JOIN (VALUES (1), (2)) AS n(time) ON time = 1 OR fault IN (4, 5)""",
    "f_subscriptions",
)
# Of two sound rows of one subscription the one with the smaller hash is loaded.
cte(
    "f_raw_ranked",
    """SELECT *, row_number() OVER (PARTITION BY subscription_id ORDER BY md5(concat_ws('|',
           coalesce('=' || subscription_id, ''), coalesce('=' || user_id, ''), coalesce('=' || plan_id, ''),
           coalesce('=' || status, ''), coalesce('=' || started_at, ''), coalesce('=' || ended_at, ''),
           coalesce('=' || is_trial, ''), coalesce('=' || converted_to_paid, ''), coalesce('=' || mrr, '')))) AS place
       FROM f_raw""",
    "f_raw",
)

# ---------------------------------------------------------------- models


# A row per user; a stage is reached if any event of its kind exists.
STAGE_EVENTS = {
    "reached_signup": "signup_completed",
    "reached_trial": "trial_started",
    "reached_paywall": "paywall_view",
    "reached_subscribe_click": "subscribe_clicked",
    "reached_paid": "subscribed",
}
WEEKS = {"": "sunday", "_mon": "monday"}


def happened(condition: str) -> str:
    return f"CAST(EXISTS (SELECT 1 FROM {condition}) AS INTEGER)"


for suffix, day in WEEKS.items():
    reached = ", ".join(
        f"""{happened(f"f_events WHERE f_events.user_id = f_users.user_id AND event_type = '{kind}'")} AS {flag}"""
        for flag, kind in STAGE_EVENTS.items()
    )
    cte(
        f"m_funnel{suffix}",
        f"""SELECT user_id, signup_date, signup_timestamp, acquisition_channel, country, primary_device, age,
              {month("signup_date")} AS signup_month, {week("signup_date", day)} AS signup_week, {reached}
            FROM f_users""",
        "f_users",
        "f_events",
    )

# The subscription that no other one of the user precedes.
cte(
    "m_first_sub",
    """SELECT user_id, first.plan_id, first.started_at AS first_sub_started, first.is_trial,
         first.converted_to_paid, first.mrr AS first_sub_mrr
       FROM (SELECT user_id, arg_min({'plan_id': plan_id, 'started_at': started_at, 'is_trial': is_trial,
                                      'converted_to_paid': converted_to_paid, 'mrr': mrr},
                                     (started_at IS NULL, coalesce(started_at, TIMESTAMP '9999-01-01'), subscription_id)) AS first
             FROM f_subscriptions GROUP BY user_id)""",
    "f_subscriptions",
)

for suffix in WEEKS:
    cte(
        f"m_acq{suffix}",
        f"""SELECT who.*, one.plan_id, one.first_sub_started, one.converted_to_paid, one.first_sub_mrr,
              (SELECT plan_name FROM f_plans WHERE f_plans.plan_id = one.plan_id) AS plan_name,
              (SELECT billing_period FROM f_plans WHERE f_plans.plan_id = one.plan_id) AS billing_period,
              coalesce((SELECT channel_cac FROM f_channel_cac k
                        WHERE k.acquisition_channel = who.acquisition_channel), 0) AS channel_cac
            FROM m_funnel{suffix} who LEFT JOIN m_first_sub one USING (user_id)""",
        f"m_funnel{suffix}",
        "m_first_sub",
        "f_plans",
        "f_channel_cac",
    )


def stayed(first: int, last: int) -> str:
    """Any session from day ``first`` to day ``last`` after sign-up."""
    since = "date_diff('day', f_users.signup_date, f_sessions.session_date)"
    return happened(f"f_sessions WHERE f_sessions.user_id = f_users.user_id AND {since} BETWEEN {first} AND {last}")


cte(
    "m_outcomes",
    f"""SELECT user_id, signup_date, signup_timestamp, acquisition_channel, country, primary_device,
         {happened("f_subscriptions p WHERE p.user_id = f_users.user_id AND p.converted_to_paid")} AS converted,
         coalesce((SELECT max(p.mrr) FROM f_subscriptions p WHERE p.user_id = f_users.user_id),
                  CAST(0 AS DECIMAL(8,2))) AS sub_mrr,
         {stayed(7, 13)} AS retained_d7, {stayed(30, 59)} AS retained_d30
       FROM f_users""",
    "f_users",
    "f_subscriptions",
    "f_sessions",
)


def months_of(start: str, end: str, capped: bool) -> str:
    """Month starts from the start's month to that of the end (or of as_of), under the cap."""
    last = f"coalesce(CAST({end} AS DATE), {AS_OF})"
    last = f"least({last}, {CAP_END})" if capped else last
    return f"CAST(unnest(generate_series(date_trunc('month', CAST({start} AS DATE)), CAST({last} AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)"


for suffix, capped in (("", False), ("_capped", True)):
    cte(
        f"m_sub_months{suffix}",
        f"""SELECT subscription_id, user_id, plan_id, plan_name, status, mrr, active_month, ended_at,
              CAST(status = 'churned' AND date_trunc('month', ended_at) = active_month AS INTEGER) AS churned_this_month
            FROM (SELECT *, {months_of("started_at", "ended_at", capped)} AS active_month
                  FROM f_subscriptions WHERE converted_to_paid)
            LEFT JOIN (SELECT plan_id, plan_name FROM f_plans) USING (plan_id)""",
        "f_subscriptions",
        "f_plans",
    )

for suffix, day in WEEKS.items():
    cte(
        f"m_first_session{suffix}",
        f"""SELECT user_id, first_session_date, {month("first_session_date")} AS cohort_month,
              {week("first_session_date", day)} AS cohort_week
            FROM (SELECT user_id, min(session_date) AS first_session_date FROM f_sessions GROUP BY user_id)""",
        "f_sessions",
    )

cte(
    "m_daily",
    """SELECT user_id, session_date, CAST(len(minutes) AS BIGINT) AS session_count,
         CAST(list_sum(minutes) AS BIGINT) AS total_minutes, CAST(len(devices) AS BIGINT) AS devices_used,
         nullif(array_to_string(list_sort(devices), ','), '') AS devices_list
       FROM (SELECT user_id, session_date, list(duration_minutes) AS minutes,
                    list_distinct(list(device)) AS devices
             FROM f_sessions GROUP BY user_id, session_date)""",
    "f_sessions",
)

# Days since the first session, and minutes of a day, by lower bound.
cte(
    "t_buckets",
    "SELECT * FROM (VALUES (0, 'D0'), (1, 'D1-6'), (7, 'D7-13'), (14, 'D14-29'), (30, 'D30-59'), (60, 'D60-89'), "
    "(90, 'D90+')) AS t(since, retention_bucket)",
)
cte("t_tiers", "SELECT * FROM (VALUES (-1, 'casual'), (30, 'regular'), (120, 'power_user')) AS t(minutes, engagement_tier)")
for suffix, day in WEEKS.items():
    cte(
        f"m_eng{suffix}",
        f"""SELECT y.*, t.retention_bucket, coalesce(k.engagement_tier, 'casual') AS engagement_tier
            FROM (SELECT d.user_id, d.session_date, {week("d.session_date", day)} AS session_week,
                    {month("d.session_date")} AS session_month, d.session_count, d.total_minutes, d.devices_used,
                    d.devices_list, who.acquisition_channel, who.country, who.primary_device,
                    f.first_session_date, f.cohort_month, f.cohort_week,
                    CAST(d.session_date - f.first_session_date AS INTEGER) AS days_since_first
                  FROM m_daily d SEMI JOIN f_users USING (user_id)
                  JOIN f_users who USING (user_id) JOIN m_first_session{suffix} f USING (user_id)) y
            ASOF JOIN t_buckets t ON y.days_since_first >= t.since
            ASOF LEFT JOIN t_tiers k ON y.total_minutes >= k.minutes""",
        "m_daily",
        "f_users",
        f"m_first_session{suffix}",
        "t_buckets",
        "t_tiers",
    )

cte(
    "m_paid_subs",
    f"""SELECT subscription_id, user_id, plan_id, started_at, ended_at, status, mrr, acquisition_channel, country,
         primary_device, plan_name, billing_period, {month("CAST(started_at AS DATE)")} AS sub_start_month,
         coalesce((SELECT channel_cac FROM f_channel_cac k
                   WHERE k.acquisition_channel = f_users.acquisition_channel), 0) AS channel_cac
       FROM f_subscriptions JOIN f_users USING (user_id) JOIN f_plans USING (plan_id)
       WHERE converted_to_paid""",
    "f_subscriptions",
    "f_users",
    "f_plans",
    "f_channel_cac",
)

for suffix, capped in (("", True), ("_uncapped", False)):
    # A row per paid subscription and month of its own series.
    cte(
        f"m_eco{suffix}",
        f"""SELECT subscription_id, user_id, plan_id, plan_name, billing_period, acquisition_channel, country,
              primary_device, started_at, ended_at, status, mrr, channel_cac, sub_start_month, active_month,
              CAST(date_diff('month', sub_start_month, active_month) AS INTEGER) AS tenure_months
            FROM (SELECT *, {months_of("started_at", "ended_at", capped)} AS active_month FROM m_paid_subs)""",
        "m_paid_subs",
    )

# All months between the first start and the last end (or as_of) under the cap.
cte(
    "m_spine",
    f"""SELECT {months_of("first_start", "last_end", True)} AS active_month
        FROM (SELECT min(started_at) AS first_start, max(coalesce(CAST(ended_at AS DATE), {AS_OF})) AS last_end
              FROM m_paid_subs)""",
    "m_paid_subs",
)

for suffix, day in WEEKS.items():
    cte(
        f"m_exp{suffix}",
        f"""SELECT experiment_id, experiment_name, variant, is_control, user_id, assigned_at,
              {week("assigned_at", day)} AS assigned_week, {month("CAST(assigned_at AS DATE)")} AS assigned_month,
              converted, retained_d7, retained_d30, sub_mrr,
              CAST(CASE converted WHEN 1 THEN sub_mrr WHEN 0 THEN 0 END AS DECIMAL(12,2)) AS revenue_per_assigned
            FROM f_assignments
            JOIN (SELECT experiment_id, variant, experiment_name, is_control FROM f_experiments) USING (experiment_id, variant)
            LEFT JOIN (SELECT user_id, converted, retained_d7, retained_d30, sub_mrr FROM m_outcomes) USING (user_id)""",
        "f_assignments",
        "f_experiments",
        "m_outcomes",
    )

cte(
    "m_exp_results",
    f"""SELECT experiment_id, variant, is_control,
         count(*) AS assigned_users,
         count(converted) AS measured_users,
         CAST(sum(converted) AS BIGINT) AS conversions,
         {ratio("sum(converted)", "count(converted)")} AS conversion_rate,
         {ratio("sum(retained_d7)", "count(converted)")} AS d7_rate,
         {ratio("sum(retained_d30)", "count(converted)")} AS d30_rate,
         {ratio("CAST(sum(revenue_per_assigned) AS DECIMAL(18,2))", "count(converted)")} AS revenue_per_assigned
       FROM m_exp GROUP BY experiment_id, variant, is_control""",
    "m_exp",
)
cte(
    "m_exp_pairs",
    """SELECT t.*, c.measured_users AS control_users, c.conversions AS control_conversions,
         c.conversion_rate AS control_conversion_rate, c.d30_rate AS control_d30_rate
       FROM m_exp_results t JOIN m_exp_results c ON t.experiment_id = c.experiment_id
       WHERE c.is_control AND NOT t.is_control""",
    "m_exp_results",
)
cte(
    "m_top_genre",
    """SELECT user_id, genre AS top_genre FROM (
         SELECT v.user_id, c.genre, count(*) AS views
         FROM f_content_views v JOIN f_content_catalog c ON v.content_id = c.content_id
         GROUP BY v.user_id, c.genre)
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY views DESC, genre) = 1""",
    "f_content_views",
    "f_content_catalog",
)


# ---------------------------------------------------------------- assembly


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _null_counts(table_cte: str, label: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {table_cte}"
        for c in cols
    )


def _unique_count(table_cte: str, label: str, col: str) -> str:
    return (
        f"SELECT '{label}' AS table_name, '{col}' AS column_name, 'unique' AS check_name, "
        f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {col} FROM {table_cte} "
        f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in col.split(','))} GROUP BY {col} HAVING count(*) > 1)"
    )


def _accepted_count(table_cte: str, label: str, col: str, values: list[str]) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return (
        f"SELECT '{label}' AS table_name, '{col}' AS column_name, 'accepted_values' AS check_name, "
        f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {col} FROM {table_cte} WHERE {col} IS NOT NULL "
        f"AND {col} NOT IN ({vals}) GROUP BY {col})"
    )


def _quality_report() -> str:
    parts = [
        _unique_count("f_users", "stg_users", "user_id"),
        _null_counts("f_users", "stg_users", ["user_id", "signup_date"]),
        _accepted_count(
            "f_users", "stg_users", "acquisition_channel",
            ["automobile", "building", "furniture", "household", "machinery"],
        ),
        _unique_count("f_experiments", "stg_experiments", "experiment_id,variant"),
        _unique_count("f_assignments", "stg_experiment_assignments", "experiment_id,user_id"),
        _unique_count("f_plans", "stg_plans", "plan_id"),
        _null_counts("f_plans", "stg_plans", ["plan_id"]),
        _unique_count("f_subscriptions", "stg_subscriptions", "subscription_id"),
        _null_counts("f_subscriptions", "stg_subscriptions", ["subscription_id", "user_id"]),
        "SELECT 'stg_subscriptions' AS table_name, 'user_id' AS column_name, 'relationship' AS check_name, "
        "CAST(count(*) AS BIGINT) AS violations FROM f_subscriptions s WHERE s.user_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM f_users u WHERE u.user_id = s.user_id)",
        _accepted_count(
            "f_subscriptions", "stg_subscriptions", "status", ["active", "churned", "trial_expired", "trialing"]
        ),
        _unique_count("f_sessions", "stg_sessions", "session_id"),
        _null_counts("f_sessions", "stg_sessions", ["session_id", "user_id"]),
        _unique_count("f_content_catalog", "stg_content_catalog", "content_id"),
        _null_counts("f_content_catalog", "stg_content_catalog", ["content_id"]),
        _unique_count("f_events", "stg_events", "event_id"),
        _null_counts("f_events", "stg_events", ["event_id"]),
        _unique_count("f_content_views", "stg_content_views", "view_id"),
        _null_counts("f_content_views", "stg_content_views", ["view_id"]),
        _null_counts("f_experiments", "stg_experiments", ["experiment_id", "is_control"]),
        _null_counts("f_assignments", "stg_experiment_assignments", ["user_id", "experiment_id"]),
        _unique_count("m_acq", "mart_acquisition", "user_id"),
        _null_counts("m_acq", "mart_acquisition", ["user_id", "acquisition_channel"]),
        _null_counts("m_eng", "mart_engagement", ["user_id", "cohort_month"]),
        _null_counts("m_eco", "mart_economics", ["subscription_id", "active_month"]),
        _null_counts("m_exp", "mart_experiments", ["user_id", "experiment_id", "is_control"]),
        _unique_count("f_channel_cac", "channel_cac", "acquisition_channel"),
        _null_counts("f_channel_cac", "channel_cac", ["acquisition_channel", "channel_cac"]),
    ]
    return with_ctes(
        "\nUNION ALL\n".join(parts),
        "f_users", "f_plans", "f_subscriptions", "f_sessions", "f_content_catalog", "f_events",
        "f_content_views", "f_experiments", "f_assignments", "m_acq", "m_eng", "m_eco", "m_exp", "f_channel_cac",
    )


# Declared keys and further NOT NULL columns of the source tables.
DECLARED = {
    "users": ("f_users", "user_id", "signup_date signup_timestamp acquisition_channel country primary_device"),
    "plans": ("f_plans", "plan_id", "plan_name price_monthly billing_period max_streams resolution"),
    "content_catalog": ("f_content_catalog", "content_id", ""),
    "subscriptions": ("f_subscriptions", "subscription_id", "user_id plan_id status started_at"),
    "sessions": ("f_sessions", "session_id", "user_id session_date session_start duration_minutes"),
    "events": ("f_events", "event_id", "user_id event_type event_timestamp"),
    "content_views": ("f_content_views", "view_id", "user_id session_id content_id view_date"),
    "experiments": ("f_experiments", "experiment_id,variant", ""),
    "experiment_assignments": ("f_assignments", "experiment_id,user_id", "variant assigned_at"),
    "channel_cac": ("f_channel_cac", "acquisition_channel", "channel_cac"),
}


def _load_constraints() -> str:
    parts = []
    for table, (source, key, more) in DECLARED.items():
        parts += [_unique_count(source, table, key), _null_counts(source, table, [*key.split(","), *more.split()])]
    return with_ctes("\nUNION ALL\n".join(parts), *[source for source, _, _ in DECLARED.values()])


def _load_audit() -> str:
    tables = [
        ("users", "f_users"), ("plans", "f_plans"), ("content_catalog", "f_content_catalog"),
        ("subscriptions", "f_subscriptions"), ("sessions", "f_sessions"), ("events", "f_events"),
        ("content_views", "f_content_views"), ("experiments", "f_experiments"),
        ("experiment_assignments", "f_assignments"),
    ]
    body = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}" for n, c in tables)
    return with_ctes(body, *[c for _, c in tables])


def _lifecycle() -> str:
    body = """
      , fs AS (SELECT user_id, started_at FROM f_subscriptions
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY started_at NULLS LAST, subscription_id) = 1)
      , fp AS (SELECT user_id, started_at, ended_at FROM f_subscriptions WHERE converted_to_paid
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY started_at NULLS LAST, subscription_id) = 1)
      SELECT user_id, 'signup_completed' AS event_type, signup_timestamp AS event_timestamp FROM f_users
      UNION ALL SELECT user_id, 'trial_started', started_at FROM fs WHERE user_id IN (SELECT user_id FROM f_users)
      UNION ALL SELECT user_id, 'subscribed', started_at FROM fp WHERE user_id IN (SELECT user_id FROM f_users)
      UNION ALL SELECT user_id, 'churned', ended_at FROM fp
                WHERE ended_at IS NOT NULL AND user_id IN (SELECT user_id FROM f_users)"""
    sql = with_ctes("", "f_users", "f_subscriptions")
    return sql.rstrip() + body


def queries() -> dict[str, str]:
    W = with_ctes
    q: dict[str, str] = {}
    # staging
    q["stg_users"] = W(
        "SELECT user_id, signup_timestamp, signup_date, acquisition_channel, country, primary_device, age, email "
        "FROM f_users", "f_users")
    q["stg_subscriptions"] = W(
        "SELECT subscription_id, user_id, plan_id, status, started_at, ended_at, is_trial, converted_to_paid, mrr "
        "FROM f_subscriptions", "f_subscriptions")
    q["stg_sessions"] = W(
        "SELECT session_id, user_id, session_date, session_start, duration_minutes, device FROM f_sessions",
        "f_sessions")
    q["stg_events"] = W("SELECT event_id, user_id, event_type, event_timestamp FROM f_events", "f_events")
    q["stg_content_catalog"] = W(
        "SELECT content_id, title, content_type, genre, release_year, duration_minutes, is_original "
        "FROM f_content_catalog", "f_content_catalog")
    q["stg_content_views"] = W(
        "SELECT view_id, user_id, session_id, content_id, view_date, watch_percentage, completed "
        "FROM f_content_views", "f_content_views")
    q["stg_experiment_assignments"] = W(
        "SELECT experiment_id, user_id, variant, assigned_at FROM f_assignments", "f_assignments")
    # intermediate
    q["user_funnel"] = W("SELECT * FROM m_funnel", "m_funnel")
    q["user_first_sub"] = W("SELECT * FROM m_first_sub", "m_first_sub")
    q["user_outcomes"] = W("SELECT * FROM m_outcomes", "m_outcomes")
    q["subscription_months"] = W("SELECT * FROM m_sub_months", "m_sub_months")
    q["user_first_session"] = W("SELECT * FROM m_first_session", "m_first_session")
    q["daily_activity"] = W("SELECT * FROM m_daily", "m_daily")
    # marts and prototype views
    q["mart_acquisition"] = W("SELECT * FROM m_acq", "m_acq")
    q["mart_engagement"] = W("SELECT * FROM m_eng", "m_eng")
    q["mart_economics"] = W("SELECT * FROM m_eco", "m_eco")
    q["month_spine"] = W("SELECT * FROM m_spine", "m_spine")
    q["mart_experiments"] = W("SELECT * FROM m_exp", "m_exp")
    q["vw_acquisition"] = W("SELECT * FROM m_acq_mon", "m_acq_mon")
    q["vw_engagement"] = W("SELECT * FROM m_eng_mon", "m_eng_mon")
    q["vw_economics"] = W("SELECT * FROM m_eco_uncapped", "m_eco_uncapped")
    q["vw_experiments"] = W("SELECT * FROM m_exp_mon", "m_exp_mon")
    # plain operator families
    q["load_audit"] = _load_audit()
    q["csv_users"] = q["stg_users"]
    q["csv_quoted_titles"] = W(
        """SELECT content_id, CASE content_id % 7
              WHEN 0 THEN 'The "' || title || '", again'
              WHEN 1 THEN title || ',' || chr(10) || '"part two"' || chr(10)
              WHEN 2 THEN '  ' || title || ' '
              WHEN 3 THEN title || chr(13) || chr(10) || '"'
              WHEN 4 THEN ''
              WHEN 5 THEN NULL ELSE title END AS title
            FROM f_content_catalog""", "f_content_catalog")
    # One faulty kind of row decides each of plan, start and amount.
    q["csv_subscriptions_inferred"] = W(
        """SELECT column_name, declared_type, inferred_type, n_values, CASE WHEN n_values = 0 THEN 0 ELSE n_deciding END AS n_deciding
            FROM (
              SELECT 'subscription_id' AS column_name, 'string' AS declared_type, 'int' AS inferred_type,
                     count(subscription_id) AS n_values, count(subscription_id) AS n_deciding FROM f_raw
              UNION ALL SELECT 'user_id', 'string', 'int', count(user_id), count(user_id) FROM f_raw
              UNION ALL SELECT 'plan_id', 'int', CASE WHEN count(*) FILTER (WHERE fault = 1) > 0 THEN 'string' ELSE 'int' END,
                     count(*), count(*) FILTER (WHERE fault = 1) FROM f_raw
              UNION ALL SELECT 'status', 'string', 'string', count(*), count(*) FROM f_raw
              UNION ALL SELECT 'started_at', 'timestamp_ntz', 'string', count(*), count(*) FILTER (WHERE fault = 6) FROM f_raw
              UNION ALL SELECT 'ended_at', 'timestamp_ntz', 'timestamp_ntz', count(ended_at), count(ended_at) FROM f_raw
              UNION ALL SELECT 'is_trial', 'boolean', 'boolean', count(*), 0 FROM f_raw
              UNION ALL SELECT 'converted_to_paid', 'boolean', 'boolean', count(*), 0 FROM f_raw
              UNION ALL SELECT 'mrr', 'decimal(8,2)', 'double', count(*), count(*) FILTER (WHERE fault = 6) FROM f_raw)""",
        "f_raw")
    q["load_rejects"] = W(
        """SELECT r.subscription_id, r.user_id, r.status, coalesce(w.reasons, 'key:subscription_id') AS reasons, count(*) AS n_rows
            FROM f_raw_ranked r
            LEFT JOIN (VALUES (1, 'type:plan_id'), (2, 'length:status'), (3, 'null:user_id'),
                              (6, 'type:started_at,type:mrr'), (7, 'type:mrr')) AS w(fault, reasons) ON w.fault = r.fault
            WHERE w.reasons IS NOT NULL OR r.place > 1
            GROUP BY ALL""", "f_raw_ranked")
    q["load_accepted"] = W(
        """SELECT subscription_id, user_id, CAST(plan_id AS INTEGER) AS plan_id, status,
              CAST(started_at AS TIMESTAMP) AS started_at, CAST(ended_at AS TIMESTAMP) AS ended_at,
              is_trial = 'True' AS is_trial, converted_to_paid = 'True' AS converted_to_paid,
              CAST(mrr AS DECIMAL(8,2)) AS mrr
            FROM f_raw_ranked WHERE fault NOT IN (1, 2, 3, 6, 7) AND place = 1""", "f_raw_ranked")
    q["seed_channel_costs"] = W(
        """SELECT c.acquisition_channel, count(*) AS users, c.channel_cac, count(*) * c.channel_cac AS cost
            FROM f_users u JOIN f_channel_cac c ON u.acquisition_channel = c.acquisition_channel
            GROUP BY c.acquisition_channel, c.channel_cac""", "f_users", "f_channel_cac")
    q["present_sources"] = W(
        """SELECT n.table_name, c.row_count IS NOT NULL AS present, c.row_count
            FROM (VALUES ('users'), ('plans'), ('content_catalog'), ('subscriptions'), ('sessions'), ('events'),
                         ('content_views'), ('experiments'), ('experiment_assignments')) AS n(table_name)
            LEFT JOIN (SELECT 'users' AS table_name, count(*) AS row_count FROM f_users
                       UNION ALL SELECT 'subscriptions', count(*) FROM f_subscriptions) c ON c.table_name = n.table_name""",
        "f_users", "f_subscriptions")
    q["staging_views"] = W(
        """SELECT u.acquisition_channel, e.event_type, count(*) AS events, count(DISTINCT e.user_id) AS users
            FROM f_events e JOIN f_users u ON e.user_id = u.user_id GROUP BY 1, 2""", "f_events", "f_users")
    q["written_economics"] = q["mart_economics"]
    q["load_constraints"] = _load_constraints()
    q["range_join_months"] = W("SELECT subscription_id, active_month, tenure_months FROM m_eco", "m_eco")
    q["orphan_keys"] = W(
        "SELECT s.subscription_id, s.user_id FROM f_subscriptions s WHERE s.user_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM f_users u WHERE u.user_id = s.user_id)", "f_subscriptions", "f_users")
    q["users_with_paid_sub"] = W(
        "SELECT u.user_id, u.signup_date, u.acquisition_channel FROM f_users u WHERE EXISTS "
        "(SELECT 1 FROM f_subscriptions s WHERE s.user_id = u.user_id AND s.converted_to_paid)",
        "f_users", "f_subscriptions")
    # checks
    q["check_unique"] = W(
        "SELECT subscription_id, count(*) AS n_rows FROM f_raw WHERE subscription_id IS NOT NULL "
        "GROUP BY subscription_id HAVING count(*) > 1", "f_raw")
    q["check_composite_key"] = W(
        "SELECT experiment_id, user_id, count(*) AS n_rows FROM f_assignments "
        "GROUP BY experiment_id, user_id HAVING count(*) > 1", "f_assignments")
    user_cols = ["user_id", "signup_timestamp", "signup_date", "acquisition_channel", "country",
                 "primary_device", "age", "email"]
    q["check_not_null"] = W(
        "SELECT column_name, violations FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM f_users"
            for c in user_cols)
        + ") WHERE violations > 0", "f_users")
    q["check_accepted_values"] = W(
        "SELECT device, count(*) AS n_rows FROM f_sessions WHERE device IS NOT NULL "
        "AND device NOT IN ('mobile', 'desktop', 'smart_tv', 'tablet') GROUP BY device", "f_sessions")
    q["check_relationship"] = W(
        "SELECT s.user_id FROM f_subscriptions s WHERE s.user_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM f_users u WHERE u.user_id = s.user_id)", "f_subscriptions", "f_users")
    q["quality_report"] = _quality_report()
    # metrics
    stages = [("signup", "reached_signup"), ("trial", "reached_trial"), ("paywall", "reached_paywall"),
              ("subscribe_click", "reached_subscribe_click"), ("paid", "reached_paid")]
    rows = []
    prev = "total"
    for i, (name, flag) in enumerate(stages, start=1):
        rows.append(f"SELECT {i} AS stage_order, '{name}' AS stage, {flag} AS users, "
                    f"{ratio(flag, prev)} AS step_rate, {ratio(flag, 'total')} AS overall_rate FROM a")
        prev = flag
    q["funnel_summary"] = W(
        ", a AS (SELECT count(*) AS total, "
        + ", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}" for _, f in stages)
        + " FROM m_acq)\n" + "\nUNION ALL\n".join(rows), "m_acq").replace("\n, a AS", ", a AS", 1)
    q["channel_performance"] = W(
        f"""SELECT acquisition_channel, signups, paid_users, {ratio("paid_users", "signups")} AS conversion_rate,
              channel_cac, CAST(signups * channel_cac AS BIGINT) AS spend,
              {ratio("signups * channel_cac", "paid_users")} AS cost_per_paid
            FROM (SELECT acquisition_channel, count(*) AS signups, CAST(sum(reached_paid) AS BIGINT) AS paid_users,
                         max(channel_cac) AS channel_cac FROM m_acq GROUP BY acquisition_channel)""", "m_acq")
    q["signups_over_time"] = W(
        " UNION ALL ".join(
            f"SELECT '{grain}' AS grain, signup_{grain} AS period_start, acquisition_channel, count(*) AS signups, "
            f"CAST(sum(reached_paid) AS BIGINT) AS paid_users FROM m_acq GROUP BY signup_{grain}, acquisition_channel"
            for grain in ("month", "week")), "m_acq")
    q["geo_distribution"] = W(
        f"""SELECT country, count(*) AS users, CAST(sum(reached_paid) AS BIGINT) AS paid_users,
              {ratio("count(*)", "(SELECT count(*) FROM m_acq)")} AS user_share,
              {ratio("sum(reached_paid)", "count(*)")} AS conversion_rate
            FROM m_acq GROUP BY country""", "m_acq")
    q["cohort_retention"] = W(
        f"""SELECT e.cohort_month, e.retention_bucket, count(DISTINCT e.user_id) AS active_users, f.cohort_size,
              {ratio("count(DISTINCT e.user_id)", "f.cohort_size")} AS retention_rate
            FROM m_eng e
            LEFT JOIN (SELECT cohort_month, count(DISTINCT user_id) AS cohort_size FROM m_eng GROUP BY cohort_month) f
              ON e.cohort_month = f.cohort_month
            GROUP BY e.cohort_month, e.retention_bucket, f.cohort_size""", "m_eng")
    q["active_users"] = W(
        """SELECT 'day' AS grain, session_date AS period_start, count(*) AS active_users FROM m_eng
             GROUP BY session_date
           UNION ALL SELECT 'week', session_week, count(DISTINCT user_id) FROM m_eng GROUP BY session_week
           UNION ALL SELECT 'month', session_month, count(DISTINCT user_id) FROM m_eng GROUP BY session_month""",
        "m_eng")
    q["stickiness"] = W(
        f"""SELECT d.session_month, m.mau, d.active_days, {ratio("d.dau_sum", "d.active_days")} AS avg_dau,
              {ratio("d.dau_sum", "d.active_days")} / CAST(m.mau AS DOUBLE) AS stickiness
            FROM (SELECT session_month, sum(dau) AS dau_sum, count(*) AS active_days
                  FROM (SELECT session_month, session_date, count(*) AS dau FROM m_eng
                        GROUP BY session_month, session_date) GROUP BY session_month) d
            JOIN (SELECT session_month, count(DISTINCT user_id) AS mau FROM m_eng GROUP BY session_month) m
              ON d.session_month = m.session_month""", "m_eng")
    q["engagement_tiers"] = W(
        f"""SELECT session_month, engagement_tier, user_days,
              {ratio("user_days", "sum(user_days) OVER (PARTITION BY session_month)")} AS share
            FROM (SELECT session_month, engagement_tier, count(*) AS user_days FROM m_eng
                  GROUP BY session_month, engagement_tier)""", "m_eng")
    q["device_mix"] = W(
        f"""SELECT {month("session_date")} AS session_month, device, count(*) AS sessions,
              CAST(sum(duration_minutes) AS BIGINT) AS total_minutes
            FROM f_sessions GROUP BY 1, 2""", "f_sessions")
    q["mrr_trend"] = W(
        f"""SELECT active_month, count(*) AS active_subs, CAST(sum(mrr) AS DECIMAL(18,2)) AS mrr,
              count(*) FILTER (WHERE tenure_months = 0) AS new_subs,
              count(*) FILTER (WHERE status = 'churned'
                               AND {month("CAST(ended_at AS DATE)")} = active_month) AS churned_subs
            FROM m_eco GROUP BY active_month""", "m_eco")
    q["ltv_cac"] = W(
        f"""SELECT acquisition_channel, paid_users, subscription_months, revenue,
              {ratio("revenue", "paid_users")} AS ltv, channel_cac,
              {ratio("revenue", "paid_users")} / CAST(NULLIF(channel_cac, 0) AS DOUBLE) AS ltv_cac
            FROM (SELECT acquisition_channel, count(DISTINCT user_id) AS paid_users, count(*) AS subscription_months,
                         CAST(sum(mrr) AS DECIMAL(18,2)) AS revenue, max(channel_cac) AS channel_cac
                  FROM m_eco GROUP BY acquisition_channel)""", "m_eco")
    q["churn_rate"] = W(
        f"""SELECT active_month, active_subs, churned_subs, {ratio("churned_subs", "active_subs")} AS churn_rate,
              {ratio("churned_subs", "active_subs")} > 0.05 AS above_benchmark
            FROM (SELECT active_month, count(*) AS active_subs, CAST(sum(churned_this_month) AS BIGINT) AS churned_subs
                  FROM m_sub_months_capped GROUP BY active_month)""", "m_sub_months_capped")
    q["plan_mix"] = W(
        f"""SELECT active_month, plan_name, subs, mrr,
              {ratio("subs", "sum(subs) OVER (PARTITION BY active_month)")} AS subs_share,
              {ratio("mrr", "sum(mrr) OVER (PARTITION BY active_month)")} AS mrr_share
            FROM (SELECT active_month, plan_name, count(*) AS subs, CAST(sum(mrr) AS DECIMAL(18,2)) AS mrr
                  FROM m_eco GROUP BY active_month, plan_name)""", "m_eco")
    q["revenue_retention"] = W(
        f"""SELECT sub_start_month, tenure_months, active_subs, mrr, base_mrr, {ratio("mrr", "base_mrr")} AS mrr_retention
            FROM (SELECT *, max(CASE WHEN tenure_months = 0 THEN mrr END)
                              OVER (PARTITION BY sub_start_month) AS base_mrr
                  FROM (SELECT sub_start_month, tenure_months, count(*) AS active_subs,
                               CAST(sum(mrr) AS DECIMAL(18,2)) AS mrr
                        FROM m_eco GROUP BY sub_start_month, tenure_months))""", "m_eco")
    q["experiment_results"] = W("SELECT * FROM m_exp_results", "m_exp_results")
    q["experiment_lift"] = W(
        """SELECT experiment_id, variant, conversion_rate, control_conversion_rate,
              conversion_rate / NULLIF(control_conversion_rate, 0) - 1 AS conversion_lift,
              d30_rate, control_d30_rate, d30_rate / NULLIF(control_d30_rate, 0) - 1 AS d30_lift
            FROM m_exp_pairs""", "m_exp_pairs")
    pooled = ("(CAST(control_conversions AS DOUBLE) + CAST(conversions AS DOUBLE)) / "
              "NULLIF(CAST(control_users AS DOUBLE) + CAST(measured_users AS DOUBLE), 0)")
    se = (f"sqrt({pooled} * (1.0 - {pooled}) * (1.0 / NULLIF(CAST(control_users AS DOUBLE), 0) "
          f"+ 1.0 / NULLIF(CAST(measured_users AS DOUBLE), 0)))")
    z = f"((conversion_rate - control_conversion_rate) / NULLIF({se}, 0))"
    q["experiment_significance"] = W(
        f"""SELECT experiment_id, variant, control_users AS n_control, measured_users AS n_variant,
              control_conversion_rate AS p_control, conversion_rate AS p_variant, {pooled} AS pooled_rate,
              {z} AS z_score, abs({z}) >= 1.96 AS significant
            FROM m_exp_pairs""", "m_exp_pairs")
    # The tail by Simpson's rule over 12 units from |z| on.
    q["experiment_p_values"] = W(
        f"""SELECT experiment_id, variant, round(z, 9) AS z_score, round(p, 9) AS p_value, round(holm, 9) AS p_holm, holm < 0.05 AS significant
            FROM (
              SELECT *, CASE WHEN p IS NOT NULL THEN least(1.0, max(step) OVER (PARTITION BY experiment_id ORDER BY place)) END AS holm
              FROM (
                SELECT *, (count(p) OVER (PARTITION BY experiment_id) - place + 1) * p AS step
                FROM (
                  SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY p NULLS LAST, variant) AS place
                  FROM (
                    SELECT experiment_id, variant, {z} AS z,
                      (SELECT sum(weight * exp(-power(abs({z}) + i * 0.0005, 2) / 2)) FROM
                         (SELECT i, CASE WHEN i IN (0, 24000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight FROM range(24001) r(i)))
                        * 0.0005 / 3 * 2 / sqrt(2 * pi()) AS p
                    FROM m_exp_pairs))))""", "m_exp_pairs")
    q["kpi_tiles"] = W(
        f"""SELECT (SELECT count(*) FROM m_acq) AS total_users,
              (SELECT CAST(sum(reached_paid) AS BIGINT) FROM m_acq) AS paid_users,
              {ratio("(SELECT sum(reached_paid) FROM m_acq)", "(SELECT count(*) FROM m_acq)")} AS conversion_rate,
              (SELECT max(active_month) FROM m_eco) AS last_active_month,
              (SELECT CAST(sum(mrr) AS DECIMAL(18,2)) FROM m_eco
                 WHERE active_month = (SELECT max(active_month) FROM m_eco)) AS mrr_last_month,
              (SELECT count(*) FROM m_eco
                 WHERE active_month = (SELECT max(active_month) FROM m_eco)) AS active_subs_last_month,
              (SELECT max(session_month) FROM m_eng) AS last_session_month,
              (SELECT count(DISTINCT user_id) FROM m_eng
                 WHERE session_month = (SELECT max(session_month) FROM m_eng)) AS mau_last_month""",
        "m_acq", "m_eco", "m_eng")
    # table rules
    q["experiment_eligibility"] = W("SELECT * FROM f_eligible", "f_eligible")
    q["assign_variants"] = W("SELECT DISTINCT experiment_id, user_id, variant, assigned_at FROM f_assignments",
                             "f_assignments")
    q["normalized_mrr"] = W(
        """SELECT s.subscription_id, s.plan_id, p.billing_period, p.price_monthly, s.converted_to_paid,
              CASE WHEN s.converted_to_paid THEN
                     CASE WHEN p.billing_period = 'annual' THEN CAST(round(p.price_monthly / 12, 2) AS DECIMAL(8,2))
                          ELSE p.price_monthly END
                   ELSE CAST(0 AS DECIMAL(8,2)) END AS normalized_mrr, s.mrr = normalized_mrr AS mrr_matches
            FROM f_subscriptions s LEFT JOIN f_plans p ON s.plan_id = p.plan_id""", "f_subscriptions", "f_plans")
    q["subscription_status"] = W(
        """SELECT subscription_id, status, derived_status, status = derived_status AS status_matches
            FROM (SELECT subscription_id, status,
                    CASE WHEN NOT coalesce(converted_to_paid, false) THEN 'trial_expired'
                         WHEN ended_at IS NOT NULL THEN 'churned' ELSE 'active' END AS derived_status
                  FROM f_subscriptions)""", "f_subscriptions")
    q["trial_period"] = W(
        f"""SELECT subscription_id, user_id, started_at, trial_days,
              started_at + to_days(trial_days) AS trial_end
            FROM (SELECT s.subscription_id, s.user_id, s.started_at,
                    CASE WHEN a.is_control IS NULL THEN
                           CASE WHEN {bucket("'trial:' || CAST(s.user_id AS VARCHAR)")} < 50 THEN 14 ELSE 7 END
                         WHEN a.is_control THEN 7 ELSE 14 END AS trial_days
                  FROM f_subscriptions s
                  LEFT JOIN (SELECT DISTINCT x.user_id, e.is_control FROM f_assignments x
                             JOIN f_experiments e ON x.experiment_id = e.experiment_id AND x.variant = e.variant
                             WHERE x.experiment_id = 'trial_weeks') a ON s.user_id = a.user_id)""",
        "f_subscriptions", "f_assignments", "f_experiments")
    q["lifecycle_events"] = _lifecycle()
    q["experiment_effects"] = W(
        """SELECT u.user_id,
              CAST(coalesce(e.signup_lift, 0) AS DECIMAL(16,3)) AS signup_lift,
              CAST(coalesce(e.d30_retention_lift, 0) AS DECIMAL(16,3)) AS d30_retention_lift
            FROM f_users u LEFT JOIN (
              SELECT a.user_id, sum(f.signup_lift) AS signup_lift, sum(f.d30_retention_lift) AS d30_retention_lift
              FROM f_assignments a JOIN f_effects f ON a.experiment_id = f.experiment_id AND a.variant = f.variant
              GROUP BY a.user_id) e ON u.user_id = e.user_id""", "f_users", "f_assignments", "f_effects")
    q["content_completion"] = W(
        f"""SELECT c.genre, c.content_type, count(*) AS views,
              count(*) FILTER (WHERE v.completed) AS completed_views,
              {ratio("count(*) FILTER (WHERE v.completed)", "count(*)")} AS completion_rate,
              {ratio("CAST(sum(v.watch_percentage) AS DECIMAL(18,2))", "count(v.watch_percentage)")}
                AS avg_watch_percentage
            FROM f_content_views v JOIN f_content_catalog c ON v.content_id = c.content_id
            GROUP BY c.genre, c.content_type""", "f_content_views", "f_content_catalog")
    q["retention_by_segment"] = W(
        f"""SELECT 'primary_device' AS segment_type, primary_device AS segment, count(*) AS users,
              {ratio("sum(retained_d7)", "count(*)")} AS d7_rate, {ratio("sum(retained_d30)", "count(*)")} AS d30_rate
            FROM m_outcomes GROUP BY primary_device
            UNION ALL
            SELECT 'top_genre', g.top_genre, count(*),
              {ratio("sum(o.retained_d7)", "count(*)")}, {ratio("sum(o.retained_d30)", "count(*)")}
            FROM m_outcomes o JOIN m_top_genre g ON o.user_id = g.user_id GROUP BY g.top_genre""",
        "m_outcomes", "m_top_genre")
    return q
