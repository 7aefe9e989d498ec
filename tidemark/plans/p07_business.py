"""Business KPI queries Q078-Q088."""

from __future__ import annotations

from tidemark.operators import business as B
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import EVENTS_AS_OF, avg, div, pct, query, r

MARGIN = "sum(amount_usd * margin_pct)"
GROSS = "sum(amount_usd) FILTER (txn_type = 'PAYMENT')"
CB = "coalesce(sum(amount_usd) FILTER (txn_type = 'CHARGEBACK'), 0)"


@query(
    "q078_pnl_bridge",
    f"""WITH x AS (SELECT t.*, margin_pct FROM transactions t JOIN dim_product p ON p.product_key = t.product_key AND p.is_current WHERE t.status = 'POSTED')
        SELECT bu_code, sum(CASE WHEN txn_type = 'REFUND' THEN -abs(amount_usd) ELSE amount_usd END)::DOUBLE AS net_revenue_usd, ({GROSS})::DOUBLE AS gross_revenue_usd,
          ({CB})::DOUBLE AS chargebacks_usd, {r(MARGIN, 2)} AS gross_margin_usd, {div(f'{GROSS} - {CB} - {MARGIN}', GROSS)} AS net_margin_rate FROM x GROUP BY bu_code""",
)
def _(t):
    return B.pnl_bridge(t.transactions, t.dim_product)


@query(
    "q079_mtd_vs_last",
    f"""WITH x AS (SELECT bu_code, sum(amount_usd) FILTER (txn_date >= DATE '2001-07-01') AS m, coalesce(sum(amount_usd) FILTER (txn_date < DATE '2001-07-01'), 0) AS l
          FROM transactions WHERE status = 'POSTED' AND NOT is_reversal AND txn_date BETWEEN DATE '2001-06-01' AND DATE '2001-07-20' GROUP BY bu_code)
        SELECT bu_code, m::DOUBLE AS mtd_gmv, l::DOUBLE AS last_month_gmv, {div('m - l', 'l')} AS mom_change FROM x WHERE m IS NOT NULL""",
)
def _(t):
    return B.mtd_vs_last(t.transactions, "2001-07-20")


@query(
    "q080_fcr_csat_weekly",
    f"""SELECT date_trunc('week', opened_date)::DATE AS week_start, case_type, count(*) AS cases, {pct("count(*) FILTER (reopen_count = 0 AND status = 'CLOSED')", 'count(*)')} AS fcr_pct,
        {avg('satisfaction_score', 2)} AS avg_csat, {pct('count(*) FILTER (is_escalated)', 'count(*)')} AS escalation_pct FROM support_cases GROUP BY ALL""",
)
def _(t):
    return B.fcr_csat_weekly(t.support_cases)


@query(
    "q081_sla_by_priority",
    f"""WITH x AS (SELECT priority, count(*) AS total_cases, count(*) FILTER (resolved_at <= sla_due_at AND status = 'CLOSED') AS met_sla FROM support_cases GROUP BY priority)
        SELECT *, {pct('met_sla', 'total_cases')} AS sla_pct, CASE priority WHEN 'P1' THEN 98 WHEN 'P2' THEN 95 WHEN 'P3' THEN 90 ELSE 85 END AS sla_target_pct FROM x""",
)
def _(t):
    return B.sla_by_priority(t.support_cases)


@query(
    "q082_service_slo",
    f"""SELECT service_name, count(*) AS requests, count(*) FILTER (status = 'FAILURE') AS failures, {pct("count(*) FILTER (status = 'FAILURE')", 'count(*)', 4)} AS error_rate_pct,
        {r('quantile_cont(latency_ms::DOUBLE, 0.95)', 0)} AS p95_latency_ms FROM ops_events GROUP BY service_name ORDER BY failures DESC, service_name LIMIT 20""",
)
def _(t):
    return B.service_slo(t.ops_events)


@query(
    "q083_slo_trend",
    f"""WITH w AS (SELECT date_trunc('week', event_date)::DATE AS week_start, service_name, {pct("count(*) FILTER (status = 'FAILURE')", 'count(*)')} AS error_rate_pct FROM ops_events GROUP BY ALL)
        SELECT *, lag(error_rate_pct) OVER (PARTITION BY service_name ORDER BY week_start) AS prior_week_rate FROM w QUALIFY error_rate_pct > 1 AND prior_week_rate IS NOT NULL""",
)
def _(t):
    return B.slo_trend(t.ops_events)


@query(
    "q084_top_queries",
    f"""WITH x AS (SELECT user_email, query_id, sum(cost_usd) AS c, sum(bytes_processed) AS b, count(*) AS executions FROM query_cost GROUP BY ALL ORDER BY c DESC, user_email, query_id LIMIT 10)
        SELECT user_email, query_id, {r('c', 2)} AS cost_usd, {r('b / 1e12', 3)} AS tb_processed, executions FROM x""",
)
def _(t):
    return B.top_queries(t.query_cost)


@query(
    "q085_cost_by_layer",
    f"""WITH x AS (SELECT CASE split_part(table_reference, '_', 1) WHEN 'raw' THEN '1_raw' WHEN 'staging' THEN '2_staging' WHEN 'core' THEN '3_core' WHEN 'analytics' THEN '4_analytics' ELSE '5_other' END AS layer,
          sum(cost_usd) AS c FROM query_cost GROUP BY 1)
        SELECT layer, {r('c', 2)} AS cost_usd, {pct('c', '(SELECT sum(c) FROM x)')} AS cost_share_pct FROM x""",
)
def _(t):
    return B.cost_by_layer(t.query_cost)


@query(
    "q086_weekly_active",
    f"""WITH x AS (SELECT date_trunc('week', activity_date)::DATE AS week_start, count(DISTINCT employee_key) AS weekly_active_users, count(*) FILTER (activity_type = 'DASHBOARD_VIEW') AS dashboard_views FROM activity GROUP BY ALL)
        SELECT *, {div('dashboard_views', 'weekly_active_users', 2)} AS views_per_user FROM x""",
)
def _(t):
    return B.weekly_active(t.activity)


@query(
    "q087_stale_dashboards",
    f"""SELECT resource_name, count(DISTINCT employee_key) AS viewers, count(*) FILTER (activity_type = 'DASHBOARD_VIEW') AS views, max(activity_date) AS last_viewed,
        if(max(activity_date) < DATE '{EVENTS_AS_OF}' - 3, 'STALE', 'ACTIVE') AS usage FROM activity WHERE app_name = 'Tableau' GROUP BY resource_name""",
)
def _(t):
    return B.stale_dashboards(t.activity, EVENTS_AS_OF, days=3)


@query(
    "q088_data_case_share",
    f"""SELECT if(case_note ILIKE '%data%' OR case_note ILIKE '%report%', 'DATA_RELATED', 'OPERATIONAL') AS root_cause_bucket, count(*) AS cases,
        {avg(f"date_sub('hour', opened_at, coalesce(resolved_at, TIMESTAMP '{NOW}'))", 1)} AS avg_handle_hours FROM support_cases GROUP BY 1""",
)
def _(t):
    return B.data_case_share(t.support_cases, NOW)
