"""Subquery, recursion and set queries Q019-Q030."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import hierarchy as H
from tidemark.operators import segments as S
from tidemark.plans.p01_windows import GMV
from tidemark.plans.registry import ORDERS_AS_OF, avg, div, query

NOW = f"{ORDERS_AS_OF} 00:00:00"
LTV = f"ltv AS (SELECT customer_key, sum(amount_usd) AS v, count(*) AS n, max(txn_date) AS last_day FROM txn_core WHERE {GMV} GROUP BY customer_key)"


@query(
    "q019_rfm_segments",
    f"""WITH {LTV}, s AS (SELECT v, date_diff('day', last_day, DATE '{ORDERS_AS_OF}') AS d,
          CASE WHEN v > 50000 THEN 'A' WHEN v > 10000 THEN 'B' WHEN v > 1000 THEN 'C' ELSE 'D' END AS value_segment FROM ltv)
        SELECT value_segment, count(*) AS customers, {avg('v', 2)} AS avg_ltv, {avg('d', 1)} AS avg_recency_days FROM s GROUP BY value_segment""",
)
def _(t):
    return S.rfm_segments(t.txn_core, ORDERS_AS_OF)


@query(
    "q020_sla_status",
    f"""WITH ok AS (SELECT target_table, max(run_finished_at) AS f FROM pipeline_runs WHERE status = 'SUCCESS' GROUP BY target_table),
        x AS (SELECT c.*, date_sub('hour', ok.f, TIMESTAMP '{NOW}') AS h FROM table_catalog c LEFT JOIN ok ON ok.target_table = c.table_id WHERE c.is_certified)
        SELECT table_name, data_owner, criticality, sla_hours, h AS hours_since_load, if(h > sla_hours, 'BREACHED', 'OK') AS sla_status FROM x""",
)
def _(t):
    return S.sla_status(t.table_catalog, t.pipeline_runs, NOW)


@query(
    "q021_share_vs_enterprise",
    f"""WITH unit AS (SELECT txn_date, bu_code, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL),
        day AS (SELECT txn_date, sum(amount_usd) AS e FROM transactions WHERE {GMV} GROUP BY ALL)
        SELECT txn_date, bu_code, g::DOUBLE AS bu_gmv, e::DOUBLE AS enterprise_gmv, {div('g', 'e')} AS share_pct FROM unit JOIN day USING (txn_date)""",
)
def _(t):
    return S.share_vs_enterprise(t.transactions)


@query(
    "q022_customers_with_p1",
    f"""SELECT customer_id, full_name, tier FROM dim_customer c WHERE is_active AND customer_key IN (
          SELECT customer_key FROM support_cases WHERE priority = 'P1' AND opened_at >= TIMESTAMP '{NOW}' - INTERVAL 90 DAY)""",
)
def _(t):
    found = S.customers_with_case(t.dim_customer, t.support_cases, "P1", NOW, 90)
    return found.select("customer_id", "full_name", "tier")


@query(
    "q023_unsold_products",
    f"""SELECT product_id, product_name, product_category FROM dim_product p WHERE is_current AND status = 'ACTIVE' AND product_key NOT IN (
          SELECT product_key FROM txn_core WHERE txn_date >= date_trunc('month', DATE '{ORDERS_AS_OF}'))""",
)
def _(t):
    return S.unsold_products(t.dim_product, t.txn_core, ORDERS_AS_OF).select("product_id", "product_name", "product_category")


@query(
    "q024_manager_chain",
    """WITH up AS (
         SELECT employee_key AS start_key, 0 AS depth, full_name, full_name AS chain, manager_employee_key AS nxt FROM employees WHERE employee_key = (SELECT max(employee_key) FROM employees)
         UNION ALL
         SELECT u.start_key, u.depth + 1, e.full_name, concat(u.chain, ' > ', e.full_name), e.manager_employee_key FROM up u JOIN employees e ON e.employee_key = u.nxt)
       SELECT start_key, depth, full_name, chain FROM up""",
)
def _(t):
    newest = t.employees.agg(F.max("employee_key").alias("employee_key"))
    return H.manager_chain(t.employees, newest)


@query(
    "q025_indirect_reports",
    """WITH tree AS (
         SELECT employee_key AS node, manager_employee_key AS top FROM employees WHERE employment_status = 'ACTIVE'
         UNION ALL
         SELECT e.employee_key, tree.top FROM tree JOIN employees e ON e.manager_employee_key = tree.node)
       SELECT top AS manager_key, count(*) AS total_reports FROM tree WHERE top IS NOT NULL GROUP BY top ORDER BY total_reports DESC, manager_key LIMIT 25""",
)
def _(t):
    return H.report_counts(t.employees, top=25)


@query(
    "q026_bom_explosion",
    """WITH need AS (
         SELECT component_product_key AS part, quantity_per_unit::BIGINT AS q FROM bom WHERE parent_product_key = 0
         UNION ALL
         SELECT b.component_product_key, need.q * b.quantity_per_unit FROM need JOIN bom b ON b.parent_product_key = need.part)
       SELECT part AS component_product_key, sum(q)::DOUBLE AS total_qty FROM need GROUP BY part""",
)
def _(t):
    return H.bom_explosion(t.bom, 0)


@query(
    "q027_ltv_buckets",
    f"""WITH {LTV} SELECT CASE WHEN v >= 100000 THEN '1. VVVIP' WHEN v >= 25000 THEN '2. VIP' WHEN v >= 5000 THEN '3. Core' ELSE '4. Low' END AS customer_bucket,
        count(*) AS customers, sum(v)::DOUBLE AS total_value FROM ltv GROUP BY 1""",
)
def _(t):
    return S.ltv_buckets(t.txn_core)


@query(
    "q028_gmv_per_customer",
    f"""WITH a AS (SELECT bu_code, count(DISTINCT customer_key) AS n, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY bu_code)
        SELECT bu_name, n AS active_customers, g::DOUBLE AS gmv_usd, {div('g', 'n', 2)} AS gmv_per_customer FROM a JOIN dim_business_unit USING (bu_code)""",
)
def _(t):
    return S.gmv_per_customer(t.transactions, t.dim_business_unit)


@query(
    "q029_all_recent_escalated",
    f"""SELECT customer_id, full_name FROM dim_customer c WHERE is_active AND EXISTS (FROM support_cases s WHERE s.customer_key = c.customer_key)
        AND NOT EXISTS (FROM support_cases s WHERE s.customer_key = c.customer_key AND NOT s.is_escalated AND s.opened_at >= TIMESTAMP '{NOW}' - INTERVAL 180 DAY)""",
)
def _(t):
    return S.all_recent_escalated(t.dim_customer, t.support_cases, NOW).select("customer_id", "full_name")


@query(
    "q030_unified_ledger",
    """SELECT txn_id, txn_date, amount_usd::DOUBLE AS amount_usd, 'ERP' AS source_system FROM erp
       UNION ALL SELECT txn_id, txn_date, amount_usd::DOUBLE, 'OMS' FROM oms""",
)
def _(t):
    return S.unified_ledger(erp=t.erp, oms=t.oms).drop("txn_no")
