"""Join and merge queries Q055-Q066."""

from __future__ import annotations

from tidemark.operators import joins as J
from tidemark.plans.p01_windows import GMV
from tidemark.plans.registry import ORDERS_AS_OF, query


@query(
    "q055_star_join",
    """SELECT txn_id, txn_no, customer_segment, product_category, region_name, t.bu_code, amount_usd::DOUBLE AS amount_usd
       FROM transactions t, dim_customer c, dim_product p, dim_region r, dim_business_unit b
       WHERE t.customer_key = c.customer_key AND t.product_key = p.product_key AND t.region_key = r.region_key AND t.bu_code = b.bu_code
         AND c.is_current AND p.is_current AND t.status = 'POSTED'""",
)
def _(t):
    return J.star_join(t.transactions, t.dim_customer, t.dim_product, t.dim_region, t.dim_business_unit)


@query(
    "q056_dq_coverage_gap",
    """SELECT table_id, column_name, sensitivity FROM column_catalog c WHERE sensitivity IN ('PII', 'PCI', 'PHI', 'RESTRICTED')
       AND NOT EXISTS (FROM dq_rules r WHERE r.is_active AND r.table_id = c.table_id AND r.column_name = c.column_name)""",
)
def _(t):
    return J.dq_coverage_gap(t.column_catalog, t.dq_rules)


@query(
    "q057_asof_scd2_join",
    """SELECT txn_id, txn_no, txn_date, product_category, list_price::DOUBLE AS price_then, margin_pct::DOUBLE AS margin_then, amount_usd::DOUBLE AS amount_usd
       FROM txn_core t JOIN dim_product p ON p.product_key = t.product_key AND t.txn_timestamp >= p.valid_from AND t.txn_timestamp < coalesce(p.valid_to, TIMESTAMP '9999-01-01 00:00:00')
       WHERE t.status = 'POSTED'""",
)
def _(t):
    take = {"product_category": "product_category", "list_price": "price_then", "margin_pct": "margin_then"}
    joined = J.asof_scd2_join(t.txn_core.where("status = 'POSTED'"), t.dim_product, "product_key", "txn_timestamp", take)
    return joined.select("txn_id", "txn_no", "txn_date", *take.values(), "amount_usd")


@query(
    "q058_upsert_glossary",
    """WITH s AS (FROM glossary WHERE status = 'CERTIFIED')
       SELECT e.term_name, CASE WHEN e.version < s.version THEN s.definition ELSE e.definition END AS definition, e.owner_team,
         CASE WHEN e.version < s.version THEN s.version ELSE e.version END AS version FROM glossary_export e LEFT JOIN s USING (term_name)
       UNION ALL SELECT term_name, definition, owner_team, version FROM s WHERE term_name NOT IN (SELECT term_name FROM glossary_export)""",
)
def _(t):
    return J.upsert_glossary(t.glossary_export, t.glossary)


@query(
    "q059_employee_manager",
    """WITH bosses AS (SELECT employee_key AS manager_employee_key, full_name AS manager, department AS manager_department FROM employees)
       SELECT full_name AS employee, department, manager, manager_department FROM employees LEFT JOIN bosses USING (manager_employee_key) WHERE employment_status = 'ACTIVE'""",
)
def _(t):
    return J.employee_manager(t.employees)


@query(
    "q060_rapid_repeat",
    """WITH p AS (SELECT a.customer_key, a.event_type, a.event_id AS first_id, a.event_timestamp AS t1, b.event_id, b.event_timestamp AS t2
         FROM ops_events a JOIN ops_events b ON b.customer_key = a.customer_key AND b.event_type = a.event_type
           AND b.event_timestamp > a.event_timestamp AND b.event_timestamp <= a.event_timestamp + INTERVAL 5 MINUTE),
       n AS (SELECT customer_key, event_type, event_id, count(*) AS repeats, max({'t': t1, 'i': first_id}) AS x, any_value(t2) AS t2 FROM p GROUP BY ALL)
       SELECT customer_key, event_type, x.i AS nearest_id, event_id, repeats, date_sub('minute', x.t, t2) AS gap_minutes FROM n""",
)
def _(t):
    return J.rapid_repeat(t.ops_events, ["customer_key", "event_type"], "event_timestamp", "event_id", 5)


@query("q061_unowned_tables", "SELECT table_id FROM table_catalog WHERE criticality = 'T1' AND table_id NOT IN (SELECT target_table FROM pipeline_runs)")
def _(t):
    return J.unowned_tables(t.table_catalog, t.pipeline_runs)


@query(
    "q062_reconcile",
    """WITH both_sides AS (SELECT txn_date, amount_usd AS e, NULL::DECIMAL(18,2) AS o FROM erp UNION ALL SELECT txn_date, NULL, amount_usd FROM oms),
       d AS (SELECT txn_date, sum(e) AS e, sum(o) AS o FROM both_sides GROUP BY txn_date)
       SELECT txn_date, e::DOUBLE AS erp_amount, o::DOUBLE AS oms_amount, (coalesce(e, 0) - coalesce(o, 0))::DOUBLE AS variance,
         abs(coalesce(e, 0) - coalesce(o, 0)) > 0.01 AS mismatched FROM d""",
)
def _(t):
    return J.reconcile(t.erp, t.oms)


@query(
    "q063_active_by_tier",
    """SELECT tier, count(*) AS customers, count(*) * 1000 AS notional_quota FROM dim_customer
       WHERE customer_key IN (SELECT customer_key FROM txn_core WHERE status = 'POSTED' AND txn_date >= DATE '2001-07-01') GROUP BY tier""",
)
def _(t):
    return J.active_by_tier(t.dim_customer, t.txn_core, "2001-07-31")


@query(
    "q064_gap_fill",
    f"""WITH d AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '{ORDERS_AS_OF}', INTERVAL 1 DAY))::DATE AS txn_date),
        g AS (SELECT txn_date, bu_code, sum(amount_usd) AS s FROM transactions WHERE {GMV} GROUP BY ALL)
        SELECT txn_date, bu_code, coalesce(s, 0)::DOUBLE AS gmv_usd FROM d CROSS JOIN dim_business_unit LEFT JOIN g USING (txn_date, bu_code)""",
)
def _(t):
    return J.gap_fill(t.dim_business_unit, t.transactions, "1995-01-01", ORDERS_AS_OF)


@query(
    "q065_current_version_guard",
    "SELECT product_id, sum(is_current::INT)::BIGINT AS current_versions, count(*) AS total_versions FROM dim_product GROUP BY product_id HAVING sum(is_current::INT) <> 1",
)
def _(t):
    return J.current_version_guard(t.dim_product)


@query("q066_split_explode", "SELECT table_id, unnest(string_split(clustering_columns, ',')) AS tag FROM table_catalog WHERE clustering_columns IS NOT NULL")
def _(t):
    return J.split_explode(t.table_catalog, "table_id", "clustering_columns")
