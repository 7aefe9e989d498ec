"""Incident playbook queries S01-S22."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import hierarchy as H
from tidemark.operators import incidents as S
from tidemark.operators.business import stale_dashboards
from tidemark.operators.health import freshness_report, schema_drift
from tidemark.operators.segments import last_success
from tidemark.operators.windows import gmv_by
from tidemark.plans.p01_windows import GMV
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, avg, div, pct, query, r

DIGITAL = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
IN_DIGITAL = "channel_code IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
ADJ = "txn_type IN ('REFUND', 'CHARGEBACK')"
CLOSED_IN_TIME = "count(*) FILTER (status = 'CLOSED' AND resolved_at <= sla_due_at)"
LATE = "date_diff('day', txn_date, etl_loaded_at::DATE)"


def summed(cond: str) -> str:
    return f"coalesce(sum(amount_usd) FILTER ({cond}), 0)::DOUBLE"


ENTRIES = {
    "s01a_definition_gap": (
        lambda t: S.definition_gap(t.transactions, DIGITAL),
        f"SELECT bu_code, sum(amount_usd)::DOUBLE AS finance_gmv, {summed(f'NOT is_reversal AND {IN_DIGITAL}')} AS retail_gmv FROM transactions WHERE status = 'POSTED' GROUP BY bu_code",
    ),
    "s01b_adjustment_bridge": (
        lambda t: S.adjustment_bridge(t.transactions, DIGITAL),
        f"""SELECT bu_code, count(*) FILTER ({ADJ}) AS adjustments, {summed(ADJ)} AS adjusted_amount, count(*) FILTER (NOT {IN_DIGITAL}) AS other_channel_txns, {summed(f'NOT {IN_DIGITAL}')} AS other_channel_amount
            FROM transactions WHERE status = 'POSTED' GROUP BY bu_code""",
    ),
    "s02a_drop_by_dimension": (
        lambda t: S.drop_by_dimension(t.transactions, t.dim_region),
        f"""WITH c AS (SELECT bu_code, region_key, channel_code, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL)
            SELECT bu_code, region_name, channel_code, g::DOUBLE AS gmv, {pct('g', '(SELECT sum(g) FROM c)')} AS share_pct FROM c JOIN dim_region USING (region_key) ORDER BY g DESC, bu_code, region_name, channel_code LIMIT 10""",
    ),
    "s02b_volume_or_value": (
        lambda t: S.volume_or_value(t.txn_core),
        f"SELECT txn_date, count(*) AS txn_count, count(DISTINCT customer_key) AS customers, {avg('amount_usd', 2)} AS avg_txn FROM txn_core GROUP BY txn_date",
    ),
    "s03a_run_log": (
        lambda t: S.run_log(t.pipeline_runs, names=["load_urgent"]).select("run_id", "pipeline_name", "run_started_at", "status", "error_message"),
        "SELECT run_id, pipeline_name, run_started_at, status, error_message FROM pipeline_runs WHERE pipeline_name = 'load_urgent'",
    ),
    "s03b_key_health": (
        lambda t: S.key_health(t.txn_gaps, "customer_ref", ["etl_batch_id"]),
        "SELECT etl_batch_id, count(*) AS staged_rows, count(*) - count(customer_ref) AS null_keys, count(DISTINCT customer_ref) AS distinct_keys FROM txn_gaps GROUP BY etl_batch_id",
    ),
    "s03c_runs_of_the_day": (
        lambda t: S.run_log(t.pipeline_runs, first=ORDERS_AS_OF, last=ORDERS_AS_OF).select("run_id", "pipeline_name", "target_table", "status"),
        f"SELECT run_id, pipeline_name, target_table, status FROM pipeline_runs WHERE run_date = DATE '{ORDERS_AS_OF}'",
    ),
    "s04a_sla_breach": (
        lambda t: freshness_report(t.table_catalog, t.pipeline_runs, NOW, "T2").select("table_id", "freshness_status"),
        f"""WITH ok AS (SELECT target_table, max(run_finished_at) AS f FROM pipeline_runs WHERE status = 'SUCCESS' GROUP BY 1)
            SELECT table_id, CASE WHEN f IS NULL THEN 'NEVER_LOADED' WHEN date_sub('minute', f, TIMESTAMP '{NOW}') > sla_hours * 60 THEN 'BREACHED' ELSE 'OK' END AS freshness_status
            FROM table_catalog LEFT JOIN ok ON target_table = table_id WHERE criticality = 'T2'""",
    ),
    "s04b_upstream_runs": (
        lambda t: S.run_log(t.pipeline_runs, tables=["core.tbl_1", "core.tbl_2", "core.tbl_3"]).select("run_id", "target_table", "status"),
        "SELECT run_id, target_table, status FROM pipeline_runs WHERE target_table IN ('core.tbl_1', 'core.tbl_2', 'core.tbl_3')",
    ),
    "s05a_spend_by_user": (
        lambda t: S.spend_by_user(t.query_cost),
        f"SELECT user_email, {r('sum(cost_usd)', 2)} AS cost_usd, {r('sum(bytes_processed) / 1e12', 3)} AS tb_processed, count(*) AS queries FROM query_cost GROUP BY user_email ORDER BY sum(cost_usd) DESC, user_email LIMIT 10",
    ),
    "s05b_jobs_of_user": (
        lambda t: S.jobs_of_user(t.query_cost, "user3").drop("query_labels"),
        f"SELECT job_id, {r('bytes_processed / 1e9', 2)} AS gb, {r('cost_usd', 2)} AS cost, table_reference FROM query_cost WHERE user_email = 'user3' ORDER BY cost_usd DESC, job_id LIMIT 10",
    ),
    "s05c_cache_share": (
        lambda t: S.cache_share(t.query_cost),
        f"SELECT user_email, count(*) FILTER (cache_hit) AS cached, count(*) AS total, {pct('count(*) FILTER (cache_hit)', 'count(*)', 1)} AS cache_pct FROM query_cost GROUP BY user_email",
    ),
    "s06a_repeated_keys": (
        lambda t: S.repeated_keys(t.txn_core),
        "SELECT txn_id, txn_date, count(*) AS occurrences FROM txn_core GROUP BY ALL HAVING count(*) > 1",
    ),
    "s06b_inflated_amount": (
        lambda t: S.inflated_amount(t.txn_core),
        """WITH d AS (SELECT txn_id, txn_date FROM txn_core GROUP BY ALL HAVING count(*) > 1)
           SELECT txn_date, count(*) AS dup_txns, sum(amount_usd)::DOUBLE AS inflated_amount FROM txn_core JOIN d USING (txn_id, txn_date) GROUP BY txn_date""",
    ),
    "s06c_duplicate_batches": (
        lambda t: S.duplicate_batches(t.txn_core),
        "SELECT etl_batch_id, count(*) AS row_count FROM txn_core WHERE (txn_id, txn_date) IN (SELECT (txn_id, txn_date) FROM txn_core GROUP BY txn_id, txn_date HAVING count(*) > 1) GROUP BY etl_batch_id",
    ),
    "s07a_segment_counts": (
        lambda t: S.segment_counts(t.dim_customer),
        "SELECT customer_segment, count(*) AS n FROM dim_customer WHERE is_current GROUP BY 1",
    ),
    "s07b_edges_into": (
        lambda t: S.edges_into(t.lineage_edges, "tbl_1%"),
        "SELECT source_table, source_column, target_table, target_column FROM lineage_edges WHERE starts_with(target_table, 'tbl_1')",
    ),
    "s07c_catalog_lookup": (
        lambda t: S.catalog_lookup(t.table_catalog, "%9"),
        "SELECT table_name, row_count, size_bytes FROM table_catalog WHERE ends_with(table_name, '9')",
    ),
    "s08a_attainment": (
        lambda t: S.attainment(t.support_cases),
        f"""WITH m AS (SELECT priority, status <> 'OPEN' AND resolved_at <= sla_due_at AS ok FROM support_cases)
            SELECT priority, count(*) AS total, count(*) FILTER (ok) AS met_sla, {pct('count(*) FILTER (ok)', 'count(*)', 1)} AS attainment_pct FROM m GROUP BY priority""",
    ),
    "s08b_open_age": (
        lambda t: S.open_age(t.support_cases, NOW, [(100, "0-100d"), (1000, "100-1000d")], "1000+d"),
        f"""WITH a AS (SELECT date_sub('day', opened_at, TIMESTAMP '{NOW}') AS d FROM support_cases WHERE status = 'OPEN')
            SELECT CASE WHEN d < 100 THEN '0-100d' WHEN d < 1000 THEN '100-1000d' ELSE '1000+d' END AS age_bucket, count(*) AS open_cases FROM a GROUP BY 1""",
    ),
    "s08c_board_number": (
        lambda t: S.board_number(t.support_cases),
        f"SELECT {pct(CLOSED_IN_TIME, 'count(*)', 1)} AS board_number FROM support_cases",
    ),
    "s09a_unregistered_columns": (
        lambda t: schema_drift(t.physical_columns.where("table_id LIKE 'core.tbl_1%'"), t.column_catalog),
        "SELECT table_id, column_name, data_type FROM physical_columns p WHERE table_id LIKE 'core.tbl_1%' AND NOT EXISTS (FROM column_catalog c WHERE c.table_id = p.table_id AND c.column_name = p.column_name)",
    ),
    "s09b_downstream": (
        lambda t: H.downstream(t.lineage_edges, "tbl_1", "c"),
        """WITH w AS (SELECT target_table, target_column, 0 AS d FROM lineage_edges WHERE source_table = 'tbl_1' UNION ALL
           SELECT e.target_table, e.target_column, w.d + 1 FROM w JOIN lineage_edges e ON e.source_table = w.target_table)
           SELECT target_table, target_column, max(d) AS depth FROM w GROUP BY ALL""",
    ),
    "s09c_last_failed_runs": (
        lambda t: S.run_log(t.pipeline_runs, status="FAILED", newest=3).select("run_id", "pipeline_name", "error_message"),
        "SELECT run_id, pipeline_name, error_message FROM pipeline_runs WHERE status = 'FAILED' ORDER BY run_started_at DESC, run_id DESC LIMIT 3",
    ),
    "s10a_late_by_day": (
        lambda t: S.late_by_day(t.txn_core),
        f"SELECT txn_date, max(etl_loaded_at)::DATE AS last_load, max({LATE})::INT AS max_late_days, count(*) FILTER ({LATE} > 3) AS late_rows FROM txn_core GROUP BY txn_date HAVING late_rows > 0",
    ),
    "s10b_late_by_source": (
        lambda t: S.late_by_source(t.txn_core),
        f"SELECT source_system, txn_type, count(*) AS n, sum(amount_usd)::DOUBLE AS amt FROM txn_core WHERE {LATE} > 3 GROUP BY ALL",
    ),
    "s10c_as_of_split": (
        lambda t: S.as_of_split(t.txn_core, 2),
        f"SELECT txn_date, count(*) FILTER ({LATE} <= 2) AS rows_in_report, count(*) FILTER ({LATE} > 2) AS rows_after_report FROM txn_core GROUP BY txn_date",
    ),
    "s11a_cases_by_day": (
        lambda t: S.cases_by_day(t.support_cases),
        "SELECT opened_date, case_type, count(*) AS cases FROM support_cases GROUP BY ALL",
    ),
    "s11b_event_bursts": (
        lambda t: S.event_bursts(t.ops_events, 25),
        "SELECT event_date, event_type, source_system, count(*) AS n FROM ops_events GROUP BY ALL HAVING count(*) > 25",
    ),
    "s11c_affected_customers": (
        lambda t: S.affected_customers(t.support_cases),
        f"""WITH x AS (SELECT opened_date, count(DISTINCT customer_key) AS affected_customers, sum((case_type = 'BILLING')::INT) AS b, count(*) AS n FROM support_cases GROUP BY opened_date)
            SELECT opened_date, affected_customers, {pct('b', 'n', 1)} AS type_share FROM x""",
    ),
    "s12a_product_sales": (
        lambda t: S.product_sales(t.txn_core, t.dim_product),
        "SELECT txn_date, product_id, sum(amount_usd)::DOUBLE AS sales, count(*) AS units FROM txn_core JOIN dim_product USING (product_key) WHERE is_current AND txn_core.status = 'POSTED' GROUP BY ALL",
    ),
    "s12b_receipts_by_warehouse": (
        lambda t: S.receipts_by_warehouse(t.receipts),
        "SELECT received_date, warehouse_code, sum(quantity)::BIGINT AS receipts, count(*) FILTER (quantity = 0) AS zero_receipts FROM receipts GROUP BY ALL",
    ),
    "s12c_last_receipts": (
        lambda t: S.last_receipts(t.receipts, ORDERS_AS_OF),
        f"SELECT product_key, warehouse_code, {avg('quantity', 2)} AS avg_receipt, max(received_date) AS last_receipt, date_diff('day', max(received_date), DATE '{ORDERS_AS_OF}')::INT AS days_since_last_receipt FROM receipts GROUP BY ALL",
    ),
    "s13a_query_cost": (
        lambda t: S.query_cost_of(t.query_cost),
        f"SELECT query_id, {r('sum(cost_usd)', 2)} AS cost, {r('sum(bytes_processed) / 1e12', 2)} AS tb, {r('(sum(total_slot_ms)::DOUBLE / count(*)) / 1000', 1)} AS avg_sec, count(*) AS runs FROM query_cost GROUP BY query_id",
    ),
    "s13b_jobs_of_query": (
        lambda t: S.jobs_of_query(t.query_cost, "q7"),
        f"SELECT job_id, {r('bytes_processed / 1e9', 2)} AS gb, {r('cost_usd', 2)} AS cost, table_reference FROM query_cost WHERE query_id = 'q7'",
    ),
    "s14a_null_share_by_load": (
        lambda t: S.null_share_by_load(t.dim_customer),
        f"""WITH d AS (SELECT etl_loaded_at::DATE AS load_date, round(CAST(100 * (count(*) - count(email))::DOUBLE / count(*) AS DECIMAL(28,8)), 2) AS n FROM dim_customer GROUP BY 1)
            SELECT load_date, n::DOUBLE AS null_pct, {r('(sum(n) OVER w)::DOUBLE / nullif(count(n) OVER w, 0)', 4)} AS baseline FROM d WINDOW w AS (ORDER BY load_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    ),
    "s14b_null_hot_spots": (
        lambda t: S.null_hot_spots(t.dim_customer),
        "SELECT customer_segment, country_code, count(*) - count(email) AS null_values, count(*) AS n FROM dim_customer WHERE is_current GROUP BY ALL HAVING null_values > 0 ORDER BY null_values DESC, customer_segment, country_code LIMIT 10",
    ),
    "s15a_event_volume": (
        lambda t: S.event_volume(t.ops_events),
        f"""WITH d AS (SELECT event_date, count(*) AS n FROM ops_events GROUP BY event_date), b AS (SELECT event_date, n, (sum(n) OVER w)::DOUBLE / nullif(count(n) OVER w, 0) AS a FROM d WINDOW w AS (ORDER BY event_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
            SELECT event_date, n AS events, {r('a', 4)} AS baseline, {div('n', 'a', 3)} AS volume_ratio FROM b""",
    ),
    "s15b_events_by_source": (
        lambda t: S.events_by_source(t.ops_events, "2024-01-05", "2024-01-25"),
        "SELECT source_system, count(*) AS events FROM ops_events WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1",
    ),
    "s15c_sink_runs": (
        lambda t: S.run_log(t.pipeline_runs, names=["load_low", "load_high"], first="2001-01-01").select("run_id", "pipeline_name", "status", "run_started_at"),
        "SELECT run_id, pipeline_name, status, run_started_at FROM pipeline_runs WHERE pipeline_name IN ('load_low', 'load_high') AND run_date >= DATE '2001-01-01'",
    ),
    "s16a_margin_below": (
        lambda t: S.margin_below(t.dim_product),
        "SELECT product_id, product_category, list_price::DOUBLE AS list_price, margin_pct::DOUBLE AS margin_pct FROM dim_product WHERE is_current AND margin_pct < 0",
    ),
    "s16b_current_version_misuse": (
        lambda t: S.current_version_misuse(t.txn_core, t.dim_product),
        f"""WITH x AS (SELECT product_category, amount_usd * margin_pct AS m, is_current AS cur, txn_timestamp >= valid_from AND (valid_to IS NULL OR txn_timestamp < valid_to) AS ok
              FROM txn_core t JOIN dim_product p ON p.product_key = t.product_key WHERE t.status = 'POSTED')
            SELECT product_category, {r('coalesce(sum(m) FILTER (cur), 0)', 2)} AS margin_used, {r('coalesce(sum(m) FILTER (ok), 0)', 2)} AS margin_then FROM x GROUP BY 1""",
    ),
    "s17a_failing_rules": (
        lambda t: S.failing_rules(t.dq_results),
        "SELECT rule_id, table_id, count(*) AS failures FROM dq_results WHERE status = 'FAIL' GROUP BY ALL ORDER BY failures DESC, rule_id, table_id LIMIT 15",
    ),
    "s17b_rule_history": (
        lambda t: S.rule_history(t.dq_results, "DQ-7"),
        "SELECT run_id, run_date, observed_value::DOUBLE AS observed_value, expected_value::DOUBLE AS expected_value, rows_checked, rows_failed FROM dq_results WHERE rule_id = 'DQ-7'",
    ),
    "s17c_ack_rate": (
        lambda t: S.ack_rate(t.alerts),
        f"SELECT alert_type, count(*) AS alerts, count(acknowledged_at) AS acked, {pct('count(acknowledged_at)', 'count(*)', 0)} AS ack_pct FROM alerts GROUP BY alert_type",
    ),
    "s18a_view_counts": (
        lambda t: S.view_counts(t.activity, "Tableau", "board1%"),
        "SELECT resource_name, max(activity_date) AS last_viewed, count(*) FILTER (activity_type = 'DASHBOARD_VIEW') AS views FROM activity WHERE app_name = 'Tableau' AND resource_name LIKE 'board1%' GROUP BY 1",
    ),
    "s18b_last_load": (
        lambda t: last_success(t.pipeline_runs),
        "SELECT target_table, max(run_finished_at) AS last_ok FROM pipeline_runs WHERE status = 'SUCCESS' GROUP BY 1",
    ),
    "s18c_extract_gap": (
        lambda t: S.extract_gap(gmv_by(t.txn_core, "txn_date", "channel_code"), t.txn_core.where("status = 'POSTED' AND source_system = 'ERP'"), "txn_date", "gmv_usd", "amount_usd"),
        f"""WITH e AS (SELECT txn_date, sum(amount_usd) AS x FROM txn_core WHERE status = 'POSTED' AND source_system = 'ERP' GROUP BY 1), c AS (SELECT txn_date, sum(amount_usd) AS y FROM txn_core WHERE {GMV} GROUP BY 1)
            SELECT txn_date, y::DOUBLE AS certified, x::DOUBLE AS extract_total, (coalesce(y, 0) - x)::DOUBLE AS gap FROM e LEFT JOIN c USING (txn_date)""",
    ),
    "s19a_weekly_usage": (
        lambda t: S.weekly_usage(t.activity),
        """SELECT date_trunc('week', activity_date)::DATE AS week_start, count(DISTINCT employee_key) AS active_users, count(*) FILTER (activity_type = 'QUERY') AS queries,
           count(*) FILTER (activity_type = 'DASHBOARD_VIEW') AS views FROM activity GROUP BY 1""",
    ),
    "s19b_stale_resources": (
        lambda t: stale_dashboards(t.activity, EVENTS_AS_OF, days=1).drop("views"),
        f"""SELECT resource_name, count(DISTINCT employee_key) AS viewers, max(activity_date) AS last_viewed,
            CASE WHEN max(activity_date) < DATE '{EVENTS_AS_OF}' - 1 THEN 'STALE' ELSE 'ACTIVE' END AS usage FROM activity WHERE app_name = 'Tableau' GROUP BY resource_name""",
    ),
    "s19c_usage_by_department": (
        lambda t: S.usage_by_department(t.activity, t.employees),
        "SELECT department, count(DISTINCT a.employee_key) AS users, count(*) FILTER (activity_type = 'QUERY') AS queries FROM activity a JOIN employees e ON e.employee_key = a.employee_key GROUP BY department",
    ),
    "s20a_chargeback_rate": (
        lambda t: S.chargeback_rate(t.txn_core),
        f"""WITH x AS (SELECT txn_date, count(*) FILTER (txn_type = 'CHARGEBACK') AS chargebacks, count(*) FILTER (txn_type = 'PAYMENT' AND status = 'POSTED') AS sales FROM txn_core GROUP BY txn_date)
            SELECT *, {pct('chargebacks', 'sales')} AS chargeback_rate FROM x""",
    ),
    "s20b_chargeback_cells": (
        lambda t: S.chargeback_cells(t.transactions, t.dim_product, t.dim_region, 20),
        """SELECT product_category, region_name, channel_code, count(*) AS cbs, sum(amount_usd)::DOUBLE AS cb_amount FROM transactions t JOIN dim_product p ON p.product_key = t.product_key AND p.is_current
           JOIN dim_region r ON r.region_key = t.region_key WHERE txn_type = 'CHARGEBACK' GROUP BY ALL HAVING count(*) > 20 ORDER BY cbs DESC, product_category, region_name, channel_code LIMIT 10""",
    ),
    "s20c_events_of_type": (
        lambda t: S.events_of_type(t.ops_events, "ERROR"),
        "SELECT event_date, event_type, count(*) AS n FROM ops_events WHERE event_type = 'ERROR' GROUP BY ALL",
    ),
    "s21a_implied_rate": (
        lambda t: S.implied_rate(t.transactions.withColumn("amount", (F.col("amount_usd") * F.col("fx_rate")).cast("decimal(28,6)"))),
        f"""SELECT currency_code, count(*) AS txns, sum(amount_usd * fx_rate)::DOUBLE AS local_amount, sum(amount_usd)::DOUBLE AS usd_amount,
            {div('sum(amount_usd)', 'sum(amount_usd * fx_rate)', 6)} AS implied_rate FROM transactions WHERE status = 'POSTED' GROUP BY currency_code""",
    ),
    "s21b_rate_spread": (
        lambda t: S.rate_spread(t.transactions),
        "SELECT txn_date, currency_code, min(fx_rate)::DOUBLE AS min_rate, max(fx_rate)::DOUBLE AS max_rate, count(DISTINCT fx_rate) AS distinct_rates FROM transactions GROUP BY ALL",
    ),
    "s21c_corrected_total": (
        lambda t: S.corrected_total(t.transactions, "EUR", "1.0800", "amount_usd"),
        f"""WITH s AS (SELECT sum(amount_usd) AS x FROM transactions WHERE currency_code = 'EUR' AND status = 'POSTED')
            SELECT x::DOUBLE AS reported_usd, {r('x * 1.08', 2)} AS corrected_usd, {r('x * 1.08 - x', 2)} AS gap FROM s""",
    ),
    "s22a_orphan_amount": (
        lambda t: S.orphan_amount(t.txn_core, t.dim_customer.where("is_active")),
        "SELECT count(*) AS orphan_txns, sum(amount_usd)::DOUBLE AS orphan_amount FROM txn_core WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer WHERE is_active)",
    ),
    "s22b_orphans_by_day": (
        lambda t: S.orphans_by_day(t.txn_core, t.dim_customer.where("is_active")),
        "SELECT txn_date, count(*) FILTER (NOT is_active)::BIGINT AS orphans FROM txn_core JOIN dim_customer USING (customer_key) GROUP BY txn_date",
    ),
    "s22c_merge_runs": (
        lambda t: S.run_log(t.pipeline_runs, names=["load_medium"], first="2000-01-01", last="2000-12-31").select("run_id", "error_message", "rows_written"),
        "SELECT run_id, error_message, rows_written FROM pipeline_runs WHERE pipeline_name = 'load_medium' AND run_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'",
    ),
}

for _name, (_build, _sql) in ENTRIES.items():
    query(_name, _sql)(_build)
