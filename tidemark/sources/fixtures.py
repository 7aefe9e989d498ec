"""Warehouse-shaped tables derived from the given parquet tables.

Each entry is SQL that reads the same in Spark and DuckDB, with ``{name}`` for
an input table or another entry. Spark runs the text lazily; the oracle prefixes
it as a CTE. Money is fixed to decimals here, so later sums are exact.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURES: dict[str, str] = {}

# The line facts with their order. The same select serves two headers: the bare
# orders, and the orders already joined with customer and nation. Joining the
# customer to the orders first moves the large line table through one shuffle only.
_TXN = """
SELECT concat('TXN-', cast(l.l_orderkey AS STRING), '-', cast(l.l_linenumber AS STRING)) AS txn_id,
  l.l_orderkey * 10 + l.l_linenumber AS txn_no,
  cast(o.o_orderdate AS DATE) AS txn_date, o.o_orderdate AS txn_timestamp,
  o.o_custkey AS customer_key, l.l_suppkey AS account_key, l.l_partkey AS product_key,
  o.o_orderpriority AS channel_code,
  CASE WHEN l.l_returnflag = 'R' THEN 'REFUND' WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'CHARGEBACK' ELSE 'PAYMENT' END AS txn_type,
  cast(cast(l.l_extendedprice AS DECIMAL(14,2)) * (1 - cast(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS amount_usd,
  CASE o.o_orderstatus WHEN 'F' THEN 'POSTED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status,
  l.l_returnflag = 'R' AS is_reversal,
  o.o_orderdate + (l.l_orderkey % 97 + l.l_suppkey % 5) * INTERVAL '1' HOUR AS etl_loaded_at,
  4000 + l.l_orderkey % 50 AS etl_batch_id,
  CASE WHEN l.l_orderkey % 2 = 0 THEN 'ERP' ELSE 'OMS' END AS source_system
"""

FIXTURES["txn_core"] = _TXN + "FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"

FIXTURES["order_headers"] = """
SELECT o.*, n.n_regionkey, c.c_mktsegment FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

FIXTURES["transactions"] = _TXN + """, o.n_regionkey AS region_key, o.c_mktsegment AS bu_code,
  CASE o.n_regionkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency_code,
  cast(CASE o.n_regionkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN CASE WHEN l.l_suppkey % 10 = 0 THEN 1.0 ELSE 1.08 END ELSE 1.25 END AS DECIMAL(8,4)) AS fx_rate
FROM {lineitem} l JOIN {order_headers} o ON l.l_orderkey = o.o_orderkey
"""

# Rows with injected gaps: the customer key is missing on some rows of some days.
FIXTURES["txn_gaps"] = """
SELECT t.*, CASE WHEN t.txn_no % 13 = 0 AND t.etl_batch_id % 3 = 0 THEN NULL ELSE t.customer_key END AS customer_ref
FROM {txn_core} t
"""

FIXTURES["dim_product"] = """
SELECT p_partkey AS product_key, concat('SKU-', cast(p_partkey AS STRING)) AS product_id, p_name AS product_name,
  p_type AS product_category, p_brand AS brand, CASE WHEN p_size % 10 = 0 THEN 'DISCONTINUED' ELSE 'ACTIVE' END AS status,
  cast(p_retailprice AS DECIMAL(18,2)) AS list_price, cast((p_size % 40) * 0.01 AS DECIMAL(6,4)) AS margin_pct,
  TIMESTAMP '1995-01-01 00:00:00' AS valid_from, TIMESTAMP '1998-01-01 00:00:00' AS valid_to, false AS is_current
FROM {part}
UNION ALL
SELECT p_partkey, concat('SKU-', cast(p_partkey AS STRING)), p_name, p_type, p_brand,
  CASE WHEN p_size % 10 = 0 THEN 'DISCONTINUED' ELSE 'ACTIVE' END,
  cast(cast(p_retailprice AS DECIMAL(14,2)) * 1.1 AS DECIMAL(18,2)), cast((p_size % 40 + p_partkey % 5 - 2) * 0.01 AS DECIMAL(6,4)),
  TIMESTAMP '1998-01-01 00:00:00', CAST(NULL AS TIMESTAMP), p_partkey % 97 <> 0
FROM {part}
"""

FIXTURES["dim_customer"] = """
SELECT c.c_custkey AS customer_key, concat('C-', cast(c.c_custkey AS STRING)) AS customer_id, c.c_name AS full_name,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE concat('user', cast(c.c_custkey AS STRING), '@example.com') END AS email,
  c.c_mktsegment AS customer_segment, CASE WHEN c.c_acctbal > 7000 THEN 'GOLD' WHEN c.c_acctbal > 3000 THEN 'SILVER' ELSE 'BRONZE' END AS tier,
  n.n_name AS country_code, n.n_regionkey AS region_key, cast(c.c_acctbal AS DECIMAL(18,2)) AS annual_revenue,
  c.c_custkey % 10 <> 0 AS is_active, true AS is_current,
  TIMESTAMP '1995-01-01 00:00:00' + (c.c_custkey % 400) * INTERVAL '1' DAY AS etl_loaded_at
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

FIXTURES["dim_region"] = "SELECT r_regionkey AS region_key, r_name AS region_name FROM {region}"

FIXTURES["dim_business_unit"] = """
SELECT DISTINCT c_mktsegment AS bu_code, concat('BU ', c_mktsegment) AS bu_name FROM {customer}
"""

FIXTURES["support_cases"] = """
SELECT o_orderkey AS case_number, o_custkey AS customer_key, o_orderdate AS opened_at,
  cast(o_orderdate AS DATE) AS opened_date, concat('P', substr(o_orderpriority, 1, 1)) AS priority,
  CASE o_custkey % 5 WHEN 0 THEN 'BILLING' WHEN 1 THEN 'TECHNICAL' WHEN 2 THEN 'ACCOUNT' WHEN 3 THEN 'COMPLAINT' ELSE 'REQUEST' END AS case_type,
  CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'RESOLVED' END AS status,
  o_orderdate + INTERVAL '24' HOUR AS sla_due_at,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + (o_orderkey % 60) * INTERVAL '1' HOUR END AS resolved_at,
  1 + o_orderkey % 5 AS satisfaction_score, o_orderkey % 11 = 0 AS is_escalated, o_orderkey % 3 AS reopen_count,
  concat(CASE o_orderkey % 6 WHEN 0 THEN 'Wrong DATA shown' WHEN 1 THEN 'Report is late' WHEN 2 THEN 'Cannot log in' ELSE 'Delivery question' END, ' #', cast(o_orderkey AS STRING)) AS case_note
FROM {orders}
"""

FIXTURES["ops_events"] = """
SELECT event_id, ts AS event_timestamp, cast(ts AS DATE) AS event_date, upper(event_type) AS event_type,
  CASE WHEN event_type = 'error' THEN 'FAILURE' WHEN event_id % 50 = 0 THEN 'TIMEOUT' ELSE 'SUCCESS' END AS status,
  concat('svc-', cast(user_id % 7 AS STRING)) AS service_name, CASE user_id % 3 WHEN 0 THEN 'GATEWAY' WHEN 1 THEN 'APP' ELSE 'BATCH' END AS source_system,
  cast(value AS DECIMAL(14,2)) * 10 AS latency_ms,
  user_id AS customer_key, concat(cast(user_id AS STRING), '/', cast(cast(ts AS DATE) AS STRING)) AS session_id, props AS payload
FROM {events}
"""

# Event payloads with scalar, array and object members.
FIXTURES["event_docs"] = """
SELECT event_id, cast(ts AS DATE) AS event_date, upper(event_type) AS event_type, concat('BU-', cast(user_id % 6 AS STRING)) AS bu_code,
  concat('{{"order_id":"O-', cast(event_id AS STRING), '","gateway":"gw', cast(user_id % 4 AS STRING), '",',
    CASE WHEN event_type = 'error' THEN concat('"error_code":"E', cast(event_id % 9 AS STRING), '",') ELSE '' END,
    '"attempts":', cast(1 + event_id % 4 AS STRING), ',"sku":"S', cast(user_id % 25 AS STRING), '","ok":', CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END,
    ',"error_list":[', CASE WHEN event_type = 'error' THEN concat('"E', cast(event_id % 9 AS STRING), '","E', cast(user_id % 9 AS STRING), '"') ELSE '' END, ']',
    ',"line_items":[{{"sku":"S', cast(user_id % 25 AS STRING), '","qty":', cast(1 + event_id % 5 AS STRING), '}}',
    CASE WHEN event_id % 2 = 0 THEN concat(',{{"sku":"T', cast(event_id % 40 AS STRING), '","qty":2}}') ELSE '' END, ']',
    ',"customer":{{"id":"C-', cast(user_id AS STRING), '","name":"n', cast(user_id AS STRING), '","email":"u', cast(user_id AS STRING), '@example.com"}}}}') AS payload
FROM {events}
"""

FIXTURES["employees"] = """
SELECT s_suppkey AS employee_key, s_name AS full_name, concat('dept', cast(s_nationkey % 5 AS STRING)) AS department,
  CASE WHEN s_suppkey = 0 THEN NULL ELSE cast(floor((s_suppkey - 1) / 4) AS BIGINT) END AS manager_employee_key,
  CASE WHEN s_suppkey % 9 = 4 THEN 'LEAVE' ELSE 'ACTIVE' END AS employment_status
FROM {supplier}
"""

FIXTURES["bom"] = """
SELECT p_partkey AS component_product_key, cast(floor((p_partkey - 1) / 2) AS BIGINT) AS parent_product_key,
  1 + p_partkey % 3 AS quantity_per_unit
FROM {part} WHERE p_partkey > 0
"""

FIXTURES["pipeline_runs"] = """
SELECT o_orderkey AS run_id, concat('load_', lower(replace(substr(o_orderpriority, 3), ' ', '_'))) AS pipeline_name,
  concat('core.tbl_', cast(o_custkey AS STRING)) AS target_table,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS run_started_at,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR + (5 + o_orderkey % 170) * INTERVAL '1' MINUTE END AS run_finished_at,
  cast(o_orderdate AS DATE) AS run_date, CASE WHEN o_orderkey % 25 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  cast(floor(cast(o_totalprice AS DECIMAL(14,2))) AS BIGINT) AS rows_written,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast(94 + (o_orderkey % 60) * 0.1 AS DECIMAL(5,2)) END AS dq_score, o_orderkey % 8 <> 0 AS dq_passed,
  CASE WHEN o_orderkey % 25 = 0 THEN concat('Unrecognized name in batch ', cast(o_orderkey % 7 AS STRING)) END AS error_message
FROM {orders}
"""

FIXTURES["query_cost"] = """
SELECT l_orderkey * 1000 + l_linenumber * 100 + l_suppkey % 100 AS job_id, concat('q', cast(l_partkey % 500 AS STRING)) AS query_id,
  concat('user', cast(l_suppkey % 40 AS STRING)) AS user_email, concat('ds', cast(l_partkey % 6 AS STRING)) AS dataset_id,
  cast(l_shipdate AS DATE) AS job_date, cast(cast(l_extendedprice AS DECIMAL(14,2)) * 1000000 AS BIGINT) AS bytes_processed,
  cast(cast(l_extendedprice AS DECIMAL(14,2)) * 1100000 AS BIGINT) AS bytes_billed, l_orderkey * 37 + l_partkey * 11 AS total_slot_ms,
  cast(cast(l_extendedprice AS DECIMAL(14,2)) * 0.00625 AS DECIMAL(18,6)) AS cost_usd, l_orderkey % 4 = 0 AS cache_hit,
  CASE l_partkey % 5 WHEN 0 THEN 'raw_layer.a' WHEN 1 THEN 'staging_layer.b' WHEN 2 THEN 'core_layer.fct_transactions' WHEN 3 THEN 'analytics_layer.d' ELSE 'ops.e' END AS table_reference,
  concat('{{"team":"t', cast(l_suppkey % 8 AS STRING), '","cost_center":"c', cast(l_suppkey % 3 AS STRING), '"}}') AS query_labels,
  concat('SELECT * FROM m', cast(l_partkey % 700 AS STRING)) AS query_text, CASE WHEN l_linenumber = 7 THEN 'LOAD' ELSE 'QUERY' END AS job_type,
  CASE WHEN l_orderkey % 50 = 0 THEN 'RUNNING' ELSE 'DONE' END AS state
FROM {lineitem}
"""

FIXTURES["slot_usage"] = """
SELECT ts AS period_start, cast(cast(value AS DECIMAL(14,2)) * 100 AS DECIMAL(14,2)) AS slot_count FROM {events}
"""

FIXTURES["activity"] = """
SELECT event_id AS activity_id, ts AS activity_timestamp, cast(ts AS DATE) AS activity_date, user_id AS employee_key,
  CASE event_type WHEN 'view' THEN 'DASHBOARD_VIEW' WHEN 'click' THEN 'QUERY' WHEN 'signup' THEN 'LOGIN' WHEN 'purchase' THEN 'REPORT_DOWNLOAD' ELSE 'ALERT' END AS activity_type,
  CASE WHEN event_id % 2 = 0 THEN 'Tableau' ELSE 'Portal' END AS app_name, concat('board', cast(user_id % 40 AS STRING)) AS resource_name
FROM {events}
"""

FIXTURES["table_catalog"] = """
SELECT concat('core.tbl_', cast(p_partkey AS STRING)) AS table_id, 'core' AS dataset_id, concat('tbl_', cast(p_partkey AS STRING)) AS table_name,
  p_name AS description, p_type AS data_product_name, p_brand AS data_owner, concat('T', cast(1 + p_partkey % 3 AS STRING)) AS criticality,
  cast(p_size AS BIGINT) * 24 AS sla_hours, p_partkey % 4 <> 0 AS is_certified,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE TIMESTAMP '2001-08-01 00:00:00' - (p_partkey % 900) * INTERVAL '1' HOUR END AS last_loaded_at,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat(lower(p_type), ',', lower(replace(p_name, ' ', ',')), ',k', cast(p_partkey % 7 AS STRING)) END AS clustering_columns,
  cast(p_partkey * 1000 AS BIGINT) AS row_count, cast(p_partkey * 123456789 AS BIGINT) AS size_bytes
FROM {part}
"""

FIXTURES["column_catalog"] = """
SELECT concat('core.tbl_', cast(p_partkey % 300 AS STRING)) AS table_id,
  concat(CASE p_size % 9 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' WHEN 2 THEN 'card_number' WHEN 3 THEN 'patient_id' WHEN 4 THEN 'amount' WHEN 5 THEN 'status' WHEN 6 THEN 'full_name' WHEN 7 THEN 'claim_ref' ELSE 'region' END, '_', cast(p_partkey AS STRING)) AS column_name,
  CASE p_size % 9 WHEN 0 THEN 'PII' WHEN 1 THEN 'PII' WHEN 2 THEN 'PCI' WHEN 3 THEN 'PHI' WHEN 6 THEN 'PII' WHEN 7 THEN 'PHI' ELSE 'INTERNAL' END AS sensitivity,
  CASE p_partkey % 3 WHEN 0 THEN 'STRING' WHEN 1 THEN 'BIGINT' ELSE 'DATE' END AS data_type, p_partkey AS column_no
FROM {part}
"""

FIXTURES["physical_columns"] = """
SELECT table_id, CASE WHEN column_no % 12 = 0 THEN concat(column_name, '_v2') ELSE column_name END AS column_name, data_type FROM {column_catalog}
"""

FIXTURES["dq_rules"] = """
SELECT concat('DQ-', cast(p_partkey AS STRING)) AS rule_id, concat('core.tbl_', cast(p_partkey % 300 AS STRING)) AS table_id,
  concat(CASE p_size % 9 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' WHEN 2 THEN 'card_number' WHEN 3 THEN 'patient_id' WHEN 4 THEN 'amount' WHEN 5 THEN 'status' WHEN 6 THEN 'full_name' WHEN 7 THEN 'claim_ref' ELSE 'region' END, '_', cast(p_partkey AS STRING)) AS column_name,
  p_partkey % 5 <> 0 AS is_active
FROM {part} WHERE p_size > 12
"""

FIXTURES["lineage_edges"] = """
SELECT concat('tbl_', cast(floor((p_partkey - 1) / 3) AS BIGINT)) AS source_table, 'c' AS source_column,
  concat('tbl_', cast(p_partkey AS STRING)) AS target_table, 'c' AS target_column,
  CASE p_size % 4 WHEN 0 THEN 'cast' WHEN 1 THEN 'aggregate' WHEN 2 THEN 'rename' ELSE 'direct' END AS transformation
FROM {part} WHERE p_partkey > 0
UNION ALL
SELECT concat('tbl_', cast(p_partkey AS STRING)), 'c', concat('tbl_', cast(2 * p_partkey + 3 AS STRING)), 'c', 'direct'
FROM {part} WHERE p_partkey % 4 = 1
"""

FIXTURES["view_texts"] = """
SELECT concat('v_', cast(p_partkey AS STRING)) AS target_table,
  concat('SELECT ', CASE p_partkey % 4
    WHEN 0 THEN concat('s.amount AS amt, CAST(s.price AS STRING) AS price_txt, s.qty * 2 AS dbl, other.z AS zz, plain FROM s WHERE x > ', cast(p_size AS STRING))
    WHEN 1 THEN concat('coalesce(s.a', cast(p_size AS STRING), ', nullif(t.b, 0), 1) AS picked, s.a * t.b total FROM s JOIN t ON s.k = t.k')
    WHEN 2 THEN concat('CAST(round(s.v', cast(p_size AS STRING), ', 2) AS DECIMAL(10, 2)) AS v FROM s')
    ELSE concat('s.k k, greatest(least(s.lo, ', cast(p_size AS STRING), '), s.hi) AS bound FROM s LEFT JOIN t ON t.k = s.k') END) AS view_sql
FROM {part}
"""

FIXTURES["upload"] = """
SELECT event_id + 2 AS row_no, CASE WHEN event_id % 40 = 7 THEN concat('E-', cast(event_id - 1 AS STRING)) ELSE concat('E-', cast(event_id AS STRING)) END AS txn_id,
  CASE WHEN event_id % 31 = 0 THEN ' ' ELSE cast(user_id AS STRING) END AS customer_id,
  CASE WHEN event_id % 17 = 0 THEN concat('-', cast(cast(value AS DECIMAL(14,2)) AS STRING)) WHEN event_id % 101 = 0 THEN '75000.5' WHEN event_id % 57 = 0 THEN 'n/a' ELSE cast(cast(value AS DECIMAL(14,2)) AS STRING) END AS amount_usd,
  CASE WHEN event_type = 'error' THEN 'REFUND' ELSE 'PAYMENT' END AS txn_type, CASE WHEN event_id % 23 = 0 THEN 'weird' ELSE 'posted' END AS status, event_type AS promo
FROM {events}
"""

FIXTURES["dq_results"] = """
SELECT o_orderkey AS run_id, o_orderdate + (o_orderkey % 120) * INTERVAL '1' MINUTE AS run_timestamp, cast(o_orderdate AS DATE) AS run_date,
  concat('DQ-', cast(o_custkey % 50 AS STRING)) AS rule_id, concat('core.tbl_', cast(o_custkey % 12 AS STRING)) AS table_id, concat('col_', cast(o_custkey % 5 AS STRING)) AS column_name,
  CASE o_orderkey % 9 WHEN 0 THEN 'COMPLETENESS' WHEN 1 THEN 'UNIQUENESS' WHEN 2 THEN 'VALIDITY' WHEN 3 THEN 'TIMELINESS' WHEN 4 THEN 'ACCURACY' WHEN 5 THEN 'CONSISTENCY' WHEN 6 THEN 'INTEGRITY' WHEN 7 THEN 'FRESHNESS' ELSE 'VOLUME' END AS dimension,
  CASE o_custkey % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'INFO' END AS severity,
  CASE WHEN o_orderkey % 6 = 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  cast(floor(cast(o_totalprice AS DECIMAL(14,2))) AS BIGINT) AS rows_checked,
  CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey % 700 ELSE 0 END AS rows_failed,
  cast(0.05 AS DECIMAL(6,4)) AS expected_value, cast((o_orderkey % 700) * 0.0001 AS DECIMAL(10,4)) AS observed_value,
  CASE WHEN o_orderkey % 6 = 0 THEN concat('[{{"customer_id":"C-', cast(o_custkey AS STRING), '","txn_id":"TXN-', cast(o_orderkey AS STRING), '","amount_usd":"', cast(o_orderkey % 900 AS STRING), '"}},{{"customer_id":"C-', cast(o_custkey + 1 AS STRING), '","txn_id":"TXN-x","amount_usd":"1"}}]') END AS sample_of_failures
FROM {orders}
"""

FIXTURES["dq_health"] = """
SELECT cast(o_orderdate AS DATE) AS score_date, concat('product ', substr(o_orderpriority, 1, 1)) AS data_product_name,
  concat('core.tbl_', substr(o_orderpriority, 1, 1)) AS table_id,
  cast(86 + (sum(o_orderkey) % 140) * 0.1 AS DECIMAL(5,2)) AS dq_score, count(*) + 3 AS checks_run, sum(o_orderkey) % 4 AS checks_failed
FROM {orders} GROUP BY cast(o_orderdate AS DATE), substr(o_orderpriority, 1, 1)
"""

FIXTURES["alerts"] = """
SELECT o_orderkey AS alert_id, CASE o_custkey % 4 WHEN 0 THEN 'FRESHNESS' WHEN 1 THEN 'DQ' WHEN 2 THEN 'SCHEMA' ELSE 'COST' END AS alert_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'OPEN' ELSE 'ACKNOWLEDGED' END AS status,
  concat('alert ', cast(o_orderkey AS STRING)) AS subject, o_orderdate + (o_orderkey % 900) * INTERVAL '1' MINUTE AS triggered_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (900 + o_orderkey % 4000) * INTERVAL '1' MINUTE END AS resolved_at,
  CASE WHEN o_orderkey % 3 <> 1 THEN o_orderdate + (900 + o_orderkey % 300) * INTERVAL '1' MINUTE END AS acknowledged_at,
  cast(o_orderdate AS DATE) AS triggered_date, concat('DQ-', cast(o_custkey % 50 AS STRING)) AS rule_id
FROM {orders}
"""

FIXTURES["glossary"] = """
SELECT concat('term ', cast(p_partkey AS STRING)) AS term_name, concat('definition ', p_name) AS definition, p_brand AS owner_team,
  2 + p_size % 3 AS version, CASE WHEN p_size % 6 = 0 THEN 'DRAFT' ELSE 'CERTIFIED' END AS status
FROM {part}
"""

FIXTURES["glossary_export"] = """
SELECT concat('term ', cast(p_partkey AS STRING)) AS term_name, concat('old ', p_name) AS definition, p_brand AS owner_team, 3 AS version
FROM {part} WHERE p_partkey % 3 <> 0
"""

FIXTURES["receipts"] = """
SELECT concat('R-', cast(l_orderkey AS STRING), '-', cast(l_linenumber AS STRING)) AS receipt_id, concat('WH', cast(l_suppkey % 7 AS STRING)) AS warehouse_code,
  l_partkey AS product_key, CASE WHEN l_orderkey % 29 = 0 THEN 0 ELSE cast(l_quantity AS BIGINT) END AS quantity,
  l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR AS received_timestamp, cast(l_shipdate AS DATE) AS received_date
FROM {lineitem}
"""

FIXTURES["stg_product"] = """
SELECT concat('SKU-', cast(p_partkey AS STRING)) AS product_id, p_name AS product_name, p_type AS product_category, p_brand AS brand,
  cast(cast(p_retailprice AS DECIMAL(14,2)) * CASE WHEN p_partkey % 4 = 0 THEN 1.2 ELSE 1.0 END AS DECIMAL(18,2)) AS list_price,
  cast(cast(p_retailprice AS DECIMAL(14,2)) * 0.6 AS DECIMAL(18,2)) AS cost_price, p_partkey % 9 <> 0 AS is_active
FROM {part}
UNION ALL
SELECT concat('NEW-', cast(p_partkey AS STRING)), p_name, p_type, p_brand, cast(99.50 AS DECIMAL(18,2)), cast(40.25 AS DECIMAL(18,2)), true FROM {part} WHERE p_partkey % 50 = 7
"""

FIXTURES["erp"] = """
SELECT txn_id, txn_no, txn_date, CASE WHEN txn_no % 211 = 0 THEN amount_usd + 1 ELSE amount_usd END AS amount_usd FROM {txn_core} WHERE customer_key % 7 <> 0
"""

FIXTURES["oms"] = "SELECT txn_id, txn_no, txn_date, amount_usd FROM {txn_core} WHERE customer_key % 11 <> 0"

FIXTURES["customer_cdc"] = """
SELECT concat('C-', cast(c_custkey AS STRING)) AS customer_id, c_name AS full_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'REASSIGNED' ELSE c_mktsegment END AS customer_segment,
  CASE WHEN c_acctbal > 7000 THEN 'GOLD' WHEN c_acctbal > 3000 THEN 'SILVER' ELSE 'BRONZE' END AS tier, c_custkey % 10 <> 0 AS is_active,
  c_custkey % 35 = 0 AS full_load_flag, TIMESTAMP '2001-07-01 00:00:00' + (c_custkey % 50) * INTERVAL '1' DAY AS effective_from
FROM {customer} WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0
UNION ALL
SELECT concat('N-', cast(c_custkey AS STRING)), c_name, c_mktsegment, 'NEW', true, false, TIMESTAMP '2001-07-05 00:00:00' FROM {customer} WHERE c_custkey % 20 = 0
"""

_PLACEHOLDER = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def needs(name: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(FIXTURES[name])))


class Tables:
    """Base tables and fixtures of one data folder as lazy DataFrames (``t.transactions``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = str(folder).rstrip("/")
        self._seen: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in FIXTURES:
                # Timestamps in the files carry no zone, so literals must not either.
                text = FIXTURES[name].replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
                self._seen[name] = self.spark.sql(text, **{n: getattr(self, n) for n in needs(name)})
            else:
                self._seen[name] = self.spark.read.parquet(self.path(name))
        return self._seen[name]


def oracle_ctes(names: list[str]) -> list[str]:
    """CTE texts for the fixtures and everything they need, in dependency order."""
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done or name not in FIXTURES:
            return
        for inner in needs(name):
            visit(inner)
        done[name] = f"{name} AS ({FIXTURES[name].format(**{n: n for n in needs(name)}).strip()})"

    for name in names:
        visit(name)
    return list(done.values())
