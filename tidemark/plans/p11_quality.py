"""Data-quality engine D1-D20 over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import query, r
from tidemark.quality import engine as E
from tidemark.quality.rules import RULE_TYPES, Rule, active_rules, rule_table, seed_rules

COUNTS = ["rule_id", "rows_checked", "rows_failed"]


def _check(t, rules):
    names = {x.table for x in rules} | {x.params[k] for x in rules for k in ("dim", "other") if k in x.params}
    return E.run_checks(t.spark, {n: getattr(t, n) for n in names}, rules)


@query("d1_completeness", "SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) - count(customer_ref) AS rows_failed FROM txn_gaps WHERE txn_type = 'PAYMENT'")
def _(t):
    return _check(t, [Rule("X", "COMPLETENESS", "txn_gaps", "customer_ref", params={"filter": "txn_type = 'PAYMENT'"})]).select(*COUNTS)


@query("d2_uniqueness", "SELECT 'X' AS rule_id, count(txn_id) AS rows_checked, count(txn_id) - count(DISTINCT txn_id) AS rows_failed FROM txn_core")
def _(t):
    return _check(t, [Rule("X", "UNIQUENESS", "txn_core", "txn_id")]).select(*COUNTS)


@query("d3_validity", "SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (NOT (customer_ref > 100)) AS rows_failed FROM txn_gaps")
def _(t):
    return _check(t, [Rule("X", "VALIDITY", "txn_gaps", "customer_ref", params={"condition": "customer_ref > 100"})]).select(*COUNTS)


@query("d4_integrity", "SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (customer_ref IS NULL OR customer_ref NOT IN (SELECT customer_key FROM dim_customer WHERE customer_key IS NOT NULL)) AS rows_failed FROM txn_gaps")
def _(t):
    return _check(t, [Rule("X", "INTEGRITY", "txn_gaps", "customer_ref", params={"dim": "dim_customer", "dim_key": "customer_key"})]).select(*COUNTS)


@query("d5_freshness", f"SELECT 'X' AS rule_id, 1::BIGINT AS rows_checked, (date_sub('hour', max(etl_loaded_at), TIMESTAMP '{NOW}') > 24)::INT::BIGINT AS rows_failed FROM txn_core")
def _(t):
    return _check(t, [Rule("X", "FRESHNESS", "txn_core", params={"timestamp": "etl_loaded_at", "hours": 24, "as_of": NOW})]).select(*COUNTS)


@query(
    "d6_volume",
    """WITH d AS (SELECT txn_date, count(*) AS n FROM txn_core GROUP BY txn_date), x AS (SELECT txn_date, n, avg(n) OVER (ORDER BY txn_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS a FROM d)
       SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (n < 0.5 * a) AS rows_failed FROM x WHERE txn_date = (SELECT max(txn_date) FROM d)""",
)
def _(t):
    return _check(t, [Rule("X", "VOLUME", "txn_core", params={"date": "txn_date", "ratio": 0.5})]).select(*COUNTS)


@query("d7_timeliness", "SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (etl_loaded_at > txn_date::TIMESTAMP + INTERVAL 12 HOUR) AS rows_failed FROM txn_core")
def _(t):
    return _check(t, [Rule("X", "TIMELINESS", "txn_core", "etl_loaded_at", params={"date": "txn_date"})]).select(*COUNTS)


@query(
    "d8_accuracy",
    "WITH s AS (SELECT avg(amount_usd::DOUBLE) AS m, stddev_samp(amount_usd::DOUBLE) AS d FROM txn_core) SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (amount_usd::DOUBLE > m + 1.5::DOUBLE * d) AS rows_failed FROM txn_core, s",
)
def _(t):
    return _check(t, [Rule("X", "ACCURACY", "txn_core", "amount_usd", params={"sigma": 1.5})]).select(*COUNTS)


@query(
    "d9_consistency",
    """WITH a AS (SELECT txn_date, sum(amount_usd) AS x FROM erp GROUP BY 1), b AS (SELECT txn_date, sum(amount_usd) AS y FROM oms GROUP BY 1)
       SELECT 'X' AS rule_id, count(*) AS rows_checked, count(*) FILTER (x IS NULL OR y IS NULL OR abs(x - y) > 0.01) AS rows_failed FROM a FULL JOIN b USING (txn_date)""",
)
def _(t):
    params = {"other": "oms", "by": "txn_date", "other_column": "amount_usd"}
    return _check(t, [Rule("X", "CONSISTENCY", "erp", "amount_usd", params=params)]).select(*COUNTS)


@query("d10_load_rules", "SELECT rule_id, table_id, column_name FROM dq_rules WHERE is_active AND column_name IS NOT NULL")
def _(t):
    return active_rules(t.dq_rules).select("rule_id", "table_id", "column_name")


SEED_TABLES = ["txn_core", "support_cases", "dim_customer", "ops_events", "pipeline_runs", "table_catalog"]


def _seed_oracle() -> str:
    def uniq(rule: str, table: str, column: str, sev: str = "ERROR") -> str:
        return f"SELECT '{rule}' AS rule_id, '{table}' AS table_id, 'UNIQUENESS' AS dimension, '{sev}' AS severity, 0.0::DOUBLE AS m, count({column}) AS c, count({column}) - count(DISTINCT {column}) AS f FROM {table}"

    def rows(rule: str, dim: str, table: str, bad: str, m: float, sev: str = "ERROR") -> str:
        return f"SELECT '{rule}', '{table}', '{dim}', '{sev}', {m}::DOUBLE, count(*), count(*) FILTER ({bad}) FROM {table}"

    known = "NOT IN (SELECT customer_key FROM dim_customer)"
    parts = [
        uniq("TXN-1", "txn_core", "txn_id"),
        rows("TXN-2", "COMPLETENESS", "txn_core", "customer_key IS NULL", 0.001),
        rows("TXN-3", "VALIDITY", "txn_core", "txn_type NOT IN ('DEPOSIT', 'WITHDRAWAL', 'PAYMENT', 'TRANSFER', 'FEE', 'REFUND', 'CHARGEBACK')", 0.001),
        rows("TXN-4", "VALIDITY", "txn_core", "amount_usd < 0 AND txn_type NOT IN ('REFUND', 'CHARGEBACK')", 0.002),
        rows("TXN-5", "INTEGRITY", "txn_core", f"customer_key {known}", 0),
        """SELECT 'TXN-6', 'txn_core', 'VOLUME', 'WARNING', 0.0::DOUBLE, 1, count(*) FILTER (n < 0.5 * a) FROM (SELECT txn_date, count(*) AS n, avg(count(*)) OVER (ORDER BY txn_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS a
           FROM txn_core GROUP BY txn_date) WHERE txn_date = (SELECT max(txn_date) FROM txn_core)""",
        f"SELECT 'TXN-7', 'txn_core', 'FRESHNESS', 'ERROR', 0.0::DOUBLE, 1, (date_sub('hour', max(etl_loaded_at), TIMESTAMP '{NOW}') > 24)::INT FROM txn_core",
        rows("TXN-8", "TIMELINESS", "txn_core", "etl_loaded_at > txn_date::TIMESTAMP + INTERVAL 12 HOUR", 0.02, "WARNING"),
        uniq("CASE-1", "support_cases", "case_number"),
        rows("CASE-2", "VALIDITY", "support_cases", "priority NOT IN ('P1', 'P2', 'P3', 'P4')", 0.001),
        rows("CASE-3", "INTEGRITY", "support_cases", f"customer_key {known}", 0.001),
        uniq("DIM-1", "dim_customer", "customer_key"),
        uniq("DIM-2", "dim_customer", "customer_id"),
        rows("DIM-3", "COMPLETENESS", "dim_customer", "email IS NULL", 0.05, "WARNING"),
        uniq("OPS-1", "ops_events", "event_id"),
        rows("OPS-2", "VALIDITY", "ops_events", "source_system NOT IN ('GATEWAY', 'APP', 'BATCH')", 0.01, "WARNING"),
        rows("OPS-3", "VALIDITY", "ops_events", "latency_ms >= 3600000", 0.005, "WARNING"),
        rows("RUN-1", "VALIDITY", "pipeline_runs", "status NOT IN ('SUCCESS', 'FAILED')", 0),
        rows("RUN-2", "INTEGRITY", "pipeline_runs", "target_table NOT IN (SELECT table_id FROM table_catalog)", 0),
    ]
    return f"""raw_counts AS ({' UNION ALL '.join(parts)}),
      judged AS (SELECT *, CASE WHEN c > 0 THEN f / c ELSE 1.0::DOUBLE END AS rate, {r('CASE WHEN c > 0 THEN f / c ELSE 1.0::DOUBLE END', 6)} AS observed_value FROM raw_counts),
      results AS (SELECT *, if(rate > m, 'FAIL', 'PASS') AS status, CASE severity WHEN 'ERROR' THEN 1.0::DOUBLE WHEN 'WARNING' THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END AS w FROM judged),
      scores AS (SELECT table_id, {r('100 * (1 - sum(w * observed_value) / sum(w))', 2)} AS dq_score, count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS checks_passed,
        count(*) FILTER (status = 'FAIL') AS checks_failed, max(c) AS table_rows FROM results GROUP BY table_id)"""


SEED = _seed_oracle()


def _seed_results(t):
    return E.run_checks(t.spark, {n: getattr(t, n) for n in SEED_TABLES}, seed_rules(transactions="txn_core", as_of_ts=NOW))


@query("d11_run_checks", f"WITH {SEED} SELECT rule_id, table_id, dimension, severity, c::BIGINT AS rows_checked, f::BIGINT AS rows_failed, observed_value, status FROM results")
def _(t):
    return _seed_results(t).select("rule_id", "table_id", "dimension", "severity", "rows_checked", "rows_failed", "observed_value", "status")


@query("d12_sample_failures", "SELECT 'X' AS rule_id, txn_no::VARCHAR AS txn_no FROM txn_gaps WHERE customer_ref IS NULL ORDER BY txn_gaps.txn_no, product_key, account_key LIMIT 5")
def _(t):
    rule = Rule("X", "COMPLETENESS", "txn_gaps", "customer_ref")
    rows = E.sample_failures(t.txn_gaps, rule, ["txn_no", "product_key", "account_key"])
    return rows.select("rule_id", F.get_json_object("failing_row", "$.txn_no").alias("txn_no"))


@query(
    "d11_one_bad_rule",
    """SELECT 'GOOD' AS rule_id, count(*) AS rows_checked, count(*) FILTER (amount_usd < 0) AS rows_failed, if(count(*) FILTER (amount_usd < 0) > 0, 'FAIL', 'PASS') AS status FROM txn_core
       UNION ALL SELECT 'KEYS', count(txn_id), count(txn_id) - count(DISTINCT txn_id), if(count(txn_id) > count(DISTINCT txn_id), 'FAIL', 'PASS') FROM txn_core
       UNION ALL SELECT unnest(['CAST', 'GONE']), 0, -1, 'ERROR'""",
)
def _(t):
    """A cast that fails on the rows and a missing column among good rules."""
    condition = lambda text: {"condition": text}
    rules = [
        Rule("GOOD", "VALIDITY", "txn_core", "amount_usd", params=condition("amount_usd >= 0")), Rule("KEYS", "UNIQUENESS", "txn_core", "txn_id"),
        Rule("CAST", "VALIDITY", "txn_core", "txn_type", params=condition("CAST(txn_type AS INT) > 0")), Rule("GONE", "COMPLETENESS", "txn_core", "no_such_column"),
    ]
    return _check(t, rules).select(*COUNTS, "status")


@query("d12_sample_integrity", "SELECT 'X' AS rule_id, txn_no::VARCHAR AS txn_no FROM txn_gaps WHERE (customer_ref IS NULL OR customer_ref NOT IN (SELECT customer_key FROM dim_customer WHERE customer_key % 2 = 0)) AND txn_type = 'PAYMENT' ORDER BY txn_gaps.txn_no, product_key, account_key LIMIT 5")
def _(t):
    rule = Rule("X", "INTEGRITY", "txn_gaps", "customer_ref", params={"dim": "even", "dim_key": "k", "filter": "txn_type = 'PAYMENT'"})
    members = t.dim_customer.where("customer_key % 2 = 0").select(F.col("customer_key").alias("k"))
    rows = E.sample_failures(t.txn_gaps, rule, ["txn_no", "product_key", "account_key"], tables={"even": members})
    return rows.select("rule_id", F.get_json_object("failing_row", "$.txn_no").alias("txn_no"))


@query("d12_sample_uniqueness", "SELECT 'X' AS rule_id, txn_no::VARCHAR AS txn_no FROM txn_gaps WHERE txn_type = 'PAYMENT' AND customer_ref IN (SELECT customer_ref FROM txn_gaps WHERE txn_type = 'PAYMENT' GROUP BY 1 HAVING count(*) > 1) ORDER BY txn_gaps.txn_no, product_key, account_key LIMIT 5")
def _(t):
    rule = Rule("X", "UNIQUENESS", "txn_gaps", "customer_ref", params={"filter": "txn_type = 'PAYMENT'"})
    rows = E.sample_failures(t.txn_gaps, rule, ["txn_no", "product_key", "account_key"])
    return rows.select("rule_id", F.get_json_object("failing_row", "$.txn_no").alias("txn_no"))


@query("d19_seed_rules", f"WITH {SEED} SELECT rule_id, table_id, dimension, severity, c::BIGINT AS rows_checked, f::BIGINT AS rows_failed, status FROM results")
def _(t):
    """The seeded rules as a table, loaded from it and run."""
    stored = rule_table(t.spark, seed_rules(transactions="txn_core", as_of_ts=NOW))
    found = E.run_rule_table(t.spark, {n: getattr(t, n) for n in SEED_TABLES}, stored)
    return found.select("rule_id", "table_id", "dimension", "severity", "rows_checked", "rows_failed", "status")


@query("d13_persist_results", f"WITH {SEED} SELECT count(*) * 2 AS result_rows, 2::BIGINT AS runs, 1::BIGINT AS days FROM results")
def _(t):
    """Two runs appended to the result table; nothing of the first is lost."""
    from tidemark.loads.partitions import append_rows, read_table
    from tidemark.session import cut_lineage, run_dir

    path = run_dir(t.spark, "dq_results")
    results = cut_lineage(_seed_results(t))
    append_rows(E.stamped(results, "run-1", NOW), path, "run_date")
    append_rows(E.stamped(results, "run-2", NOW).withColumn("owner", F.lit("added later")), path, "run_date")
    saved = read_table(t.spark, path, merge_schema=True)
    return saved.agg(F.count("*").alias("result_rows"), F.count_distinct("run_id").alias("runs"), F.count_distinct("run_date").alias("days"))


@query("d14_score_tables", f"WITH {SEED} SELECT *, dq_score < 90 AS anomaly_flag FROM scores")
def _(t):
    return E.score_tables(_seed_results(t)).drop("by_dimension")


@query("d14_dimension_scores", f"WITH {SEED} SELECT table_id, dimension, {r('100 * (1 - sum(w * observed_value) / sum(w))', 2)} AS dimension_score FROM results GROUP BY ALL")
def _(t):
    return E.dimension_scores(_seed_results(t))


@query("d15_enterprise_score", f"WITH {SEED} SELECT {r('sum(dq_score * table_rows::DOUBLE) / sum(table_rows::DOUBLE)', 2)} AS enterprise_dq_score FROM scores WHERE table_id <> 'support_cases'")
def _(t):
    certified = t.spark.createDataFrame([(n,) for n in SEED_TABLES if n != "support_cases"], "table_id string")
    return E.enterprise_score(E.score_tables(_seed_results(t)), certified)


@query(
    "d16_health_rows",
    f"""WITH {SEED}, e AS (SELECT {r('sum(dq_score * table_rows::DOUBLE) / sum(table_rows::DOUBLE)', 2)} AS s, sum(checks_run)::BIGINT AS n FROM scores)
        SELECT concat('product of ', table_id) AS data_product_name, dq_score, checks_run FROM scores UNION ALL SELECT 'ENTERPRISE', s, n FROM e""",
)
def _(t):
    names = t.spark.createDataFrame([(n, f"product of {n}") for n in SEED_TABLES], "table_id string, data_product_name string")
    return E.health_rows(E.score_tables(_seed_results(t)), names, NOW).select("data_product_name", "dq_score", "checks_run")


@query("d17_alert_breaches", f"WITH {SEED} SELECT 'DQ' AS alert_type, 'HIGH' AS severity, table_id AS source_table, concat('DQ score ', dq_score::DECIMAL(6,2), ' on ', table_id) AS subject FROM scores WHERE dq_score < 90")
def _(t):
    return E.alert_breaches(E.score_tables(_seed_results(t)), NOW).select("alert_type", "severity", "source_table", "subject")


@query(
    "d18_promotion_gate",
    f"""WITH {SEED}, b AS (SELECT table_id, count(*) FILTER (severity = 'ERROR' AND status = 'FAIL') AS blocking_rules FROM results GROUP BY table_id)
        SELECT *, if(blocking_rules > 0, 'BLOCK', 'PUBLISH') AS decision FROM b""",
)
def _(t):
    return E.promotion_gate(_seed_results(t))


@query(
    "d20_rule_types",
    f"""SELECT 'R-1' AS rule_id, count(txn_id)::BIGINT AS rows_checked, (count(txn_id) - count(DISTINCT txn_id))::BIGINT AS rows_failed FROM transactions
        UNION ALL SELECT 'R-2', count(*), count(*) - count(amount_usd) FROM transactions
        UNION ALL SELECT 'R-3', 1, (date_sub('hour', max(etl_loaded_at), TIMESTAMP '{NOW}') > 15)::INT FROM transactions
        UNION ALL SELECT 'R-4', count(*), count(*) - count(email) FROM dim_customer
        UNION ALL SELECT 'R-5', 1, count(*) FILTER (n < 0.85 * a) FROM (SELECT txn_date, count(*) AS n, avg(count(*)) OVER (ORDER BY txn_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM transactions GROUP BY txn_date)
          WHERE txn_date = (SELECT max(txn_date) FROM transactions)
        UNION ALL SELECT 'R-6', count(*), count(*) FILTER (txn_type = 'CHARGEBACK') FROM transactions
        UNION ALL SELECT 'R-7', 12, 1
        UNION ALL SELECT 'R-8', count(txn_id), count(txn_id) - count(DISTINCT txn_id) FROM transactions""",
)
def _(t):
    """The application's rule types carried out by the same engine."""
    columns = [*[c for c in t.dim_customer.columns if c != "etl_loaded_at"]]
    rules = [
        Rule("R-1", RULE_TYPES["UNIQUE"], "transactions", "txn_id"),
        Rule("R-2", RULE_TYPES["NOT_NULL"], "transactions", "amount_usd"),
        Rule("R-3", RULE_TYPES["FRESHNESS"], "transactions", params={"timestamp": "etl_loaded_at", "hours": 15, "as_of": NOW}),
        Rule("R-4", RULE_TYPES["THRESHOLD"], "dim_customer", "email", max_rate=0.05),
        Rule("R-5", RULE_TYPES["VOLUME"], "transactions", params={"date": "txn_date", "ratio": 0.85, "rows": 7}),
        Rule("R-6", RULE_TYPES["APPROVAL_RATE"], "transactions", "txn_type", max_rate=0.025, params={"condition": "txn_type <> 'CHARGEBACK'"}),
        Rule("R-7", RULE_TYPES["SCHEMA"], "dim_customer", params={"columns": columns}),
        Rule("R-8", RULE_TYPES["DUPLICATE_RATIO"], "transactions", "txn_id", max_rate=0.005),
    ]
    return _check(t, rules).select(*COUNTS)


