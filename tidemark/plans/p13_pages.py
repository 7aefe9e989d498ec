"""KPI and page queries A1-A13."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.metrics import kpi as K
from tidemark.metrics import pages as A
from tidemark.metrics import views as V
from tidemark.plans.p10_warehouse import DAILY_CTE, DAY_JOINS, executive_daily
from tidemark.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, avg, div, pct, query, r

REV = "status = 'POSTED' AND amount_usd > 0 AND txn_type NOT IN ('REFUND', 'CHARGEBACK')"


@query("a1_kpi", f"SELECT bu_code, region_key, count(DISTINCT customer_key) AS value FROM transactions WHERE status = 'POSTED' AND txn_date >= DATE '{ORDERS_AS_OF}' - 90 GROUP BY ALL")
def _(t):
    return K.kpi(t.transactions, "customer_key", "COUNT DISTINCT", ["bu_code", "region_key"], "90d", ORDERS_AS_OF)


@query("a1_kpi_sum", f"SELECT channel_code, sum(amount_usd)::DOUBLE AS value FROM transactions WHERE status = 'POSTED' AND txn_date >= DATE '{ORDERS_AS_OF}' - 30 GROUP BY ALL")
def _(t):
    return K.kpi(t.transactions, "amount_usd", "SUM", ["channel_code"], "no such window", ORDERS_AS_OF)


_M = f"status = 'POSTED' AND txn_date BETWEEN DATE '{ORDERS_AS_OF}' - 30 AND DATE '{ORDERS_AS_OF}'"
_W = f"BETWEEN DATE '{ORDERS_AS_OF}' - 7 AND DATE '{ORDERS_AS_OF}'"
_VALUES = f"""kv AS (
  SELECT 'KPI-001' AS kpi_id, sum(amount_usd) FILTER ({_M} AND amount_usd > 0)::DOUBLE AS v FROM transactions
  UNION ALL SELECT 'KPI-002', sum(amount_usd) FILTER ({_M})::DOUBLE / count(*) FILTER ({_M}) FROM transactions
  UNION ALL SELECT 'KPI-003', count(DISTINCT customer_key) FILTER ({_M}) FROM transactions
  UNION ALL SELECT 'KPI-004', 100 * count(*) FILTER (resolved_at <= sla_due_at)::DOUBLE / count(*) FROM support_cases WHERE opened_date {_W}
  UNION ALL SELECT 'KPI-005', sum(dq_score)::DOUBLE / count(*) FROM dq_health WHERE score_date = DATE '{ORDERS_AS_OF}'
  UNION ALL SELECT 'KPI-006', 100 * count(*) FILTER (status = 'FAILURE')::DOUBLE / count(*) FROM ops_events WHERE event_date BETWEEN DATE '{EVENTS_AS_OF}' - 1 AND DATE '{EVENTS_AS_OF}'
  UNION ALL SELECT 'KPI-007', sum(cost_usd)::DOUBLE FROM query_cost WHERE job_date = DATE '{ORDERS_AS_OF}'
  UNION ALL SELECT 'KPI-008', 100 * count(*) FILTER (status = 'SUCCESS')::DOUBLE / count(*) FROM pipeline_runs WHERE run_date {_W}
  UNION ALL SELECT 'KPI-009', 100 * sum(amount_usd * margin_pct)::DOUBLE / sum(amount_usd)::DOUBLE FROM transactions JOIN (SELECT product_key, margin_pct FROM dim_product WHERE is_current) USING (product_key) WHERE {_M}
  UNION ALL SELECT 'KPI-010', 100 * count(*) FILTER (txn_type = 'CHARGEBACK')::DOUBLE / count(*) FROM transactions WHERE txn_date {_W}
  UNION ALL SELECT 'KPI-011', date_sub('minute', max(etl_loaded_at), TIMESTAMP '{ORDERS_AS_OF} 00:00:00') FROM transactions)"""
_LIMITS = ", ".join(f"('{s.kpi_id}', '{s.name}', '{s.unit}', {str(s.higher_is_better).lower()}, {s.breach}::DOUBLE, {s.warn}::DOUBLE)" for s in K.CERTIFIED)


@query(
    "a2_certified_kpis",
    f"""WITH {_VALUES}, j AS (SELECT kpi_id, name, unit, {r('v', 2)} AS value, hi, b, w FROM kv JOIN (VALUES {_LIMITS}) s(kpi_id, name, unit, hi, b, w) USING (kpi_id))
        SELECT kpi_id, name, unit, value, CASE WHEN value IS NULL THEN NULL WHEN if(hi, value < b, value > b) THEN 'BREACH' WHEN if(hi, value < w, value > w) THEN 'WARNING' ELSE 'ON_TRACK' END AS kpi_state FROM j""",
)
def _(t):
    names = ["transactions", "dim_product", "support_cases", "dq_health", "ops_events", "query_cost", "pipeline_runs"]
    return K.certified_kpis({n: getattr(t, n) for n in names}, ORDERS_AS_OF, EVENTS_AS_OF)


@query(
    "a3_kpi_status",
    f"""WITH m AS (SELECT opened_date, {pct('count(*) FILTER (resolved_at <= sla_due_at)', 'count(*)')} AS v FROM support_cases GROUP BY opened_date)
        SELECT opened_date, v AS value, CASE WHEN v < 20 THEN 'BREACH' WHEN v < 40 THEN 'WARNING' ELSE 'ON_TRACK' END AS kpi_state FROM m""",
)
def _(t):
    from tidemark.functions import count_where, percent

    daily = t.support_cases.groupBy("opened_date").agg(percent(count_where(F.col("resolved_at") <= F.col("sla_due_at")), F.count("*")).alias("value"))
    return daily.withColumn("kpi_state", K.kpi_status(F.col("value"), F.lit(20), F.lit(40), F.lit(True)))


KNOWN = ["txn_id", "customer_id", "amount_usd", "txn_type", "status"]
_ISSUES = """n AS (SELECT *, try_cast(amount_usd AS DOUBLE) AS v FROM upload), f AS (SELECT txn_id, min(row_no) AS lo FROM upload GROUP BY txn_id),
  issues AS (SELECT 1::BIGINT AS row_no, 'error' AS severity, 'SCHEMA' AS category
    UNION ALL SELECT row_no, 'error', 'MISSING_VALUE' FROM n WHERE trim(customer_id) = ''
    UNION ALL SELECT row_no, 'error', 'BUSINESS_RULE' FROM n WHERE v < 0 AND txn_type NOT IN ('REFUND', 'CHARGEBACK')
    UNION ALL SELECT row_no, 'error', 'BUSINESS_RULE' FROM n WHERE status = 'weird'
    UNION ALL SELECT row_no, 'warning', 'OUTLIER' FROM n WHERE abs(v) > 50000
    UNION ALL SELECT row_no, 'warning', 'DUPLICATE' FROM upload JOIN f USING (txn_id) WHERE row_no > lo)"""


@query("a4_validate_csv", f"WITH {_ISSUES} FROM issues")
def _(t):
    return A.validate_rows(t.upload, KNOWN, ["txn_id", "customer_id"]).select("row_no", "severity", "category")


@query("a4_issue_counts", f"WITH {_ISSUES} SELECT category, severity, count(*) AS issues FROM issues GROUP BY ALL")
def _(t):
    return A.issue_counts(A.validate_rows(t.upload, KNOWN, ["txn_id", "customer_id"]))


_Q = "green economy"


@query(
    "a5_catalog_search",
    f"""WITH e AS (SELECT 'dataset' AS kind, table_name AS title, [table_name, description, data_product_name, data_owner] AS fields, 1.0::DOUBLE AS weight FROM table_catalog
          UNION ALL SELECT 'column', column_name, [column_name, data_type], 0.9::DOUBLE FROM column_catalog),
        f AS (SELECT kind, title, weight, lower(unnest(fields)) AS x FROM e),
        s AS (SELECT kind, title, max(weight * CASE WHEN x = '{_Q}' THEN 100 WHEN starts_with(x, '{_Q}') THEN 80 WHEN contains(x, '{_Q}') THEN 60 ELSE (contains(x, 'green')::INT + contains(x, 'economy')::INT) / 2 * 45 END::DOUBLE) AS sc FROM f GROUP BY kind, title)
        SELECT kind, title, {r('sc', 4)} AS score FROM s WHERE sc > 0 ORDER BY score DESC, kind, title LIMIT 40""",
)
def _(t):
    tables = t.table_catalog.select(
        F.lit("dataset").alias("kind"), F.col("table_name").alias("title"), F.array("table_name", "description", "data_product_name", "data_owner").alias("fields"), F.lit(1.0).alias("weight")
    )
    columns = t.column_catalog.select(F.lit("column").alias("kind"), F.col("column_name").alias("title"), F.array("column_name", "data_type").alias("fields"), F.lit(0.9).alias("weight"))
    return A.catalog_search(tables.unionByName(columns), "Green  Economy".replace("  ", " "))


@query(
    "a6_cost_insights",
    f"""WITH x AS (SELECT cost_usd AS c, date_diff('day', job_date, DATE '{ORDERS_AS_OF}') AS age FROM query_cost WHERE date_diff('day', job_date, DATE '{ORDERS_AS_OF}') BETWEEN 0 AND 29),
        y AS (SELECT sum(c) AS s, coalesce(sum(c) FILTER (age < 7), 0)::DOUBLE AS wk, coalesce(sum(c) FILTER (age >= 7), 0)::DOUBLE / 23 AS b FROM x)
        SELECT {r('s', 2)} AS total_30d, {r('s::DOUBLE / 30', 2)} AS avg_daily, {r('b', 2)} AS baseline, {r('wk - b * 7', 2)} AS overrun FROM y""",
)
def _(t):
    return A.cost_insights(t.query_cost, ORDERS_AS_OF)


@query(
    "a6_cost_breakdown",
    f"""SELECT 'user' AS kind, user_email AS label, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY ALL
        UNION ALL SELECT 'dataset', dataset_id, {r('sum(cost_usd)', 2)} FROM query_cost GROUP BY ALL
        UNION ALL SELECT 'team', query_labels->>'$.team', {r('sum(cost_usd)', 2)} FROM query_cost GROUP BY ALL""",
)
def _(t):
    return A.cost_breakdown(t.query_cost)


@query(
    "a7_run_status",
    f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY run_started_at DESC, run_id DESC) AS pos, count(*) OVER (PARTITION BY pipeline_name) AS runs FROM pipeline_runs)
        SELECT pipeline_name, if(bool_or(status = 'FAILED'), 'DEGRADED', 'HEALTHY') AS job_state, {pct("count(*) FILTER (status = 'SUCCESS')", 'count(*)', 0)} AS success_rate,
          string_agg(concat(status, ':', rows_written), ',' ORDER BY pos DESC) AS history, any_value(runs) AS runs FROM n WHERE pos <= 7 GROUP BY pipeline_name""",
)
def _(t):
    from tidemark.operators.documents import text_of

    return A.run_status(t.pipeline_runs).withColumn("history", text_of("history", ["status", "rows_written"]))


@query(
    "a8_executive_kpis",
    f"""WITH x AS (SELECT t.*, margin_pct FROM transactions t LEFT JOIN (SELECT product_key, margin_pct FROM dim_product WHERE is_current) USING (product_key)),
        m AS (SELECT sum(amount_usd) FILTER ({REV}) AS g, sum(amount_usd) FILTER (txn_type = 'REFUND') AS rf, sum(amount_usd) FILTER (txn_type = 'CHARGEBACK') AS cb,
          sum(amount_usd * margin_pct) FILTER ({REV}) AS p, count(DISTINCT customer_key) FILTER (status = 'POSTED') AS n, count(*) FILTER (status = 'POSTED') AS k FROM x)
        SELECT g::DOUBLE AS gmv, (g - rf - cb)::DOUBLE AS net, {pct('p', 'g')} AS margin_pct, n AS active_customers, {div('g', 'k', 2)} AS aov,
          (SELECT {pct("count(*) FILTER (status = 'FAILURE')", 'count(*)')} FROM ops_events WHERE event_date BETWEEN DATE '{EVENTS_AS_OF}' - 6 AND DATE '{EVENTS_AS_OF}') AS error_rate_pct,
          (SELECT {pct('count(*) FILTER (resolved_at <= sla_due_at)', 'count(*)')} FROM support_cases) AS sla_pct,
          (SELECT {avg('dq_score', 2)} FROM dq_health WHERE score_date = (SELECT max(score_date) FROM dq_health)) AS dq_score,
          (SELECT {div('sum(cost_usd)', '(sum(bytes_processed) / (1024 * 1e9))')} FROM query_cost) AS cost_per_tb FROM m""",
)
def _(t):
    return A.executive_kpis(t.txn_core, t.dim_product, t.ops_events, t.support_cases, t.dq_health, t.query_cost, ORDERS_AS_OF, EVENTS_AS_OF, None)


@query(
    "a9_bu_breakdown",
    f"""WITH x AS (SELECT t.*, margin_pct FROM transactions t LEFT JOIN (SELECT product_key, margin_pct FROM dim_product WHERE is_current) USING (product_key)),
        b AS (SELECT bu_code, coalesce(sum(amount_usd) FILTER ({REV}), 0) AS g, count(*) FILTER ({REV}) AS orders, count(DISTINCT customer_key) FILTER (status = 'POSTED') AS active,
          sum(amount_usd * margin_pct) FILTER ({REV}) AS p FROM x GROUP BY bu_code)
        SELECT bu_code, g::DOUBLE AS gmv, orders, active, {div('g', 'orders', 2)} AS aov, {pct('p', 'g')} AS margin_pct, {pct('g', '(SELECT sum(g) FROM b)', 1)} AS share_pct FROM b""",
)
def _(t):
    return A.bu_breakdown(t.transactions, t.dim_product, ORDERS_AS_OF, days=None)


@query(
    "a9_revenue_mix",
    f"""WITH x AS (SELECT t.*, product_category, region_name FROM transactions t JOIN dim_region USING (region_key) LEFT JOIN (SELECT product_key, product_category FROM dim_product WHERE is_current) USING (product_key) WHERE {REV})
        SELECT 'category' AS mix, product_category AS label, sum(amount_usd)::DOUBLE AS gmv FROM x GROUP BY ALL UNION ALL SELECT 'channel', channel_code, sum(amount_usd)::DOUBLE FROM x GROUP BY ALL
        UNION ALL SELECT 'region', region_name, sum(amount_usd)::DOUBLE FROM x GROUP BY ALL""",
)
def _(t):
    return A.revenue_mix(t.transactions.join(t.dim_region, "region_key"), t.dim_product, ORDERS_AS_OF, days=None)


@query(
    "a10_quality_summary",
    f"""SELECT {avg('dq_score', 2)} AS enterprise_score, sum(checks_run)::BIGINT AS checks_run, sum(checks_failed)::BIGINT AS checks_failed, {pct('sum(checks_failed)', 'sum(checks_run)')} AS failed_check_pct
        FROM dq_health WHERE score_date = (SELECT max(score_date) FROM dq_health)""",
)
def _(t):
    return A.quality_summary(t.dq_health)


@query(
    "a11_cost_page",
    f"""SELECT {r('sum(cost_usd)', 2)} AS total_cost, {div('sum(cost_usd)', '(sum(bytes_processed) / (1024 * 1e9))')} AS cost_per_tb, {pct('count(*) FILTER (cache_hit)', 'count(*)')} AS cache_rate,
        {r("sum(cost_usd) FILTER (user_email = 'user7' AND job_date >= DATE '2001-01-01')", 2)} AS runaway_cost FROM query_cost""",
)
def _(t):
    return A.cost_page(t.query_cost, "user7", "2001-01-01")


# The sample queries, as plain SQL over the session's tables.
SAMPLES = {
    "top_buyers": ("SELECT customer_key, sum(amount_usd) AS spend FROM {transactions} WHERE status = 'POSTED' AND amount_usd > 0 GROUP BY customer_key ORDER BY spend DESC, customer_key LIMIT 10", "spend"),
    "gmv_by_region": ("SELECT region_key, sum(amount_usd) AS gmv FROM {transactions} WHERE status = 'POSTED' AND amount_usd > 0 GROUP BY region_key", "gmv"),
    "category_customers": ("SELECT p.product_category, sum(t.amount_usd) AS gmv, count(DISTINCT t.customer_key) AS customers FROM {transactions} t JOIN {dim_product} p ON p.product_key = t.product_key AND p.is_current WHERE t.status = 'POSTED' GROUP BY p.product_category", "gmv"),
    "channels": ("SELECT channel_code, count(*) AS txns, sum(amount_usd) AS amount FROM {transactions} WHERE status = 'POSTED' GROUP BY channel_code", "amount"),
    "refunds_by_channel": ("SELECT channel_code, abs(sum(amount_usd)) AS refunds FROM {transactions} WHERE txn_type = 'REFUND' GROUP BY channel_code ORDER BY refunds DESC LIMIT 5", "refunds"),
    "latest_scores": ("SELECT data_product_name, dq_score FROM {dq_health} WHERE score_date = (SELECT max(score_date) FROM {dq_health})", "dq_score"),
    "cost_users": ("SELECT user_email, sum(cost_usd) AS spend FROM {query_cost} GROUP BY user_email ORDER BY spend DESC, user_email LIMIT 5", "spend"),
    "runs_by_state": ("SELECT pipeline_name, status, count(*) AS runs FROM {pipeline_runs} GROUP BY pipeline_name, status", None),
    "gmv_trend": ("SELECT txn_date, sum(amount_usd) AS gmv FROM {transactions} WHERE status = 'POSTED' GROUP BY txn_date", "gmv"),
    "tiers": ("SELECT tier, count(*) AS customers FROM {dim_customer} GROUP BY tier", None),
}
_SOURCES = ("transactions", "dim_product", "dq_health", "query_cost", "pipeline_runs", "dim_customer")


def _sample(name: str, text: str, money: str | None) -> None:
    plain = text.format(**{s: s for s in _SOURCES})
    oracle = f"SELECT * REPLACE ({money}::DOUBLE AS {money}) FROM ({plain})" if money else plain
    used = [s for s in _SOURCES if "{" + s + "}" in text]
    query(f"a12_{name}", oracle)(lambda t: t.spark.sql(text, **{s: getattr(t, s) for s in used}))


for _name, (_text, _money) in SAMPLES.items():
    _sample(_name, _text, _money)


def _overview(t):
    return V.executive_overview(executive_daily(t), t.dq_health, t.pipeline_runs, t.query_cost)


@query("a13_sheet_gmv", f"WITH {DAILY_CTE} SELECT metric_date, bu_name, sum(gmv_usd::DECIMAL(28,2))::DOUBLE AS gmv_usd FROM v1 GROUP BY ALL")
def _(t):
    return A.sheet_gmv(executive_daily(t))


@query("a13_sheet_days", f"WITH {DAILY_CTE} SELECT metric_date, sum(active_customers)::BIGINT AS active_customers, any_value(dq_score) AS dq_score, any_value(cost_usd) AS cost_usd FROM v1 {DAY_JOINS} GROUP BY metric_date")
def _(t):
    return A.sheet_days(_overview(t))


@query("src_csv_upload", "SELECT txn_id, customer_id, amount_usd, txn_type, status, promo FROM upload")
def _(t):
    """The upload written as CSV and read back as text columns; blanks and bad numbers stay as they are."""
    from tidemark.session import run_dir
    from tidemark.sources import files

    columns = ["txn_id", "customer_id", "amount_usd", "txn_type", "status", "promo"]
    folder = run_dir(t.spark, "csv")
    t.upload.select(*columns).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return files.read_csv(t.spark, folder, columns).drop(files.CORRUPT)


@query("src_json_orders", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL::VARCHAR AS added_later FROM orders")
def _(t):
    """Orders as JSON lines, read with a schema that has one field more."""
    from tidemark.session import run_dir
    from tidemark.sources import files

    folder = run_dir(t.spark, "json")
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.json(folder)
    return files.read_json(t.spark, folder, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, added_later STRING")
