"""Views V1-V4, pre-aggregates M1-M4, procedures P1-P4, loads L1-L4 and SQ3-SQ6."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import day_literal
from tidemark.loads import partitions as P
from tidemark.loads import scd
from tidemark.loads.dim_date import build_dim_date, date_bounds
from tidemark.metrics import views as V
from tidemark.operators import alerts as A
from tidemark.plans.p01_windows import GMV
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import ORDERS_AS_OF, avg, div, pct, query, r
from tidemark.session import run_dir

DAILY_CTE = f"""kpi AS (SELECT txn_date AS metric_date, bu_code, region_key, count(*) FILTER ({GMV}) AS txn_count, count(DISTINCT customer_key) FILTER ({GMV}) AS active_customers,
    coalesce(sum(amount_usd) FILTER ({GMV}), 0)::DOUBLE AS gmv_usd, coalesce(sum(abs(amount_usd)) FILTER (txn_type = 'REFUND'), 0)::DOUBLE AS refunds_usd,
    {div(f'coalesce(sum(amount_usd) FILTER ({GMV}), 0)', f'count(*) FILTER ({GMV})', 2)} AS avg_order_value_usd, {div('sum(amount_usd * margin_pct)', 'sum(amount_usd)')} AS blended_margin_rate
    FROM transactions LEFT JOIN (SELECT product_key, margin_pct FROM dim_product WHERE is_current) USING (product_key) GROUP BY txn_date, bu_code, region_key),
  v1 AS (SELECT metric_date, bu_code, bu_name, region_key, region_name, txn_count, active_customers, gmv_usd, refunds_usd, avg_order_value_usd, blended_margin_rate
    FROM kpi JOIN dim_business_unit USING (bu_code) JOIN dim_region USING (region_key)),
  dq_day AS (SELECT score_date AS metric_date, {avg('dq_score', 4)} AS dq_score FROM dq_health GROUP BY score_date),
  run_day AS (SELECT run_date AS metric_date, max(date_sub('hour', run_started_at, run_finished_at)) AS freshness_hours FROM pipeline_runs GROUP BY run_date),
  cost_day AS (SELECT job_date AS metric_date, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY job_date)"""
DAY_JOINS = "LEFT JOIN dq_day USING (metric_date) LEFT JOIN run_day USING (metric_date) LEFT JOIN cost_day USING (metric_date)"


def executive_daily(t) -> DataFrame:
    return V.executive_daily(t.transactions, t.dim_business_unit, t.dim_region, t.dim_product)


@query("v1_executive_daily", f"WITH {DAILY_CTE} FROM v1")
def _(t):
    return executive_daily(t)


@query(
    "v2_executive_overview",
    f"""WITH {DAILY_CTE} SELECT metric_date, bu_name, region_name, txn_count, active_customers, gmv_usd, avg_order_value_usd, blended_margin_rate, dq_score, freshness_hours, cost_usd FROM v1 {DAY_JOINS}""",
)
def _(t):
    return V.executive_overview(executive_daily(t), t.dq_health, t.pipeline_runs, t.query_cost)


@query(
    "v3_customer_360",
    f"""WITH a AS (SELECT customer_key, count(*) AS total_txns, sum(amount_usd) AS v, max(txn_date) AS last_txn_date, date_diff('day', max(txn_date), DATE '{ORDERS_AS_OF}')::INT AS d,
          count(DISTINCT account_key) AS account_count FROM txn_core WHERE {GMV} GROUP BY customer_key),
        o AS (SELECT customer_key, count(*) AS n FROM support_cases WHERE status = 'OPEN' GROUP BY customer_key)
        SELECT customer_key, customer_id, full_name, customer_segment, tier, is_active, total_txns, v::DOUBLE AS lifetime_value_usd, last_txn_date, d AS days_since_last_txn, account_count,
          (ntile(4) OVER (ORDER BY v DESC, customer_key))::INT AS value_quartile, (ntile(4) OVER (ORDER BY d, customer_key))::INT AS recency_quartile, coalesce(n, 0) AS open_cases,
          CASE WHEN d <= 30 THEN 'ACTIVE' WHEN d <= 90 THEN 'AT_RISK' WHEN d <= 180 THEN 'DORMANT' ELSE 'LAPSED' END AS engagement_status
        FROM dim_customer JOIN a USING (customer_key) LEFT JOIN o USING (customer_key)""",
)
def _(t):
    return V.customer_360(t.dim_customer, t.txn_core, t.support_cases, ORDERS_AS_OF)


@query(
    "v4_platform_health",
    f"""SELECT run_date, {pct("count(*) FILTER (status = 'SUCCESS')", 'count(*)')} AS run_success_rate, count(*) FILTER (status = 'FAILED') AS run_failures,
        {avg('coalesce(dq_score, 100)', 2)} AS avg_dq_score, {pct('count(*) FILTER (dq_passed)', 'count(*)')} AS dq_pass_rate, count(*) FILTER (run_finished_at IS NULL) AS still_running
        FROM pipeline_runs GROUP BY run_date""",
)
def _(t):
    return V.platform_health(t.pipeline_runs)


M1 = f"SELECT txn_date AS metric_date, bu_code, count(*) AS txn_count, count(DISTINCT customer_key) AS active_customers, sum(amount_usd)::DOUBLE AS gmv_usd FROM transactions WHERE {GMV} GROUP BY ALL"


@query("m1_daily_gmv_by_bu", M1)
def _(t):
    return V.daily_gmv_by_bu(t.transactions)


@query("m1_daily_gmv_refreshed", M1)
def _(t):
    """The same aggregate reached by one build and one refresh of the days touched by later batches."""
    path = run_dir(t.spark, "daily_gmv")
    loaded_late = F.col("etl_batch_id") == 4049
    P.write_by_month(V.daily_gmv_by_bu(t.transactions.where(~loaded_late)), path, "metric_date", ["bu_code"])
    P.refresh_days(t.transactions, "txn_date", t.transactions.where(loaded_late), V.daily_gmv_by_bu, path, "metric_date")
    return P.read_table(t.spark, path).select("metric_date", "bu_code", "txn_count", "active_customers", "gmv_usd")


@query("m1_read_within_staleness", M1)
def _(t):
    """Built before the last loads and read an hour past its limit: the days touched since come from the base."""
    path = run_dir(t.spark, "daily_gmv")
    loaded = F.col("etl_loaded_at")
    until = t.transactions.agg(F.date_sub(F.max(loaded).cast("date"), 30).cast("string")).first()[0]  # one value
    P.write_by_month(V.daily_gmv_by_bu(t.transactions.where(loaded.cast("timestamp") <= F.lit(until).cast("timestamp"))), path, "metric_date", ["bu_code"])
    P.record_build(t.spark, path, "2030-01-01 00:00:00", until)
    return P.read_within(t.transactions, "txn_date", "etl_loaded_at", V.daily_gmv_by_bu, path, "metric_date", "2030-01-01 02:00:00", 60)


ROLLING = f"""SELECT bu_code, d AS window_days, count(DISTINCT customer_key) AS active_customers FROM transactions, (VALUES (7), (30), (90)) AS w(d)
       WHERE {GMV} AND txn_date > DATE '{ORDERS_AS_OF}' - d AND txn_date <= DATE '{ORDERS_AS_OF}' GROUP BY ALL"""


@query("m1_rolling_customers", ROLLING)
def _(t):
    """Built without the late rows, then added to; the report reads the stored bitmaps alone."""
    path, whole = run_dir(t.spark, "bitmaps"), run_dir(t.spark, "bitmaps")
    loaded_late = F.col("etl_batch_id") == 4049
    P.write_by_month(V.customer_bitmaps(t.transactions.where(~loaded_late)), path, "metric_date", ["bu_code"])
    added = V.add_bitmaps(P.read_table(t.spark, path), V.customer_bitmaps(t.transactions.where(loaded_late)))
    P.write_by_month(added, whole, "metric_date", ["bu_code"])
    return V.rolling_customers(P.read_table(t.spark, whole), ORDERS_AS_OF)


@query(
    "m2_hourly_ops_events",
    f"""SELECT event_date, date_trunc('hour', event_timestamp) AS event_hour, source_system, event_type, count(*) AS event_count, {avg('latency_ms', 0)} AS avg_latency_ms,
        count(*) FILTER (status = 'FAILURE') AS failures FROM ops_events GROUP BY ALL""",
)
def _(t):
    return V.hourly_ops_events(t.ops_events)


@query(
    "m3_daily_cost_by_user",
    f"""SELECT job_date, user_email, dataset_id, count(*) AS query_count, {r('sum(bytes_processed) / 1e12', 3)} AS terabytes_processed, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY ALL""",
)
def _(t):
    return V.daily_cost_by_user(t.query_cost)


@query("m4_dq_trend", f"SELECT score_date, data_product_name, {avg('dq_score', 4)} AS dq_score, sum(checks_failed)::BIGINT AS checks_failed FROM dq_health GROUP BY ALL")
def _(t):
    return V.dq_trend_daily(t.dq_health)


def _refreshed(t, base: DataFrame, day: str, late, view, out_day: str, cluster: list[str]) -> DataFrame:
    """Built without the late rows and with rows since deleted, then refreshed on the days of both."""
    path = run_dir(t.spark, "refreshed")
    stale = base.withColumn(day, F.date_add(day, 40000)).where(F.pmod(F.xxhash64(*base.columns), F.lit(3)) == 0)
    P.write_by_month(view(base.where(~late).unionByName(stale)), path, out_day, cluster)
    P.refresh_days(base, day, base.where(late).unionByName(stale), view, path, out_day)
    return P.read_table(t.spark, path).drop(P.MONTH)


@query("m3_daily_cost_refreshed", f"""SELECT job_date, user_email, dataset_id, count(*) AS query_count, {r('sum(bytes_processed) / 1e12', 3)} AS terabytes_processed, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY ALL""")
def _(t):
    return _refreshed(t, t.query_cost, "job_date", F.dayofmonth("job_date") % 2 == 0, V.daily_cost_by_user, "job_date", ["user_email"])


@query("m4_dq_trend_refreshed", f"SELECT score_date, data_product_name, {avg('dq_score', 4)} AS dq_score, sum(checks_failed)::BIGINT AS checks_failed FROM dq_health GROUP BY ALL")
def _(t):
    return _refreshed(t, t.dq_health, "score_date", F.dayofmonth("score_date") % 2 == 0, V.dq_trend_daily, "score_date", ["data_product_name"])


@query(
    "p1_dim_date",
    """WITH b AS (SELECT min(txn_date) AS lo, max(txn_date) AS hi FROM txn_core), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS k FROM b),
       f AS (SELECT *, (k - INTERVAL 1 MONTH)::DATE AS s FROM d)
       SELECT k AS date_key, k AS date_iso, dayofweek(k)::INT AS day_of_week, dayname(k) AS day_name, day(k)::INT AS day_of_month, dayofyear(k)::INT AS day_of_year,
         strftime(k, '%U')::INT AS week_of_year, (k - dayofweek(k)::INT)::DATE AS week_start_date, month(k)::INT AS month_number, monthname(k) AS month_name, year(k)::INT AS year,
         quarter(k)::INT AS quarter, concat('Q', quarter(k)) AS quarter_name, dayofweek(k) IN (0, 6) AS is_weekend, day(k + 1) = 1 AS is_month_end,
         day(k + 1) = 1 AND month(k) IN (3, 6, 9, 12) AS is_quarter_end, strftime(k, '%m-%d') = '12-31' AS is_year_end, false AS is_holiday, NULL::VARCHAR AS holiday_name,
         year(s)::INT AS fiscal_year, quarter(s)::INT AS fiscal_quarter, concat('FY', year(s), '-P0', quarter(s)) AS fiscal_period FROM f""",
)
def _(t):
    return build_dim_date(date_bounds(t.txn_core, "txn_date"))


ATTRS = ["full_name", "customer_segment", "tier", "is_active"]
RUN_TS = "2001-08-01 06:00:00"
BATCH = f"batch AS (FROM customer_cdc WHERE NOT full_load_flag AND effective_from <= TIMESTAMP '{RUN_TS}')"
CHANGED = "(d.full_name, d.customer_segment, d.tier, d.is_active) IS DISTINCT FROM (b.full_name, b.customer_segment, b.tier, b.is_active)"
CARRIED = ["email", "country"]
L1_ROWS = f"""{BATCH}, old_rows AS (SELECT d.customer_id, d.full_name, d.customer_segment, d.tier, d.is_active, concat(d.customer_id, '@old') AS email, 'C1' AS country, b.customer_id IS NOT NULL AND {CHANGED} AS ch FROM dim_customer d LEFT JOIN batch b USING (customer_id)),
  new_rows AS (SELECT b.* FROM batch b LEFT JOIN dim_customer d USING (customer_id) WHERE d.customer_id IS NULL OR {CHANGED}),
  loaded AS (SELECT customer_id, full_name, customer_segment, tier, is_active, email, country, TIMESTAMP '1995-01-01 00:00:00' AS valid_from, CASE WHEN ch THEN TIMESTAMP '{RUN_TS}' END AS valid_to, NOT ch AS is_current FROM old_rows
    UNION ALL SELECT customer_id, full_name, customer_segment, tier, is_active, concat(customer_id, '@new'), 'C2', TIMESTAMP '{RUN_TS}', NULL, true FROM new_rows)"""


DEFAULTS = {"is_active": True}


def _with_contact(df: DataFrame, mark: str, country: str) -> DataFrame:
    """Columns that versions carry along without being compared."""
    return df.withColumn("email", F.concat("customer_id", F.lit(mark))).withColumn("country", F.lit(country))


def _customer_dim(t) -> DataFrame:
    return scd.initial_dimension(_with_contact(t.dim_customer, "@old", "C1"), "customer_id", "customer_key", ATTRS, "1995-01-01 00:00:00", CARRIED, DEFAULTS)


def _loaded_customers(t) -> DataFrame:
    """The batch holds an outdated change of every member besides the newest one."""
    batch = _with_contact(scd.incremental(t.customer_cdc, RUN_TS), "@new", "C2")
    outdated = batch.withColumn("tier", F.lit("outdated")).withColumn("effective_from", F.col("effective_from") - F.expr("INTERVAL 1 DAY"))
    return scd.scd2_load(_customer_dim(t), outdated.unionByName(batch), "customer_id", "customer_key", ATTRS, RUN_TS, CARRIED, DEFAULTS, "effective_from")


@query("l1_scd2_customer", f"WITH {L1_ROWS} FROM loaded")
def _(t):
    return _loaded_customers(t).select("customer_id", *ATTRS, *CARRIED, "valid_from", "valid_to", "is_current")


@query("l1_scd2_customer_keys", f"WITH {L1_ROWS} SELECT count(*) AS row_count, count(*) AS key_count, 0::BIGINT AS lowest, count(*) - 1 AS highest FROM loaded")
def _(t):
    """Surrogate keys are unique and without gaps."""
    return _loaded_customers(t).agg(
        F.count("*").alias("row_count"), F.count_distinct("customer_key").alias("key_count"),
        F.min("customer_key").alias("lowest"), F.max("customer_key").alias("highest"),
    )


@query(
    "p2_logged_load",
    f"""WITH {L1_ROWS}, n AS (SELECT (SELECT count(*) FROM dim_customer) AS a, (SELECT count(*) FROM loaded) AS b)
        SELECT 'SCD2_CUSTOMER' AS pipeline_name, 'SUCCESS' AS status, a AS rows_read, b AS rows_written, b - a AS row_count_delta, 100.0::DOUBLE AS dq_score, false AS has_error FROM n
        UNION ALL SELECT 'SCD2_CUSTOMER_BAD', 'FAILED', a, NULL, NULL, NULL, true FROM n""",
)
def _(t):
    """One load that works and one that fails while it runs; both leave a row."""
    log, target = run_dir(t.spark, "run_log"), run_dir(t.spark, "dim_customer")
    no_nulls = lambda df: 100.0 * (1 - df.where("customer_id IS NULL").count() / max(1, df.count()))
    scd.logged_load("SCD2_CUSTOMER", "core.dim_customer", _customer_dim(t), lambda: _loaded_customers(t), target, RUN_TS, log, no_nulls)
    broken = lambda: _loaded_customers(t).withColumn("tier", F.raise_error(F.lit("source is broken")).cast("string"))
    try:
        scd.logged_load("SCD2_CUSTOMER_BAD", "core.dim_customer", _customer_dim(t), broken, run_dir(t.spark, "broken"), RUN_TS, log)
    except Exception as failure:
        if "source is broken" not in str(failure):
            raise
    return P.read_table(t.spark, log).select("pipeline_name", "status", "rows_read", "rows_written", "row_count_delta", "dq_score", F.col("error_message").isNotNull().alias("has_error"))


@query("p3_recompute_kpis", f"WITH {DAILY_CTE} SELECT metric_date, bu_code, region_key, txn_count, active_customers, gmv_usd, refunds_usd, avg_order_value_usd, blended_margin_rate, dq_score, freshness_hours, cost_usd FROM v1 {DAY_JOINS}")
def _(t):
    """A table with outdated rows in a window, brought right by recomputing the window."""
    kpis = V.with_day_measures(executive_daily(t), t.dq_health, t.pipeline_runs, t.query_cost).drop("bu_name", "region_name")
    first, last = "2001-01-01", ORDERS_AS_OF
    in_window = F.col("metric_date").between(day_literal(first), day_literal(last))
    path = run_dir(t.spark, "kpi_daily")
    outdated = kpis.withColumn("gmv_usd", F.when(in_window, F.lit(-1)).otherwise(F.col("gmv_usd")))
    P.write_by_month(outdated, path, "metric_date", ["bu_code"])
    P.replace_window(kpis, path, "metric_date", first, last)
    return P.read_table(t.spark, path).select(*kpis.columns)


@query(
    "p4_reprocess_partitions",
    """SELECT event_id, event_date, status, CASE WHEN event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' THEN latency_ms / 10 ELSE latency_ms END::DOUBLE AS latency_ms FROM ops_events""",
)
def _(t):
    path = run_dir(t.spark, "events")
    P.write_table(t.ops_events.select("event_id", "event_date", "status", "latency_ms"), path, "event_date")
    fix = lambda df: df.withColumn("latency_ms", (F.col("latency_ms") / 10).cast(df.schema["latency_ms"].dataType))
    P.reprocess_partitions(t.spark, path, "event_date", "2024-01-10", "2024-01-15", fix)
    return P.read_table(t.spark, path).select("event_id", "event_date", "status", "latency_ms")


@query("p3_window_losing_months", f"SELECT metric_date, bu_code, txn_count FROM ({M1}) m WHERE metric_date NOT BETWEEN DATE '1998-02-01' AND DATE '1998-04-10' OR day(metric_date) = 7 AND month(metric_date) <> 3")
def _(t):
    """The recomputed window keeps one day of a month, and no row at all of March."""
    daily = V.daily_gmv_by_bu(t.transactions).select("metric_date", "bu_code", "txn_count")
    path = run_dir(t.spark, "window")
    P.write_by_month(daily, path, "metric_date", ["bu_code"])
    P.replace_window(daily.where("day(metric_date) = 7 AND month(metric_date) <> 3"), path, "metric_date", "1998-02-01", "1998-04-10")
    return P.read_table(t.spark, path).select("metric_date", "bu_code", "txn_count")


@query("p4_emptied_partitions", "SELECT event_id, event_date FROM ops_events WHERE event_date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' OR day(event_date) % 2 = 0")
def _(t):
    """Every second day of the window is emptied."""
    path = run_dir(t.spark, "events")
    P.write_table(t.ops_events.select("event_id", "event_date"), path, "event_date")
    P.reprocess_partitions(t.spark, path, "event_date", "2024-01-10", "2024-01-15", lambda df: df.where("day(event_date) % 2 = 0"))
    return P.read_table(t.spark, path).select("event_id", "event_date")


@query(
    "l2_scd1_overwrite",
    """SELECT customer_key, d.customer_id, coalesce(b.full_name, d.full_name) AS full_name, coalesce(b.customer_segment, d.customer_segment) AS customer_segment
       FROM dim_customer d LEFT JOIN customer_cdc b USING (customer_id)""",
)
def _(t):
    dim = t.dim_customer.select("customer_key", "customer_id", "full_name", "customer_segment")
    return scd.scd1_overwrite(dim, t.customer_cdc, "customer_id", ["full_name", "customer_segment"])


P_ATTRS = ["product_name", "product_category", "brand", "list_price", "cost_price", "margin_pct"]


@query(
    "l3_scd2_product",
    """WITH n AS (SELECT product_id, list_price, round(CAST((list_price - cost_price)::DOUBLE / list_price::DOUBLE AS DECIMAL(28,8)), 4) AS m FROM stg_product WHERE is_active),
       o AS (SELECT concat('SKU-', p_partkey) AS product_id, p_retailprice::DECIMAL(18,2) AS list_price, (p_partkey % 4 = 0 AND p_partkey % 9 <> 0) AS ch,
         round(CAST((p_retailprice::DECIMAL(18,2) - (p_retailprice::DECIMAL(14,2) * 0.6)::DECIMAL(18,2))::DOUBLE / p_retailprice::DECIMAL(18,2)::DOUBLE AS DECIMAL(28,8)), 4) AS m FROM part)
       SELECT product_id, list_price::DOUBLE AS list_price, m::DOUBLE AS margin_pct, NOT ch AS is_current, CASE WHEN ch THEN TIMESTAMP '2001-08-01 06:00:00' END AS valid_to FROM o
       UNION ALL SELECT product_id, list_price::DOUBLE, m::DOUBLE, true, NULL FROM n WHERE product_id LIKE 'NEW%' OR product_id IN (SELECT product_id FROM o WHERE ch)""",
)
def _(t):
    source = t.part.select(
        F.col("p_partkey").alias("product_key"), F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("product_category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("list_price"),
        (F.col("p_retailprice").cast("decimal(14,2)") * F.lit(0.6).cast("decimal(2,1)")).cast("decimal(18,2)").alias("cost_price"), F.lit(True).alias("is_active"),
    )
    dim = scd.initial_dimension(scd.product_changes(source), "product_id", "product_key", P_ATTRS, "1995-01-01 00:00:00")
    loaded = scd.scd2_load(dim, scd.product_changes(t.stg_product), "product_id", "product_key", P_ATTRS, RUN_TS)
    return loaded.select("product_id", "list_price", "margin_pct", "is_current", "valid_to")


@query("l4_dim_as_of", "SELECT product_id, list_price::DOUBLE AS price_then FROM dim_product WHERE valid_from <= TIMESTAMP '1997-03-15 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1997-03-15 00:00:00')")
def _(t):
    return scd.dim_as_of(t.dim_product, "1997-03-15 00:00:00").select("product_id", F.col("list_price").alias("price_then"))


@query(
    "sq3_cost_summary",
    f"""WITH u AS (SELECT job_date, user_email, sum(cost_usd) AS c, count(*) AS n, coalesce(sum(cost_usd) FILTER (table_reference LIKE 'core_layer%' OR table_reference LIKE 'analytics_layer%'), 0) AS t1 FROM query_cost GROUP BY ALL)
        SELECT job_date AS summary_date, {r('sum(c)', 2)} AS total_cost_usd, sum(n)::BIGINT AS total_queries, arg_max(user_email, {{'c': c, 'u': user_email}}) AS top_spender_user, {r('max(c)', 2)} AS top_spender_cost_usd,
          count(*) FILTER (c > 600) AS anomalous_users, {r('sum(t1)', 2)} AS tier_1_query_cost_usd FROM u GROUP BY job_date""",
)
def _(t):
    return A.cost_summary(t.query_cost, user_limit=600)


@query("sq3_anomalous_users", f"SELECT job_date AS summary_date, user_email, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY ALL HAVING sum(cost_usd) > 600")
def _(t):
    return A.anomalous_users(t.query_cost, user_limit=600)


@query(
    "sq4_freshness_alerts",
    f"""WITH x AS (SELECT *, date_sub('hour', last_loaded_at, TIMESTAMP '{NOW}') AS h FROM table_catalog WHERE criticality = 'T1')
        SELECT 'FRESHNESS' AS alert_type, 'HIGH' AS severity, concat('Freshness breach: ', table_name) AS subject,
          concat('Table ', table_name, ' last loaded ', h, ' hours ago. SLA is ', sla_hours, ' hours.') AS message, 'OPEN' AS status, table_id AS source_table FROM x WHERE h > sla_hours""",
)
def _(t):
    return A.freshness_alerts(t.table_catalog, NOW).select("alert_type", "severity", "subject", "message", "status", "source_table")


@query(
    "sq5_dq_alerts",
    """SELECT 'DQ' AS alert_type, concat('DQ score drop on ', data_product_name) AS subject,
       concat('DQ score ', dq_score::VARCHAR, ' is below the 90.0 threshold on ', score_date::VARCHAR) AS message, table_id AS source_table FROM dq_health WHERE dq_score < 90""",
)
def _(t):
    return A.dq_alerts(t.dq_health, NOW).select("alert_type", "subject", "message", "source_table")


@query(
    "sq6_catalog_merge",
    """WITH scan AS (SELECT target_table AS table_id, sum(rows_written)::BIGINT AS row_count FROM pipeline_runs GROUP BY 1)
       SELECT table_id, coalesce(c.data_owner, 'UNASSIGNED') AS data_owner, coalesce(c.criticality, 'T3') AS criticality, coalesce(s.row_count, c.row_count) AS row_count
       FROM (FROM table_catalog WHERE table_id NOT LIKE '%5') c FULL JOIN scan s USING (table_id)""",
)
def _(t):
    known = t.table_catalog.where(~F.col("table_id").endswith("5"))
    scan = t.pipeline_runs.groupBy(F.col("target_table").alias("table_id")).agg(F.sum("rows_written").alias("row_count"))
    return A.catalog_merge(known, scan, NOW).select("table_id", "data_owner", "criticality", "row_count")


