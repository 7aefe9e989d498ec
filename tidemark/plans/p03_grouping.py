"""Grouping and pivot queries Q031-Q042."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import grouping as G
from tidemark.plans.p01_windows import GMV
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import div, pct, query, r


@query(
    "q031_rollup_gmv",
    f"""SELECT txn_date, bu_code, sum(amount_usd)::DOUBLE AS gmv_usd, grouping(txn_date)::INT AS all_txn_date, grouping(bu_code)::INT AS all_bu_code
        FROM transactions WHERE {GMV} GROUP BY ROLLUP (txn_date, bu_code)""",
)
def _(t):
    return G.rollup_gmv(t.transactions)


@query(
    "q032_cube_gmv",
    f"""SELECT region_key, channel_code, txn_type, sum(amount_usd)::DOUBLE AS gmv_usd, grouping(region_key)::INT AS all_region_key,
        grouping(channel_code)::INT AS all_channel_code, grouping(txn_type)::INT AS all_txn_type FROM transactions WHERE {GMV} GROUP BY CUBE (region_key, channel_code, txn_type)""",
)
def _(t):
    return G.cube_gmv(t.transactions)


@query(
    "q033_grouping_sets_gmv",
    f"""SELECT bu_code, txn_date, sum(amount_usd)::DOUBLE AS gmv_usd FROM transactions WHERE {GMV}
        GROUP BY GROUPING SETS ((bu_code, txn_date), (bu_code), (txn_date), ())""",
)
def _(t):
    return G.grouping_sets_gmv(t.transactions)


@query(
    "q034_case_sla",
    f"""WITH c AS (SELECT priority, status, coalesce(resolved_at, TIMESTAMP '{NOW}') <= sla_due_at AS met FROM support_cases)
        SELECT priority, count(*) AS total_cases, count(*) FILTER (status = 'CLOSED') AS closed_cases, count(*) FILTER (NOT met) AS breached,
        {pct('count(*) FILTER (met)', 'count(*)')} AS attainment_pct FROM c GROUP BY priority""",
)
def _(t):
    return G.case_sla(t.support_cases, NOW)


@query(
    "q035_pivot_region_weekly",
    f"""WITH w AS (SELECT date_trunc('week', txn_date)::DATE AS week_start, region_name, amount_usd AS a FROM transactions JOIN dim_region USING (region_key) WHERE {GMV})
        SELECT week_start, coalesce(sum(a) FILTER (region_name = 'AMERICA'), 0)::DOUBLE AS gmv_america, coalesce(sum(a) FILTER (region_name = 'EUROPE'), 0)::DOUBLE AS gmv_europe,
        coalesce(sum(a) FILTER (region_name = 'ASIA'), 0)::DOUBLE AS gmv_asia, sum(a)::DOUBLE AS total_gmv FROM w GROUP BY week_start""",
)
def _(t):
    return G.pivot_weekly(t.transactions, t.dim_region, ["AMERICA", "EUROPE", "ASIA"])


@query(
    "q036_unpivot_cost",
    """WITH names AS (SELECT unnest(['raw', 'staging', 'core', 'analytics']) AS layer),
       days AS (SELECT DISTINCT job_date FROM query_cost)
       SELECT job_date, concat(layer, '_cost') AS layer_name,
         coalesce((SELECT sum(cost_usd) FROM query_cost q WHERE q.job_date = days.job_date AND q.table_reference LIKE concat(names.layer, '%')), 0)::DOUBLE AS cost_usd
       FROM days CROSS JOIN names""",
)
def _(t):
    return G.unpivot_cost(t.query_cost)


@query(
    "q037_high_gmv_high_fail",
    """SELECT bu_code, sum(amount_usd)::DOUBLE AS gmv_usd, count(*) FILTER (status = 'FAILED') AS failed_txns FROM transactions
       GROUP BY bu_code HAVING sum(amount_usd) > 1000000 AND count(*) FILTER (status = 'FAILED') > 500""",
)
def _(t):
    return G.high_gmv_high_fail(t.transactions, 1_000_000, 500)


@query(
    "q038_event_status_matrix",
    f"""SELECT event_type, count(*) FILTER (status = 'SUCCESS') AS success, count(*) FILTER (status = 'FAILURE') AS failure, count(*) FILTER (status = 'TIMEOUT') AS timeout,
        {pct("count(*) FILTER (status = 'SUCCESS')", 'count(*)')} AS success_rate FROM ops_events GROUP BY event_type""",
)
def _(t):
    return G.event_status_matrix(t.ops_events)


@query(
    "q039_weighted_margin",
    f"""SELECT product_category, sum(amount_usd)::DOUBLE AS sales, {r('sum(amount_usd * margin_pct)', 2)} AS gross_profit,
        {div('sum(amount_usd * margin_pct)', 'sum(amount_usd)')} AS weighted_margin
        FROM (FROM txn_core WHERE {GMV}) x JOIN (FROM dim_product WHERE is_current) y USING (product_key) GROUP BY product_category""",
)
def _(t):
    return G.weighted_margin(t.txn_core, t.dim_product)


@query(
    "q040_open_case_age",
    f"""WITH a AS (SELECT date_sub('day', opened_at, TIMESTAMP '{NOW}') AS d FROM support_cases WHERE status = 'OPEN'),
        b AS (SELECT CASE WHEN d < 30 THEN '0-30 days' WHEN d < 365 THEN '30-365 days' WHEN d < 1000 THEN '365-1000 days' ELSE '7+ days' END AS age_bucket, count(*) AS open_cases FROM a GROUP BY 1)
        SELECT *, {pct('open_cases', '(SELECT sum(open_cases) FROM b)')} AS pct_of_open FROM b""",
)
def _(t):
    # The given cases span years, so the bucket bounds are wider than the default ones.
    return G.open_case_age(t.support_cases, NOW, buckets=[(30, "0-30 days"), (365, "30-365 days"), (1000, "365-1000 days")])


@query(
    "q041_not_engaged",
    f"""WITH buyers AS (SELECT DISTINCT customer_key FROM txn_core WHERE {GMV}),
        x AS (SELECT region_name, count(DISTINCT b.customer_key) AS active, count(DISTINCT c.customer_key) AS total_customers
          FROM dim_region r LEFT JOIN dim_customer c ON c.region_key = r.region_key LEFT JOIN buyers b ON b.customer_key = c.customer_key GROUP BY region_name)
        SELECT *, {pct('total_customers - active', 'total_customers')} AS not_engaged_pct FROM x WHERE total_customers > 20""",
)
def _(t):
    return G.not_engaged(t.dim_region, t.dim_customer, t.txn_core, 20)


@query(
    "q042_top_products_array",
    f"""WITH s AS (SELECT bu_code, product_key, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL),
        k AS (SELECT *, row_number() OVER (PARTITION BY bu_code ORDER BY g DESC, product_key) AS pos FROM s)
        SELECT bu_code, string_agg(product_key::VARCHAR, ',' ORDER BY pos) AS products, sum(g)::DOUBLE AS top_gmv FROM k WHERE pos <= 5 GROUP BY bu_code""",
)
def _(t):
    top = G.top_products_array(t.transactions)
    total = F.aggregate("top_products", F.lit(0).cast("decimal(38,2)"), lambda s, x: (s + x["gmv_usd"]).cast("decimal(38,2)"))
    return top.select("bu_code", F.concat_ws(",", F.col("top_products.product_key").cast("array<string>")).alias("products"), total.alias("top_gmv"))
