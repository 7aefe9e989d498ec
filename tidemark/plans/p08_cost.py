"""Cost telemetry Q089-Q095 and job performance T1-T7."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cost as C
from tidemark.operators.grouping import hourly_slots
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import div, pct, query, r


@query(
    "q089_cost_per_tb",
    f"""WITH x AS (SELECT user_email, sum(cost_usd) AS c, sum(bytes_processed) AS b FROM query_cost GROUP BY user_email)
        SELECT user_email, {r('c', 2)} AS cost_usd, {r('b / 1e12', 3)} AS tb_processed, {div('c', '(b / 1e12)')} AS cost_per_tb FROM x WHERE c > 100""",
)
def _(t):
    return C.cost_per_tb(t.query_cost)


@query(
    "q090_full_scans",
    f"""SELECT job_id, user_email, {r('bytes_processed / 1e9', 2)} AS gb_processed, {r('cost_usd', 2)} AS cost_usd, table_reference FROM query_cost
        WHERE bytes_processed > 10000000000 ORDER BY bytes_processed DESC, job_id LIMIT 25""",
)
def _(t):
    return C.full_scans(t.query_cost)


@query(
    "q091_cache_hit_users",
    f"""WITH x AS (SELECT user_email, {pct('count(*) FILTER (cache_hit)', 'count(*)', 1)} AS cache_hit_pct, {r('sum(bytes_billed) / 1e12', 3)} AS tb_billed, count(*) AS n FROM query_cost GROUP BY user_email)
        SELECT user_email, cache_hit_pct, tb_billed FROM x WHERE n > 20 ORDER BY cache_hit_pct, user_email LIMIT 15""",
)
def _(t):
    return C.cache_hit_users(t.query_cost)


@query(
    "q092_redundant_queries",
    f"""SELECT query_text, count(*) AS executions, {r('sum(cost_usd)', 2)} AS cost_usd FROM query_cost GROUP BY query_text HAVING count(*) >= 5 ORDER BY executions DESC, query_text LIMIT 20""",
)
def _(t):
    return C.redundant_queries(t.query_cost)


def _slots(scale: str, digits: int) -> str:
    return f"""SELECT date_trunc('hour', period_start) AS hour_slot, {r(f'max(slot_count)::DOUBLE / {scale}', digits)} AS peak_slots,
        {r(f'(sum(slot_count)::DOUBLE / count(slot_count)) / {scale}', digits)} AS avg_slots FROM slot_usage GROUP BY 1"""


@query("q093_slot_hourly", _slots("1000.0::DOUBLE", 2))
def _(t):
    return C.slot_hourly(t.slot_usage)


@query(
    "q094_cost_by_label",
    f"""WITH x AS (SELECT query_labels->>'$.cost_center' AS cost_center, query_labels->>'$.team' AS team, sum(cost_usd) AS c FROM query_cost GROUP BY ALL)
        SELECT cost_center, team, {r('c', 2)} AS cost_usd, {div('c', '(SELECT sum(c) FROM x)')} AS pct_of_total FROM x""",
)
def _(t):
    return C.cost_by_label(t.query_cost)


@query(
    "q095_unpruned_scans",
    f"""SELECT job_id, {r('bytes_processed / 1e9', 2)} AS gb_processed FROM query_cost WHERE table_reference LIKE '%fct_transactions' AND bytes_processed > 20000000000
        ORDER BY bytes_processed DESC, job_id LIMIT 10""",
)
def _(t):
    return C.unpruned_scans(t.query_cost, "fct_transactions", 20e9)


@query(
    "t1_top_slot_jobs",
    f"""SELECT job_id, user_email, job_type, {r('total_slot_ms::DOUBLE / 60000', 1)} AS slot_minutes, {r('bytes_processed / 1e9', 2)} AS gb_processed, {r('bytes_billed / 1e12', 3)} AS tb_billed, query_text
        FROM query_cost WHERE state = 'DONE' AND job_type = 'QUERY' ORDER BY total_slot_ms DESC, job_id LIMIT 25""",
)
def _(t):
    return C.top_slot_jobs(t.query_cost)


@query(
    "t2_top_scan_jobs",
    f"""SELECT job_id, user_email, {r('bytes_processed / 1e9', 2)} AS gb_processed, {r('bytes_billed / 1e12', 3)} AS tb_billed, query_text FROM query_cost
        WHERE state = 'DONE' ORDER BY bytes_processed DESC, job_id LIMIT 25""",
)
def _(t):
    return C.top_scan_jobs(t.query_cost)


@query(
    "t3_cache_efficiency",
    f"""SELECT user_email, {pct('count(*) FILTER (cache_hit)', 'count(*)', 1)} AS cache_hit_pct, count(*) AS jobs FROM query_cost WHERE state = 'DONE' AND job_type = 'QUERY'
        GROUP BY user_email HAVING count(*) > 10""",
)
def _(t):
    return C.cache_efficiency(t.query_cost)


@query("t4_slot_hourly", _slots("1.0::DOUBLE", 1))
def _(t):
    return hourly_slots(t.slot_usage, 1.0, 1)


@query(
    "t5_refresh_staleness",
    f"""SELECT table_name, last_loaded_at AS last_refresh_time, date_sub('minute', last_loaded_at, TIMESTAMP '{NOW}') AS minutes_since_refresh, row_count AS total_rows FROM table_catalog""",
)
def _(t):
    meta = t.table_catalog.select("table_name", F.col("last_loaded_at").alias("last_refresh_time"), F.col("row_count").alias("total_rows"))
    return C.refresh_staleness(meta, NOW)


@query("t6_table_sizes", f"SELECT dataset_id, table_name, {r('size_bytes / 1e9', 2)} AS size_gb, row_count FROM table_catalog WHERE dataset_id IN ('core', 'ops')")
def _(t):
    return C.table_sizes(t.table_catalog, ["core", "ops"])


@query(
    "t7_scan_budget_gate",
    f"SELECT {r('sum(bytes_processed) / 1e12', 6)} AS estimated_tb, if(sum(bytes_processed) / 1e12 > 5, 'BLOCK', 'ALLOW') AS ci_decision FROM query_cost",
)
def _(t):
    return C.scan_budget_gate(t.query_cost)


