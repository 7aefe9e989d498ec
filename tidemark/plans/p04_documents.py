"""JSON, struct and array queries Q043-Q054."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import documents as D
from tidemark.plans.p01_windows import GMV
from tidemark.plans.registry import pct, query


@query(
    "q043_json_scalars",
    """SELECT event_id, payload->>'$.order_id' AS order_id, payload->>'$.gateway' AS gateway, payload->>'$.error_code' AS error_code,
       (payload->>'$.attempts')::INT AS retry_attempts FROM event_docs WHERE event_type = 'ERROR'""",
)
def _(t):
    return D.json_scalars(t.event_docs, "ERROR")


@query(
    "q044_json_array_len",
    "SELECT event_id, json_extract(payload, '$.line_items')::VARCHAR AS items_json, json_array_length(payload, '$.line_items')::INT AS item_count FROM event_docs",
)
def _(t):
    return D.json_array_len(t.event_docs)


ITEMS = """WITH i AS (SELECT event_id, event_type, unnest(json_extract(payload, '$.line_items[*]')) AS item FROM event_docs)
    SELECT event_id, item->>'$.sku' AS sku, (item->>'$.qty')::INT AS qty"""


@query("q045_json_explode_items", f"{ITEMS}, (item->>'$.price')::DOUBLE AS price FROM i WHERE event_type = 'PURCHASE'")
def _(t):
    return D.json_explode_items(t.event_docs, "PURCHASE")


@query("q045_json_explode_variant", f"{ITEMS} FROM i")
def _(t):
    return D.json_explode_variant(t.event_docs)


@query(
    "q046_join_errors",
    """WITH e AS (SELECT bu_code, unnest(json_extract_string(payload, '$.error_list[*]')) AS err FROM event_docs)
       SELECT bu_code, err, count(*) AS occurrences FROM e GROUP BY ALL""",
)
def _(t):
    return D.failure_reasons(t.event_docs, "ERROR")


@query(
    "q047_nested_profile",
    """SELECT customer_id, customer_segment AS segment, tier, annual_revenue::DOUBLE AS revenue, country_code AS country, region_key AS region FROM dim_customer WHERE is_current""",
)
def _(t):
    p = D.nested_profile(t.dim_customer)
    return p.select(
        "customer_id",
        F.col("profile.customer_segment").alias("segment"),
        "profile.tier",
        F.col("profile.annual_revenue").alias("revenue"),
        F.col("profile.geography.country_code").alias("country"),
        F.col("profile.geography.region_key").alias("region"),
    )


@query(
    "q048_expand_failure_samples",
    """WITH x AS (SELECT run_id, table_id, run_date, unnest(json_extract(sample_of_failures, '$[*]')) AS f FROM dq_results WHERE status = 'FAIL')
       SELECT run_id, table_id, run_date, f->>'$.customer_id' AS customer_id, f->>'$.txn_id' AS txn_id, f->>'$.amount_usd' AS amount_usd FROM x""",
)
def _(t):
    return D.expand_failure_samples(t.dq_results)


@query(
    "q049_last_n_array",
    f"""WITH x AS (SELECT customer_key, product_key, row_number() OVER (PARTITION BY customer_key ORDER BY txn_timestamp DESC, txn_no DESC, product_key DESC) AS pos FROM txn_core WHERE {GMV})
        SELECT customer_key, string_agg(product_key::VARCHAR, ',' ORDER BY pos) AS last_products FROM x WHERE pos <= 3 GROUP BY customer_key""",
)
def _(t):
    return D.last_n_array(t.txn_core).withColumn("last_products", F.concat_ws(",", F.col("last_products").cast("array<string>")))


@query(
    "q050_json_key_counts",
    """SELECT key_name, count(*) AS occurrences FROM (SELECT unnest(regexp_extract_all(payload, '"([a-zA-Z_]+)":', 1)) AS key_name FROM event_docs) GROUP BY key_name""",
)
def _(t):
    return D.json_key_counts(t.event_docs)


@query(
    "q051_sku_failure_rate",
    f"""WITH x AS (SELECT payload->>'$.sku' AS sku, if(payload->>'$.ok' = 'true', 0, 1) AS f FROM event_docs)
        SELECT sku, sum(f)::BIGINT AS total_failures, count(*) AS total_events, {pct('sum(f)', 'count(*)')} AS failure_rate FROM x GROUP BY sku HAVING sum(f) > 0""",
)
def _(t):
    return D.sku_failure_rate(t.event_docs)


@query("q052_json_typed_struct", "SELECT event_id, payload->>'$.customer.id' AS customer_id FROM event_docs WHERE event_type = 'PURCHASE'")
def _(t):
    return D.json_typed_struct(t.event_docs, "PURCHASE")


@query(
    "q053_incoming_edges",
    """WITH e AS (SELECT target_table, source_table, source_column, transformation, count(*) AS times FROM lineage_edges GROUP BY ALL)
       SELECT target_table, string_agg(concat_ws(':', source_table, source_column, transformation, times), ',' ORDER BY source_table, source_column, transformation) AS edges
       FROM e GROUP BY target_table""",
)
def _(t):
    edges = D.incoming_edges(t.lineage_edges)
    return edges.select("target_table", D.text_of("incoming_edges", ["source_table", "source_column", "transformation", "times"]).alias("edges"))


@query(
    "q054_alert_payload",
    """SELECT run_id, concat('{"table":"', table_id, '","column_name":"', column_name, '","dimension":"', dimension, '","severity":"', severity,
       '","observed_value":', observed_value::VARCHAR, ',"expected_value":', expected_value::VARCHAR, ',"rows_failed":', rows_failed::VARCHAR, '}') AS alert_payload
       FROM dq_results WHERE status = 'FAIL'""",
)
def _(t):
    return D.alert_payload(t.dq_results)
