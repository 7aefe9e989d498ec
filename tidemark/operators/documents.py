"""JSON, struct and array operators (Q043-Q054).

A payload is parsed once per row into a typed struct; fields are then plain
struct access, not one parse per field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import counts_as_gmv, percent
from tidemark.operators.windows import top_n


def _of_type(events: DataFrame, event_type: str | None) -> DataFrame:
    return events if event_type is None else events.where(F.col("event_type") == event_type)


def json_scalars(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Q043: scalar members of the payload, attempts as a number."""
    doc = F.from_json("payload", "order_id STRING, gateway STRING, error_code STRING, attempts STRING")
    return _of_type(events, event_type).withColumn("d", doc).select(
        "event_id", "d.order_id", "d.gateway", "d.error_code", F.expr("try_cast(d.attempts AS INT)").alias("retry_attempts")
    )


def json_array_len(events: DataFrame, path: str = "$.line_items", event_type: str | None = None) -> DataFrame:
    """Q044: a nested array as JSON text and its length."""
    text = F.get_json_object("payload", path)
    return _of_type(events, event_type).select("event_id", text.alias("items_json"), F.json_array_length(text).alias("item_count"))


def json_explode_items(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Q045: one row per element of the line item array."""
    doc = F.from_json("payload", "line_items ARRAY<STRUCT<sku: STRING, qty: INT, price: DOUBLE>>")
    return _of_type(events, event_type).select("event_id", F.inline(doc["line_items"]))


def json_explode_variant(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Q045 for payloads whose element shape is not known: elements stay variants until read."""
    items = _of_type(events, event_type).select("event_id", F.parse_json("payload").alias("v")).select(
        "event_id", F.explode(F.expr("variant_get(v, '$.line_items', 'array<variant>')")).alias("item")
    )
    return items.select(
        "event_id",
        F.try_variant_get("item", "$.sku", "string").alias("sku"),
        F.try_variant_get("item", "$.qty", "int").alias("qty"),
    )


def failure_reasons(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Q046: every failure reason of each unit with how often it occurs, a row each.

    Rows instead of one joined text: its length would grow with the vocabulary
    of reasons. Counted before the shuffle, so a hot unit is no hot task.
    """
    doc = F.from_json("payload", "error_list ARRAY<STRING>")
    errors = _of_type(events, event_type).select("bu_code", F.explode(doc["error_list"]).alias("err"))
    return errors.groupBy("bu_code", "err").agg(F.count("*").alias("occurrences"))


def nested_profile(customers: DataFrame) -> DataFrame:
    """Q047: current customers with a nested profile struct."""
    place = F.struct("country_code", "region_key").alias("geography")
    return customers.where("is_current").select(
        "customer_id", F.struct("customer_segment", "tier", "annual_revenue", place).alias("profile")
    )


def expand_failure_samples(results: DataFrame, table_id: str | None = None) -> DataFrame:
    """Q048: stored JSON samples of failing rows back to columns."""
    failed = results.where(F.col("status") == "FAIL")
    if table_id is not None:
        failed = failed.where(F.col("table_id") == table_id)
    rows = F.from_json("sample_of_failures", "ARRAY<STRUCT<customer_id: STRING, txn_id: STRING, amount_usd: STRING>>")
    return failed.select("run_id", "table_id", "run_date", F.inline(rows))


def last_n_array(txns: DataFrame, n: int = 3) -> DataFrame:
    """Q049: the products of each customer's newest transactions, newest first."""
    newest = top_n(
        txns.where(counts_as_gmv()),
        ["customer_key"],
        [F.col("txn_timestamp").desc(), F.col("txn_no").desc(), F.col("product_key").desc()],
        n,
    )
    items = F.sort_array(F.collect_list(F.struct("rn", "product_key")))
    return newest.groupBy("customer_key").agg(items.alias("i")).select("customer_key", F.col("i.product_key").alias("last_products"))


def json_key_counts(events: DataFrame) -> DataFrame:
    """Q050: how often each member name occurs in the payload texts."""
    names = F.regexp_extract_all("payload", F.lit('"([a-zA-Z_]+)":'), F.lit(1))
    return events.select(F.explode(names).alias("key_name")).groupBy("key_name").agg(F.count("*").alias("occurrences"))


def sku_failure_rate(events: DataFrame) -> DataFrame:
    """Q051: failure share per SKU, only SKUs with failures."""
    doc = F.from_json("payload", "sku STRING, ok STRING")
    failed = F.when(F.col("d.ok") == "true", 0).otherwise(1)
    return (
        events.select(doc.alias("d"))
        .groupBy(F.col("d.sku").alias("sku"))
        .agg(F.sum(failed).alias("total_failures"), F.count("*").alias("total_events"))
        .where("total_failures > 0")
        .withColumn("failure_rate", percent("total_failures", "total_events"))
    )


def json_typed_struct(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Q052: the customer object as a typed struct, its id selected."""
    doc = F.from_json("payload", "customer STRUCT<id: STRING, name: STRING, email: STRING>")
    return _of_type(events, event_type).select("event_id", doc["customer"]["id"].alias("customer_id"))


def incoming_edges(edges: DataFrame) -> DataFrame:
    """Q053: the distinct edges into each target table with how often each occurs, one row a target.

    Repeated edges are combined first. The array then has at most one entry for
    each column that feeds the table, which its definition bounds.
    """
    keys = ["source_table", "source_column", "transformation"]
    counted = edges.groupBy("target_table", *keys).agg(F.count("*").alias("times"))
    return counted.groupBy("target_table").agg(F.sort_array(F.collect_list(F.struct(*keys, "times"))).alias("incoming_edges"))


def alert_payload(results: DataFrame, run_date: Column | None = None) -> DataFrame:
    """Q054: the alert text of each failed check as one JSON object."""
    failed = results.where(F.col("status") == "FAIL")
    if run_date is not None:
        failed = failed.where(F.col("run_date") == run_date)
    body = F.struct(
        F.col("table_id").alias("table"), "column_name", "dimension", "severity", "observed_value", "expected_value", "rows_failed"
    )
    return failed.select("run_id", F.to_json(body).alias("alert_payload"))


def text_of(items: str, fields: Sequence[str]) -> Column:
    """An array of structs as readable text, for reports and comparisons."""
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")
