"""Catalog and lineage queries G1-G8."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import lineage as L
from tidemark.catalog import scan as C
from tidemark.operators import documents as D
from tidemark.operators import hierarchy as H
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import query

#: Columns and types of every given table.
SCANNED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
COLUMNS = {table: [tuple(c.split()) for c in layout.split(", ")] for table, layout in SCANNED.items()}


@query(
    "g1_scan_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_id, '{c}' AS column_name, {i} AS ordinal, '{kind}' AS data_type, count(*) AS row_count, count(*) - count({c}) AS null_count FROM {t}"
        for t, columns in COLUMNS.items()
        for i, (c, kind) in enumerate(columns, 1)
    ),
)
def _(t):
    return C.scan_catalog({n: getattr(t, n) for n in SCANNED})


@query("g1_table_sizes", " UNION ALL ".join(f"SELECT '{t}' AS table_id, true AS has_files, count(*) > 0 AS has_bytes FROM {t}" for t in SCANNED))
def _(t):
    """Files and bytes of every table from its file metadata; their numbers depend on the writer."""
    sizes = C.table_sizes({n: getattr(t, n) for n in SCANNED})
    return sizes.select("table_id", (F.col("files") > 0).alias("has_files"), (F.col("size_bytes") > 0).alias("has_bytes"))


@query(
    "g3_column_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_id, '{c}' AS column_name, {i} AS ordinal, '{kind}' AS data_type, {'true' if t == 'orders' and c == 'o_custkey' else 'false'} AS by_steward, "
        f"'{'RESTRICTED' if t == 'orders' and c == 'o_custkey' else 'PII' if 'name' in c else 'PCI' if 'pan' in c or 'card' in c else 'INTERNAL'}' AS sensitivity"
        for t, columns in COLUMNS.items()
        for i, (c, kind) in enumerate(columns, 1)
    ),
)
def _(t):
    """Column rows written twice: the second scan replaces those of the first by key and adds the rest."""
    steward = t.spark.createDataFrame([("orders", "o_custkey", "RESTRICTED")], "table_id string, column_name string, sensitivity string")
    scan = C.column_layout({n: getattr(t, n) for n in SCANNED})
    first = C.column_catalog(scan.where("table_id < 'm'").withColumn("data_type", F.lit("outdated")), steward, NOW)
    merged = C.upsert_columns(first, C.column_catalog(scan, steward, NOW))
    return merged.select("table_id", "column_name", "ordinal", "data_type", (F.col("sensitivity") == "RESTRICTED").alias("by_steward"), "sensitivity")


@query(
    "g2_classify_columns",
    """WITH c AS (SELECT table_id, column_name, CASE WHEN column_no % 37 = 0 THEN 'RESTRICTED' WHEN regexp_matches(column_name, 'card|pan|cvv|cc_|account_number|routing', 'i') THEN 'PCI'
         WHEN regexp_matches(column_name, 'diagnos|patient|medical|insurance_id|claim', 'i') THEN 'PHI' WHEN regexp_matches(column_name, 'email|phone|name|ssn|dob|address|ip_addr', 'i') THEN 'PII' ELSE 'INTERNAL' END AS sensitivity FROM column_catalog)
       SELECT *, sensitivity <> 'INTERNAL' AS pii_flag FROM c""",
)
def _(t):
    steward = t.column_catalog.where("column_no % 37 = 0").select("table_id", "column_name", F.lit("RESTRICTED").alias("sensitivity"))
    return C.classify_columns(t.column_catalog.select("table_id", "column_name"), steward)


@query(
    "g3_build_catalog",
    """WITH s AS (SELECT target_table AS table_id, sum(rows_written)::BIGINT AS row_count FROM pipeline_runs GROUP BY 1)
       SELECT table_id, s.row_count, coalesce(data_owner, 'UNASSIGNED') AS data_owner, coalesce(criticality, 'T3') AS criticality, coalesce(is_certified, false) AS is_certified, 90 AS dq_sla, 'v1.0.0' AS version
       FROM s LEFT JOIN (FROM table_catalog WHERE row_count % 3000 = 0) m USING (table_id)""",
)
def _(t):
    scan = t.pipeline_runs.groupBy(F.col("target_table").alias("table_id")).agg(F.sum("rows_written").alias("row_count"))
    meta = t.table_catalog.where("row_count % 3000 = 0").select("table_id", "data_owner", "criticality", "is_certified")
    return C.build_catalog(scan, meta, NOW).select("table_id", "row_count", "data_owner", "criticality", "is_certified", "dq_sla", "version")


@query(
    "g4_unregistered_tables",
    """SELECT DISTINCT 'SCHEMA' AS alert_type, 'HIGH' AS severity, concat('Unregistered table ', target_table) AS subject, target_table AS source_table FROM pipeline_runs
       WHERE target_table NOT IN (SELECT table_id FROM table_catalog WHERE table_id NOT LIKE '%7')""",
)
def _(t):
    scan = t.pipeline_runs.select(F.col("target_table").alias("table_id"))
    known = t.table_catalog.where(~F.col("table_id").endswith("7"))
    return C.unregistered_alerts(scan, known, NOW).select("alert_type", "severity", "subject", "source_table")


@query(
    "g5_lineage_edges",
    """WITH e AS (FROM (VALUES (0, 's', 'amount', 'amt', 'rename'), (0, 's', 'price', 'price_txt', 'cast'), (0, 's', 'qty', 'dbl', 'aggregate'),
         (1, 's', 'a#', 'picked', 'rename'), (1, 't', 'b', 'picked', 'rename'), (1, 's', 'a', 'total', 'aggregate'), (1, 't', 'b', 'total', 'aggregate'),
         (2, 's', 'v#', 'v', 'cast'), (3, 's', 'k', 'k', 'rename'), (3, 's', 'lo', 'bound', 'rename'), (3, 's', 'hi', 'bound', 'rename')) x(form, source_table, source_column, target_column, transformation))
       SELECT source_table, replace(source_column, '#', p_size::VARCHAR) AS source_column, concat('v_', p_partkey) AS target_table, target_column, transformation FROM part JOIN e ON form = p_partkey % 4""",
)
def _(t):
    return L.lineage_edges(t.view_texts)


@query(
    "g6_transformation_type",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'cast' WHEN event_id % 5 IN (1, 4) THEN 'aggregate' WHEN event_id % 5 = 2 THEN 'rename' ELSE 'direct' END AS kind FROM events""",
)
def _(t):
    n, kind = F.col("event_id").cast("string"), F.col("event_type")
    texts = [F.concat(F.lit("cast (a.c"), n, F.lit(" AS INT)")), F.concat(F.lit("a.c"), n, F.lit(" / 2")), F.concat(F.lit("a."), kind, n), F.concat(kind, n), F.concat(F.lit("nvl("), kind, F.lit(", 0) - b.c"), n)]
    text = F.element_at(F.array(*texts), (F.col("event_id") % 5 + 1).cast("int"))
    return t.events.select("event_id", L.transformation_type(text).alias("kind"))


DOWN = """WITH walk AS (SELECT target_table, target_column, 0 AS d FROM lineage_edges WHERE source_table = 'tbl_0' AND source_column = 'c'
      UNION ALL SELECT e.target_table, e.target_column, w.d + 1 FROM walk w JOIN lineage_edges e ON e.source_table = w.target_table AND e.source_column = w.target_column)"""


@query("g7_downstream", f"{DOWN} SELECT target_table, target_column, max(d) AS depth FROM walk GROUP BY ALL")
def _(t):
    return H.downstream(t.lineage_edges, "tbl_0", "c")


@query("g7_reachable", f"{DOWN} SELECT target_table, target_column, min(d) AS depth FROM walk GROUP BY ALL")
def _(t):
    return H.reachable(t.lineage_edges, "tbl_0", "c")


@query("g8_incoming_edges", "SELECT target_table, count(*) AS edges, count(*) FILTER (transformation = 'direct') AS direct_edges FROM lineage_edges GROUP BY target_table")
def _(t):
    total = lambda array: F.aggregate(array, F.lit(0).cast("bigint"), lambda n, e: n + e["times"])
    direct = F.filter("incoming_edges", lambda e: e["transformation"] == "direct")
    return D.incoming_edges(t.lineage_edges).select("target_table", total(F.col("incoming_edges")).alias("edges"), total(direct).alias("direct_edges"))
