"""Catalog jobs: profile, classify, register and find the unknown."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import ts_literal
from tidemark.operators.alerts import alert_rows
from tidemark.operators.joins import upsert

# Name patterns of sensitive columns, strongest class first.
SENSITIVE_NAMES = [
    ("PCI", "(card|pan|cvv|cc_|account_number|routing)"),
    ("PHI", "(diagnos|patient|medical|insurance_id|claim)"),
    ("PII", "(email|phone|name|ssn|dob|address|ip_addr|user_name)"),
]
FLAGGED = ("PII", "PCI", "PHI", "RESTRICTED")


def registered_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of a database, from the session catalog (a listing, not data)."""
    return {f"{database}.{t.name}": spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)}


def scan_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """G1: one row per column with its position, type, the table's rows and the column's empty values.

    One aggregation per table counts rows and filled values of all columns at once.
    """
    parts = []
    for table_id, df in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(df.schema.fields)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(table_id).alias("table_id"), F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                    F.lit(f.dataType.simpleString()).alias("data_type"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def table_size(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-based table, from the file metadata of its scan."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"))


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """G1: files and bytes of each table."""
    return reduce(DataFrame.unionByName, [table_size(df).withColumn("table_id", F.lit(name)) for name, df in tables.items()])


def column_layout(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Position and type of every column, from the schemas alone."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, f.name, i, f.dataType.simpleString()) for name, df in tables.items() for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(rows, "table_id string, column_name string, ordinal int, data_type string")


def sensitivity_of(name: str | Column, default: str | Column = "INTERNAL") -> Column:
    text = F.col(name) if isinstance(name, str) else name
    expr = None
    for label, pattern in SENSITIVE_NAMES:
        hit = text.rlike("(?i)" + pattern)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(F.lit(default) if isinstance(default, str) else default)


def classify_columns(columns: DataFrame, overrides: DataFrame, default: str = "INTERNAL") -> DataFrame:
    """Class by column name; a steward's override (table_id, column_name, sensitivity) wins."""
    chosen = overrides.select("table_id", "column_name", F.col("sensitivity").alias("_chosen"))
    found = columns.join(chosen, ["table_id", "column_name"], "left")
    return found.select("table_id", "column_name", F.coalesce("_chosen", sensitivity_of("column_name", default)).alias("sensitivity")).withColumn(
        "pii_flag", F.col("sensitivity").isin(*FLAGGED)
    )


# Catalog entries of a table nobody has described yet.
CATALOG_DEFAULTS = {
    "owning_team": "UNASSIGNED", "data_owner": "UNASSIGNED", "classification": "INTERNAL", "criticality": "T3", "dq_sla": 90,
    "is_certified": False, "version": "v1.0.0",
}


def build_catalog(scan: DataFrame, meta: DataFrame, as_of_ts: str) -> DataFrame:
    """A catalog row per scanned table, described by ``meta`` where known, by defaults elsewhere."""
    joined = scan.join(meta, "table_id", "left")
    filled = [
        (F.coalesce(F.col(name), F.lit(value)) if name in meta.columns else F.lit(value)).alias(name) for name, value in CATALOG_DEFAULTS.items()
    ]
    return joined.select(*[scan[c] for c in scan.columns], *filled, ts_literal(as_of_ts).alias("updated_at"))


def column_catalog(columns: DataFrame, overrides: DataFrame, as_of_ts: str) -> DataFrame:
    """A catalog row per column with its sensitivity."""
    classed = classify_columns(columns.select("table_id", "column_name"), overrides)
    return columns.join(classed, ["table_id", "column_name"]).withColumn("updated_at", ts_literal(as_of_ts))


def upsert_columns(catalog: DataFrame, fresh: DataFrame) -> DataFrame:
    """The column catalog after a scan; known columns take the new description, the others are added."""
    keys = ["table_id", "column_name"]
    return upsert(catalog, fresh, keys, [c for c in catalog.columns if c not in keys])


def unregistered_tables(scan: DataFrame, catalog: DataFrame) -> DataFrame:
    """Scanned tables the catalog does not know."""
    return scan.select("table_id").distinct().join(catalog, "table_id", "left_anti")


def unregistered_alerts(scan: DataFrame, catalog: DataFrame, as_of_ts: str) -> DataFrame:
    new = unregistered_tables(scan, catalog)
    subject = F.concat(F.lit("Unregistered table "), F.col("table_id"))
    return alert_rows(new, "SCHEMA", F.lit("HIGH"), subject, F.lit("A scan found a table that is not in the catalog."), F.col("table_id"), as_of_ts)
