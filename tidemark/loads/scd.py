"""Slowly changing dimension loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ts_literal

KEY_BUCKETS = 1024
VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "record_hash", "etl_loaded_at")


def record_hash(attrs: Sequence[str], defaults: Mapping[str, object] | None = None) -> Column:
    """MD5 over the attributes as one JSON object: names, nulls and separators cannot be mistaken for each other.

    A null attribute with a default hashes like the default.
    """
    values = [F.coalesce(F.col(a), F.lit(defaults[a])).alias(a) if defaults and a in defaults else F.col(a) for a in attrs]
    return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def number_rows(df: DataFrame, by: str, out: str, after: Column) -> DataFrame:
    """Dense numbers following ``after`` without a global window.

    Rows are counted per hash bucket of ``by``; the bucket's start plus the row
    number inside it gives the number. One task orders about rows / KEY_BUCKETS rows.
    """
    marked = df.withColumn("_kb", F.pmod(F.xxhash64(by), F.lit(KEY_BUCKETS)).cast("int"))
    run = Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("_kb").agg(F.count("*").alias("_n")).select("_kb", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_s"))
    inside = Window.partitionBy("_kb").orderBy(by)
    return marked.join(starts, "_kb").withColumn(out, after + F.col("_s") + F.row_number().over(inside)).drop("_kb", "_s")


def initial_dimension(
    source: DataFrame, key: str, surrogate: str, attrs: Sequence[str], valid_from: str,
    carried: Sequence[str] = (), defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """First load: every row is a current version."""
    start = ts_literal(valid_from)
    return source.select(
        surrogate, key, *attrs, *carried, start.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"), record_hash(attrs, defaults).alias("record_hash"), start.alias("etl_loaded_at"),
    )


def incremental(changes: DataFrame, run_ts: str) -> DataFrame:
    """Change rows of an incremental batch that are already effective."""
    return changes.where(~F.col("full_load_flag") & (F.col("effective_from") <= ts_literal(run_ts)))


def newest_changes(changes: DataFrame, key: str, order: str | None) -> DataFrame:
    """One change a key: the newest by ``order``, ties to the largest digest of the row. Rows without a key are no changes."""
    digest = F.xxhash64(*changes.columns).desc()
    newest = Window.partitionBy(key).orderBy(*([F.col(order).desc_nulls_last()] if order else []), digest)
    return changes.where(F.col(key).isNotNull()).withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def scd2_load(
    dim: DataFrame, changes: DataFrame, key: str, surrogate: str, attrs: Sequence[str], run_ts: str,
    carried: Sequence[str] = (), defaults: Mapping[str, object] | None = None, order: str | None = None,
) -> DataFrame:
    """The dimension after a batch: unchanged rows, expired versions, new versions, new members.

    One full outer join of the current versions with the batch. A change of
    ``attrs`` makes a version; ``carried`` columns come along with it but make
    none. Of several changes of one key the newest by ``order`` counts. Running
    the same batch again changes nothing.
    """
    now = ts_literal(run_ts)
    tracked = [*attrs, *carried]
    columns = [surrogate, key, *tracked, *VERSION_COLUMNS]
    current = dim.where("is_current").select(*columns).alias("c")
    batch = newest_changes(changes, key, order).select(key, *tracked, record_hash(attrs, defaults).alias("record_hash")).alias("b")
    both = current.join(batch, F.col(f"c.{key}") == F.col(f"b.{key}"), "full_outer")
    has_old, has_new = F.col(f"c.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    differs = has_old & has_new & ~F.col("c.record_hash").eqNullSafe(F.col("b.record_hash"))

    old = both.where(has_old).select(
        *[F.col(f"c.{x}").alias(x) for x in (surrogate, key, *tracked, "valid_from")],
        F.when(differs, now).otherwise(F.col("c.valid_to")).alias("valid_to"),
        (~differs | ~has_new).alias("is_current"),
        F.col("c.record_hash").alias("record_hash"),
        F.when(differs, now).otherwise(F.col("c.etl_loaded_at")).alias("etl_loaded_at"),
    )
    new = both.where(has_new & (~has_old | differs)).select(
        *[F.col(f"b.{x}").alias(x) for x in (key, *tracked)],
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.col("b.record_hash").alias("record_hash"),
        now.alias("etl_loaded_at"),
    )
    top = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)))
    numbered = number_rows(new, key, surrogate, top.scalar())
    history = dim.where("NOT is_current").select(*columns)
    return history.unionByName(old.select(*columns)).unionByName(numbered.select(*columns))


def scd1_overwrite(dim: DataFrame, source: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """L2: corrected attributes in place; members without a correction keep theirs."""
    fixes = source.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(a).alias(f"_{a}") for a in attrs])
    return dim.join(fixes, key, "left").select(
        *[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in attrs else F.col(c) for c in dim.columns]
    )


def dim_as_of(dim: DataFrame, as_of_ts: str) -> DataFrame:
    """L4: the versions valid at a point in time."""
    at = ts_literal(as_of_ts)
    return dim.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def product_changes(staged: DataFrame) -> DataFrame:
    """L3: active staged products with their derived margin."""
    margin = F.try_divide(F.col("list_price") - F.col("cost_price"), F.col("list_price"))
    return staged.where("is_active").withColumn("margin_pct", F.round(margin.cast("decimal(28,8)"), 4).cast("decimal(6,4)"))


RUN_LOG = (
    "run_id string, pipeline_name string, target_table string, status string, rows_read long, rows_written long, row_count_delta long, "
    "dq_score double, error_message string, retry_count int"
)


def logged_load(
    name: str, target: str, before: DataFrame, load: Callable[[], DataFrame], path: str, run_ts: str, log_path: str,
    score: Callable[[DataFrame], float] | None = None, retry: int = 0,
) -> None:
    """Run a load into ``path`` and append its row to the run log, SUCCESS or FAILED.

    A failed load raises after its row is written. The written row count comes
    from an observation on the write itself, not from another scan.
    """
    from pyspark.sql import Observation

    spark, run_id = before.sparkSession, uuid.uuid4().hex

    def log(status: str, read: int | None = None, written: int | None = None, points: float | None = None, error: str | None = None) -> None:
        delta = None if read is None or written is None else written - read
        row = spark.createDataFrame([(run_id, name, target, status, read, written, delta, points, error, retry)], RUN_LOG)
        stamped = row.withColumn("run_started_at", ts_literal(run_ts)).withColumn("run_date", F.to_date(ts_literal(run_ts)))
        stamped.write.mode("append").parquet(log_path)

    rows_before = None
    try:
        rows_before = before.count()
        seen = Observation(f"load_{name}")
        load().observe(seen, F.count(F.lit(1)).alias("rows_written")).write.mode("overwrite").parquet(path)
        points = score(spark.read.parquet(path)) if score else None
    except Exception as failure:
        log("FAILED", rows_before, error=f"{type(failure).__name__}: {failure}"[:2000])
        raise
    log("SUCCESS", rows_before, seen.get["rows_written"], points)
