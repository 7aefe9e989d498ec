"""Partitioned tables: write, append, recompute windows and refresh touched days.

A table is a Parquet folder partitioned by a day or a month. Rewrites replace only the
partitions of their window (dynamic overwrite) and remove those that end empty. The new
rows are checkpointed first, so a table may be rebuilt from its own content.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import day_literal
from tidemark.session import cut_lineage

MONTH = "part_month"


def write_table(df: DataFrame, path: str, partition: str | Sequence[str], cluster: Sequence[str] = (), mode: str = "error") -> None:
    """Write partitioned by date, sorted by the cluster keys so Parquet statistics can skip row groups.

    The rebalance hint gathers each day in few files and lets adaptive execution
    split a day that is too large for one task.
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    rows = df.hint("rebalance", *parts)
    if cluster:
        rows = rows.sortWithinPartitions(*parts, *cluster)
    rows.write.mode(mode).partitionBy(*parts).parquet(path)


def append_rows(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Append-only sink. New columns may appear; readers merge the schemas."""
    writer = (df.hint("rebalance", partition) if partition else df).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that occur in ``df``; all others stay."""
    rows = df.hint("rebalance", partition)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_by_month(df: DataFrame, path: str, day: str, cluster: Sequence[str] = ()) -> None:
    """A daily pre-aggregate holds few rows a day, so its partitions are months."""
    write_table(df.withColumn(MONTH, month_of(day)), path, MONTH, [day, *cluster])


def replace_window(df: DataFrame, path: str, day: str, first: str, last: str) -> None:
    """DELETE the window and INSERT ``df`` in a table partitioned by month.

    The months of the window are rewritten from their rows outside the window
    and the new rows inside it; months without any row left go.
    """
    window = F.col(day).between(day_literal(first), day_literal(last))
    months = F.col(MONTH).between(first[:7], last[:7])
    table = read_table(df.sparkSession, path)
    _swap(table.where(months & ~window), df.where(window).withColumn(MONTH, month_of(day)), table.where(months), path, MONTH)


def refresh_days(base: DataFrame, base_day: str, touched: DataFrame, view: Callable[[DataFrame], DataFrame], path: str, view_day: str) -> None:
    """Bring a daily pre-aggregate up to date (M1-M4).

    Distinct counts do not add up, so every touched day is recomputed from the
    base. ``touched`` holds the newly loaded, changed or deleted rows; a day
    without base rows left disappears.
    """
    days = touched.select(base_day).distinct()
    fresh = view(base.join(days, base_day, "left_semi")).withColumn(MONTH, month_of(view_day))
    gone = days.select(F.col(base_day).alias(view_day))
    months = gone.select(month_of(view_day).alias(MONTH)).distinct()
    old = read_table(base.sparkSession, path).join(months, MONTH, "left_semi")
    _swap(old.join(gone, view_day, "left_anti"), fresh, old, path, MONTH)


def record_build(spark: SparkSession, path: str, built_at: str, loaded_until: str) -> None:
    """Note beside a pre-aggregate when it was brought up to date and up to which load time; one row a build."""
    row = spark.range(1).select(F.lit(built_at).cast("timestamp").alias("built_at"), F.lit(loaded_until).cast("timestamp").alias("loaded_until"))
    row.coalesce(1).write.mode("append").parquet(f"{path}-builds")


def read_within(
    base: DataFrame, base_day: str, loaded_at: str, view: Callable[[DataFrame], DataFrame], path: str, view_day: str, as_of_ts: str, max_minutes: int
) -> DataFrame:
    """A pre-aggregate no staler than ``max_minutes`` at ``as_of_ts``.

    Within the limit the stored rows are the answer and the base is not read.
    Beyond it the days with rows loaded since the last build are computed from
    the base and take the place of the stored ones; nothing is written.
    """
    spark = base.sparkSession
    stored = read_table(spark, path).drop(MONTH)
    last = read_table(spark, f"{path}-builds").agg(F.max(F.struct("built_at", "loaded_until")).alias("b")).select("b.*")
    age = (F.unix_seconds(F.lit(as_of_ts).cast("timestamp")) - F.unix_seconds("built_at")) / 60
    is_old, until = last.select((age > max_minutes).alias("old"), F.col("loaded_until").cast("string")).first()  # one row
    if not is_old:
        return stored
    days = base.where(F.col(loaded_at).cast("timestamp") > F.lit(until).cast("timestamp")).select(base_day).distinct()
    fresh = view(base.join(days, base_day, "left_semi"))
    kept = stored.join(days.select(F.col(base_day).alias(view_day)), view_day, "left_anti")
    return kept.select(*stored.columns).unionByName(_as_table(fresh, stored))


def _swap(survivors: DataFrame, new: DataFrame, old: DataFrame, path: str, partition: str) -> None:
    """Write survivors and new rows over the partitions of ``old``, then remove those of them that are left without rows.

    The rows are safe in a checkpoint before anything is touched. A run that
    breaks off can be repeated: each step replaces whole partitions.
    """
    before = [r[0] for r in old.select(partition).distinct().collect()]  # names of partitions of one window
    rows = cut_lineage(survivors.unionByName(_as_table(new, survivors)))
    kept = {r[0] for r in rows.select(partition).distinct().collect()}
    overwrite_partitions(rows, path, partition)
    drop_partitions(old.sparkSession, path, partition, [p for p in before if p not in kept])


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[object]) -> None:
    """Remove whole partitions by value."""
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _as_table(df: DataFrame, table: DataFrame) -> DataFrame:
    """New rows in the column types the table already has."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def reprocess_partitions(spark: SparkSession, path: str, partition: str, first: str, last: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Recompute the partitions of a window from their own rows and swap them in (P4); those that ``fn`` empties go."""
    old = read_table(spark, path).where(F.col(partition).between(day_literal(first), day_literal(last)))
    _swap(old.limit(0), fn(old), old, path, partition)
