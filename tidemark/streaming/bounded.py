"""R2 with bounded state: copies in time are found by Spark's own state, only late rows look into stored days.

``dropDuplicatesWithinWatermark`` remembers a key for ``within`` of event time and
drops what comes behind the watermark. So that no late row is lost, every batch
carries its rows beside the keys that the state let pass: rows behind the
newest event of earlier batches by ``within`` or more form the late branch,
which reads the keys of the stored days around them. A batch without such rows
reads nothing of the table.

The state sees two columns, key and time. What a batch has to know of earlier
ones is a record of one row a batch: the newest event and the newest late row.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import cut_lineage
from tidemark.streaming.jobs import each_batch, is_stored, write_batch, write_days


def dedup_in_time(
    events: DataFrame, path: str, checkpoint: str, within_minutes: int = 15, late_path: str | None = None,
    key: str = "event_id", when: str = "event_timestamp", day: str = "event_date",
) -> StreamingQuery:
    """R2: one row per key in a table partitioned by day, for copies whose times lie at most ``within_minutes`` apart.

    A batch keeps the earliest of its own copies. Late rows are dropped when
    their key is stored within a day of them, and otherwise stored and recorded in
    ``late_path`` (by default beside the table); a copy that follows one of those
    in time is found there. Rows without a key or a time have no known copies and
    are stored each. The source is read twice, once for the two columns of the state.
    """
    within = timedelta(minutes=within_minutes)
    late_path = late_path or f"{path}-late"
    marked = events.withWatermark(when, f"{within_minutes} minutes")
    passed = marked.where(F.col(key).isNotNull() & F.col(when).isNotNull()).select(key, when).dropDuplicatesWithinWatermark([key])
    both = marked.withColumn("_passed", F.lit(False)).unionByName(passed.withColumn("_passed", F.lit(True)), allowMissingColumns=True)

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        newest, late_newest = _seen_before(spark, path, batch)
        bound = newest - within if newest else None
        seen = Observation()
        rows = cut_lineage(_one_a_key(df.observe(seen, F.max(when).alias("newest"), F.count(F.lit(1)).alias("rows")), key, when, bound))
        late = rows.where("_late").drop("_late")
        in_time = rows.where("NOT _late").drop("_late")
        low, high = rows.where("_late").agg(F.date_sub(F.min(day), 1), F.date_add(F.max(day), 1)).first()
        stored_late = None
        if low is not None:
            if is_stored(spark, path):
                # What an earlier attempt of this batch has written does not count.
                near = spark.read.parquet(path).where((F.col("batch_id") < batch) & F.col(day).between(F.lit(low), F.lit(high)))
                late = late.join(near.select(key), key, "left_anti")
            late = cut_lineage(late)
            stored_late = late.agg(F.max(when)).first()[0]
        if bound is not None and late_newest is not None and late_newest > bound - within:
            floor = F.lit(bound - within)
            recent = spark.read.parquet(late_path).where((F.col("batch_id") < batch) & (F.col(day) >= F.to_date(floor)) & (F.col(when) > floor))
            in_time = in_time.join(recent.select(key), key, "left_anti")
        write_days(in_time.unionByName(late), batch, path, day, seen.get["rows"])
        if stored_late is not None:
            write_days(late, batch, late_path, day, seen.get["rows"])
        _record(spark, path, batch, seen.get["newest"], stored_late, 0 if low is None else (high - low).days + 1)

    return each_batch(both, checkpoint, write)


def _one_a_key(df: DataFrame, key: str, when: str, bound: datetime | None) -> DataFrame:
    """The earliest row of each key that the state let pass or that has a late row, with ``_late``; in one pass over ``df``.

    Combined before the shuffle. Rows without key or time get a number of their
    own, so they do not meet in one task.
    """
    columns = [c for c in df.columns if c != "_passed"]
    alone = F.when(F.col(key).isNull() | F.col(when).isNull(), F.monotonically_increasing_id())
    order = F.when(~F.col("_passed"), F.struct(F.col(when), F.xxhash64(*columns)))
    is_late = F.coalesce(F.col(when) <= F.lit(bound), F.lit(False)) if bound else F.lit(False)
    keys = df.withColumn("_alone", alone).withColumn("_is_late", is_late & F.col("_alone").isNull())
    found = keys.groupBy(F.col(key).alias("_key"), "_alone").agg(
        F.min_by(F.struct(*columns), order).alias("_row"), F.max("_passed").alias("_any"), F.max("_is_late").alias("_late")
    )
    return found.where("_any OR _late OR _alone IS NOT NULL").select("_row.*", "_late")


def _seen_before(spark: SparkSession, path: str, batch: int) -> tuple[datetime | None, datetime | None]:
    """Newest event and newest late row of the batches before this one."""
    if not is_stored(spark, f"{path}-progress"):
        return None, None
    done = spark.read.parquet(f"{path}-progress").where(F.col("batch_id") < batch)
    return tuple(done.agg(F.max("newest"), F.max("late_newest")).first())


def _record(spark: SparkSession, path: str, batch: int, newest: datetime | None, late_newest: datetime | None, days_read: int) -> None:
    row = spark.range(1).select(
        F.lit(newest).cast("timestamp").alias("newest"), F.lit(late_newest).cast("timestamp").alias("late_newest"), F.lit(days_read).alias("days_read")
    )
    write_batch(row, batch, f"{path}-progress")
