"""Structured Streaming jobs.

Every job takes a streaming DataFrame and writes with a checkpoint in the shared
folder. Batch writes are keyed by batch id or replace what they touch, so a
batch repeated after a failure leaves the same rows.

No job drops an event for being late. Copies are found in the stored days
rather than in a state that forgets (``bounded`` combines both), and counts are written as parts that add
up, so a late event changes the hour it belongs to. What came late is also
recorded aside for restatement. Text that is no event, or an event without an
id or a time, is set aside with the reason: lines read are stored, copies of
stored ones, or set aside.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import count_where, half_up
from tidemark.operators.alerts import alert_rows
from tidemark.session import cut_counted

EVENT_SCHEMA = "event_id BIGINT, event_timestamp TIMESTAMP_LTZ, event_type STRING, source_system STRING, status STRING, latency_ms DOUBLE, payload STRING"

#: Rows of a batch for which each of its days is written in one more part.
ROWS_A_PART = 1_000_000


def parse_events(raw: DataFrame, body: str = "body", schema: str = EVENT_SCHEMA) -> DataFrame:
    """Typed events from JSON text; the event day is the partition."""
    return raw.select(F.from_json(body, schema).alias("e")).select("e.*").withColumn("event_date", F.to_date("event_timestamp"))


def read_events(raw: DataFrame, body: str = "body", schema: str = EVENT_SCHEMA) -> DataFrame:
    """``parse_events`` with the text, ``body``, and the ``reason`` why it cannot be stored as an event, null for good ones."""
    corrupt = "_corrupt"
    found = F.from_json(body, f"{schema}, {corrupt} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = raw.select(F.col(body).alias("body"), found.alias("e")).select("body", "e.*")
    reason = (
        F.when(F.col("body").isNull() | (F.trim("body") == ""), "empty")
        .when(F.col(corrupt).isNotNull(), "unreadable")
        .when(F.col("event_id").isNull(), "no id")
        .when(F.col("event_timestamp").isNull(), "no time")
    )
    return rows.withColumn("reason", reason).drop(corrupt).withColumn("event_date", F.to_date("event_timestamp"))


def is_stored(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def dedup_stream(
    events: DataFrame, path: str, checkpoint: str, late_path: str | None = None, within: str = "15 minutes",
    key: str = "event_id", when: str = "event_timestamp", day: str = "event_date",
) -> StreamingQuery:
    """R2: one row per key in a table partitioned by day, whatever order the events arrive in.

    A batch keeps the earliest of its own copies and drops those whose key is
    stored within a day of it; only the key column of those days is read. Rows
    without a key have no copies and are stored each. Rows older than the newest
    stored event by more than ``within`` are written to ``late_path`` as well.
    """
    return each_batch(events, checkpoint, _dedup_writer(path, late_path, within, key, when, day))


def _dedup_writer(path: str, late_path: str | None, within: str, key: str, when: str, day: str) -> Callable[[DataFrame, int], None]:
    gap = F.expr(f"INTERVAL {within}")

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        first = Window.partitionBy(key).orderBy(when, F.xxhash64(*df.columns))
        keyed = df.where(F.col(key).isNotNull()).withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")
        rows = keyed.unionByName(df.where(F.col(key).isNull()))
        newest = None
        if is_stored(spark, path):
            # What an earlier attempt of this batch has written does not count.
            stored = spark.read.parquet(path).where(F.col("batch_id") < batch)
            low, high, newest = df.agg(F.date_sub(F.min(day), 1), F.date_add(F.max(day), 1)).withColumn("_newest", _newest_event(stored, day, when).scalar()).first()
            near = stored.where(F.col(day).between(F.lit(low), F.lit(high))).select(key)
            rows = rows.join(near, key, "left_anti")
        rows, n = cut_counted(rows)
        write_days(rows, batch, path, day, n)
        if late_path is not None and newest is not None:
            write_batch(rows.where(F.col(when) < F.lit(newest) - gap), batch, late_path)

    return write


def _newest_event(stored: DataFrame, day: str, when: str) -> DataFrame:
    """Time of the newest stored event, from the newest day alone."""
    return stored.where(F.col(day) == stored.agg(F.max(day)).scalar()).agg(F.max(when).alias("newest"))


def write_parts(df: DataFrame, path: str, parts: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_days(df: DataFrame, batch: int, path: str, day: str, rows: int) -> None:
    """Replace this batch id in the days of about ``rows`` rows.

    Days are gathered first, each in a part for every ``ROWS_A_PART`` rows of the
    batch, so files grow with the rows and not with tasks times days. A plain
    shuffle, as stateful streams run without adaptive execution.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(max(1, math.ceil(rows / ROWS_A_PART))))
    write_parts(df.repartition(day, part).withColumn("batch_id", F.lit(batch)), path, [day, "batch_id"])


def ingest_events(
    raw: DataFrame, path: str, checkpoint: str, late_path: str | None = None, within: str = "15 minutes", aside_path: str | None = None
) -> StreamingQuery:
    """JSON events to daily partitions, one row per event id; late ones also aside.

    What cannot be stored goes to ``aside_path`` (by default beside the table) by
    batch, as the text and the reason.
    """
    aside = aside_path or f"{path}-aside"
    store = _dedup_writer(path, late_path, within, "event_id", "event_timestamp", "event_date")

    def write(df: DataFrame, batch: int) -> None:
        df.persist()
        write_batch(df.where("reason is not null").select("body", "reason"), batch, aside)
        store(df.where("reason is null").drop("body", "reason"), batch)
        df.unpersist()

    return each_batch(read_events(raw), checkpoint, write)


def each_batch(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    return df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_batch(df: DataFrame, batch: int, path: str) -> None:
    """Replace the partition of this batch id, so a repeated batch does not add rows twice."""
    write_parts(df.withColumn("batch_id", F.lit(batch)), path, ["batch_id"])


HOUR_KEYS = ["event_hour", "source_system", "event_type"]
HOUR_VALUES = ["event_count", "latency_sum", "latency_n", "failures"]


def hourly_parts(events: DataFrame) -> DataFrame:
    """Counts, latency sums and failures by hour, system and type; parts of several batches add up."""
    return events.groupBy(F.date_trunc("hour", "event_timestamp").alias("event_hour"), "source_system", "event_type").agg(
        F.count("*").alias("event_count"), F.sum("latency_ms").alias("latency_sum"), F.count("latency_ms").alias("latency_n"),
        count_where(F.col("status") == "FAILURE").alias("failures"),
    )


def hourly_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the hourly table current. Each batch adds its part to the hours of its events, late ones too."""
    return each_batch(events, checkpoint, lambda df, batch: write_batch(hourly_parts(df), batch, path))


def summed_hours(table: DataFrame) -> DataFrame:
    """One row per hour over all batches."""
    return table.groupBy(*HOUR_KEYS).agg(*[F.sum(c).alias(c) for c in HOUR_VALUES])


def compact_hours(table: DataFrame, path: str) -> None:
    """Copy the sums to a new path as the part of the newest batch, so the table stops growing with the number of batches."""
    newest = table.agg(F.max("batch_id")).scalar()
    summed_hours(table).withColumn("batch_id", newest).write.partitionBy("batch_id").parquet(path)


def latest_hours(table: DataFrame) -> DataFrame:
    """R3 as a report: counts, mean latency and failures of each hour."""
    mean = F.try_divide(F.col("latency_sum").cast("double"), F.col("latency_n").cast("double"))
    return summed_hours(table).select(*HOUR_KEYS, "event_count", half_up(mean, 0).alias("avg_latency_ms"), "failures")


def baseline_rate(history: DataFrame, minutes: int, when: str = "event_timestamp") -> DataFrame:
    """Mean events per window over the span of the history, empty windows included."""
    first, last = F.min(when).cast("timestamp_ltz"), F.max(when).cast("timestamp_ltz")
    width = 60 * minutes
    windows = F.floor(F.unix_seconds(last) / width) - F.floor(F.unix_seconds(first) / width) + 1
    return history.agg((F.count("*") / windows).alias("per_window"))


def volume_guard(events: DataFrame, path: str, checkpoint: str, minutes: int = 5, when: str = "event_timestamp") -> StreamingQuery:
    """Counts by window as parts that add up; a late event counts in its own window."""

    def write(df: DataFrame, batch: int) -> None:
        parts = df.groupBy(F.window(when, f"{minutes} minutes").alias("w")).agg(F.count("*").alias("events"))
        write_batch(parts.select(F.col("w.start").alias("window_start"), "events"), batch, path)

    return each_batch(events, checkpoint, write)


def low_windows(parts: DataFrame, per_window: float, minutes: int, floor: float = 0.6) -> DataFrame:
    """Closed windows whose volume fell below the guardrail, those without any event included.

    The newest window is still open and is not judged. Judged anew over the sums
    of all parts, so a window filled by late events is taken off again.
    """
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    sums = parts.groupBy("window_start").agg(F.sum("events").alias("events"))
    bounds = sums.agg(F.min("window_start").alias("lo"), (F.max("window_start") - step).alias("hi")).where("lo <= hi")
    span = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("window_start"))
    filled = span.join(sums, "window_start", "left").select("window_start", F.coalesce("events", F.lit(0)).alias("events"))
    return filled.where(F.col("events") <= floor * per_window)


def is_late(loaded: str, happened: str, limit: str) -> Column:
    return F.col(loaded) > F.col(happened) + F.expr(f"INTERVAL {limit}")


def late_rows(rows: DataFrame, main: str, side: str, checkpoint: str, loaded: str, happened: str, limit: str) -> StreamingQuery:
    """Rows loaded later than the limit go to a side table for restatement, all others to the main table.

    The split happens before any watermark, so no late row is lost.
    """

    def split(df: DataFrame, batch: int) -> None:
        late = F.coalesce(is_late(loaded, happened, limit), F.lit(False))
        df.persist()
        write_batch(df.where(~late), batch, main)
        write_batch(df.where(late), batch, side)
        df.unpersist()

    return each_batch(rows, checkpoint, split)


def day_part(hour: Column) -> Column:
    return F.when(hour < 6, "NIGHT").when(hour < 12, "MORNING").when(hour < 18, "AFTERNOON").otherwise("EVENING")


def receipt_columns(receipts: DataFrame) -> DataFrame:
    hour = F.hour("received_timestamp")
    return receipts.withColumn("received_hour", hour).withColumn("received_day_part", day_part(hour))


def receipts_by_window(receipts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Receipts and units by day, day part and warehouse, added up over batches.

    Sums and counts add up, so each batch writes its own part and readers sum the parts.
    """

    def write(df: DataFrame, batch: int) -> None:
        parts = receipt_columns(df).groupBy("received_date", "received_day_part", "warehouse_code").agg(
            F.count("*").alias("receipts"), F.sum("quantity").alias("units"), count_where(F.col("quantity") == 0).alias("zero_receipts")
        )
        write_batch(parts, batch, path)

    return each_batch(receipts, checkpoint, write)


def dq_alert_tick(runs: DataFrame, path: str, checkpoint: str, floor: float, as_of_ts: str) -> StreamingQuery:
    """Alerts for newly arrived runs scoring below the floor; one tick handles what arrived since the last."""
    low = runs.where(F.col("dq_score") < floor)
    subject = F.concat(F.lit("DQ score "), F.col("dq_score").cast("string"), F.lit(" in run "), F.col("run_id").cast("string"))
    alerts = alert_rows(low, "DQ", F.lit("HIGH"), subject, F.lit("Score below the floor."), F.col("target_table"), as_of_ts)
    return each_batch(alerts, checkpoint, lambda df, batch: write_batch(df, batch, path))


