"""Streaming jobs R1-R7, each run to completion over the given tables as a file stream."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.loads.partitions import read_table
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import query, r
from tidemark.session import run_dir
from tidemark.sources.fixtures import FIXTURES
from tidemark.sources.files import stream_table
from tidemark.streaming import jobs as S
from tidemark.streaming.bounded import dedup_in_time


def _stream(t, fixture: str, base: str) -> DataFrame:
    """A fixture over the stream of its base table."""
    text = FIXTURES[fixture].replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return t.spark.sql(text, **{base: stream_table(t.spark, t.path(base))})


#: Events in a file of the scattered copies, about; the files of a batch grow in number, not in size.
ROWS_A_FILE = 100_000


def _files_a_batch(events: DataFrame, batches: int) -> int:
    return max(1, math.ceil(events.count() / (batches * ROWS_A_FILE)))


def _ops_stream(t) -> DataFrame:
    """The operations events in four batches that each hold events of the whole time."""
    folder, each = run_dir(t.spark, "scattered"), _files_a_batch(t.events, 4)
    t.events.repartition(4 * each, "event_id").write.parquet(folder)
    text = FIXTURES["ops_events"].replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return t.spark.sql(text, events=stream_table(t.spark, folder, each)).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ltz"))


def _with_copies(events: DataFrame) -> DataFrame:
    """Every fifth event arrives a second time, up to nine minutes later."""
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.col("event_id") % 10)).otherwise(F.array(F.lit(0)))
    return events.withColumn("_delay", F.explode(copies)).withColumn("event_timestamp", F.col("event_timestamp") + F.make_interval(mins=F.col("_delay").cast("int"))).drop("_delay")


def _ingested(t) -> tuple[str, str]:
    fields = ["event_id", "event_timestamp", "event_type", "source_system", "status", F.col("latency_ms").cast("double").alias("latency_ms"), "payload"]
    raw = _with_copies(_ops_stream(t)).select(F.to_json(F.struct(*fields)).alias("body"))
    path, late = run_dir(t.spark, "events"), run_dir(t.spark, "late")
    S.ingest_events(raw, path, run_dir(t.spark, "ck"), late).awaitTermination()
    return path, late


@query("r1_ingest_events", "SELECT event_id, event_date, event_type, source_system, status, payload FROM ops_events")
def _(t):
    path, _ = _ingested(t)
    return read_table(t.spark, path).select("event_id", "event_date", "event_type", "source_system", "status", "payload")


@query("r1_late_events", "SELECT count(*) AS late_not_stored, true AS some_late FROM ops_events WHERE false")
def _(t):
    """The side table records late events without taking them out of the table."""
    path, late = _ingested(t)
    aside, stored = read_table(t.spark, late), read_table(t.spark, path)
    return aside.join(stored, "event_id", "left_anti").agg(F.count("*").alias("late_not_stored")).withColumn("some_late", F.lit(not aside.isEmpty()))


def _with_damage() -> Column:
    """Text of an event: every seventh is cut off, every eleventh has no id, every thirteenth no time."""
    fields = ["event_type", "source_system", "status", F.col("latency_ms").cast("double").alias("latency_ms"), "payload"]
    has = lambda n, c: F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)
    whole = F.to_json(F.struct(has(11, "event_id"), has(13, "event_timestamp"), *fields))
    return F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_ty'))).otherwise(whole)


@query(
    "r1_unreadable_events",
    """WITH k AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'unreadable' WHEN event_id % 11 = 0 THEN 'no id' WHEN event_id % 13 = 0 THEN 'no time' ELSE 'stored' END AS outcome FROM ops_events)
       SELECT outcome, count(*) AS events FROM k GROUP BY outcome""",
)
def _(t):
    """Every line read is stored or set aside with its reason."""
    raw = _ops_stream(t).select(_with_damage().alias("body"))
    path, aside = run_dir(t.spark, "events"), run_dir(t.spark, "aside")
    S.ingest_events(raw, path, run_dir(t.spark, "ck"), aside_path=aside).awaitTermination()
    stored = read_table(t.spark, path).select(F.lit("stored").alias("outcome"))
    return stored.union(read_table(t.spark, aside).select("reason")).groupBy("outcome").agg(F.count("*").alias("events"))


@query("r2_dedup_events", "SELECT event_id, event_type FROM ops_events")
def _(t):
    path = run_dir(t.spark, "dedup")
    S.dedup_stream(_with_copies(_ops_stream(t)), path, run_dir(t.spark, "ck")).awaitTermination()
    return read_table(t.spark, path).select("event_id", "event_type")


@query("r2_dedup_in_time", "SELECT event_id, event_type FROM ops_events")
def _(t):
    """Five batches that each hold events of the whole time, with copies; the job stops after two and starts again."""
    folder, path, ck = (run_dir(t.spark, x) for x in ("scattered", "dedup", "ck"))
    events = t.ops_events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ltz"))
    each = _files_a_batch(events, 5)
    copies = _with_copies(events).withColumn("_batch", F.pmod(F.xxhash64("event_id", "event_timestamp"), F.lit(5)))
    copies.where("_batch < 2").drop("_batch").repartition(2 * each, "event_id", "event_timestamp").write.parquet(folder)
    dedup_in_time(stream_table(t.spark, folder, each), path, ck).awaitTermination()
    copies.where("_batch >= 2").drop("_batch").repartition(3 * each, "event_id", "event_timestamp").write.mode("append").parquet(folder)
    dedup_in_time(stream_table(t.spark, folder, each), path, ck).awaitTermination()
    return read_table(t.spark, path).select("event_id", "event_type")


@query(
    "r3_hourly_events",
    f"""SELECT date_trunc('hour', event_timestamp) AS event_hour, source_system, event_type, count(*) AS event_count, {r('sum(latency_ms)::DOUBLE / count(latency_ms)', 0)} AS avg_latency_ms,
        count(*) FILTER (status = 'FAILURE') AS failures FROM ops_events GROUP BY ALL""",
)
def _(t):
    path = run_dir(t.spark, "hourly")
    S.hourly_events(_ops_stream(t), path, run_dir(t.spark, "ck")).awaitTermination()
    return S.latest_hours(read_table(t.spark, path)).withColumn("event_hour", F.col("event_hour").cast("timestamp_ntz"))


@query(
    "r4_volume_guard",
    """WITH b AS (SELECT min(date_trunc('hour', event_timestamp)) AS lo, max(date_trunc('hour', event_timestamp)) AS hi, count(*) AS n FROM ops_events),
       w AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS window_start, n / (date_sub('hour', lo, hi) + 1) AS base FROM b),
       c AS (SELECT date_trunc('hour', event_timestamp) AS window_start, count(*) AS k FROM ops_events GROUP BY 1)
       SELECT window_start, coalesce(k, 0) AS events FROM w LEFT JOIN c USING (window_start) WHERE coalesce(k, 0) <= 0.6 * base AND window_start < (SELECT hi FROM b)""",
)
def _(t):
    baseline = S.baseline_rate(t.ops_events, 60).first().per_window  # one number
    path = run_dir(t.spark, "guard")
    S.volume_guard(_ops_stream(t), path, run_dir(t.spark, "ck"), minutes=60).awaitTermination()
    low = S.low_windows(read_table(t.spark, path), baseline, 60)
    return low.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "events")


@query(
    "r5_late_rows",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'late' ELSE 'main' END AS target FROM ops_events""",
)
def _(t):
    """Every ninth event is loaded two days after it happened."""
    loaded = F.col("event_timestamp") + F.make_interval(hours=F.when(F.col("event_id") % 9 == 0, 48).otherwise(1))
    rows = _ops_stream(t).withColumn("loaded_at", loaded)
    main, side = run_dir(t.spark, "main"), run_dir(t.spark, "late")
    S.late_rows(rows, main, side, run_dir(t.spark, "ck"), "loaded_at", "event_timestamp", "12 HOURS").awaitTermination()
    on_time = read_table(t.spark, main).select("event_id", F.lit("main").alias("target"))
    return on_time.unionByName(read_table(t.spark, side).select("event_id", F.lit("late").alias("target")))


@query(
    "r6_receipts",
    """SELECT received_date, CASE WHEN hour(received_timestamp) < 6 THEN 'NIGHT' WHEN hour(received_timestamp) < 12 THEN 'MORNING' WHEN hour(received_timestamp) < 18 THEN 'AFTERNOON' ELSE 'EVENING' END AS received_day_part,
       warehouse_code, count(*) AS receipts, sum(quantity)::BIGINT AS units, count(*) FILTER (quantity = 0) AS zero_receipts FROM receipts GROUP BY ALL""",
)
def _(t):
    path = run_dir(t.spark, "receipts")
    S.receipts_by_window(_stream(t, "receipts", "lineitem"), path, run_dir(t.spark, "ck")).awaitTermination()
    measures = [F.sum(c).alias(c) for c in ("receipts", "units", "zero_receipts")]
    return read_table(t.spark, path).groupBy("received_date", "received_day_part", "warehouse_code").agg(*measures)


@query(
    "r7_dq_alert_tick",
    "SELECT 'DQ' AS alert_type, concat('DQ score ', dq_score::VARCHAR, ' in run ', run_id) AS subject, target_table AS source_table FROM pipeline_runs WHERE dq_score < 95",
)
def _(t):
    path = run_dir(t.spark, "alerts")
    S.dq_alert_tick(_stream(t, "pipeline_runs", "orders"), path, run_dir(t.spark, "ck"), 95, NOW).awaitTermination()
    return read_table(t.spark, path).select("alert_type", "subject", "source_table")
