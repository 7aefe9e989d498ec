"""Streaming jobs over several files: copies, late rows, restart from the checkpoint."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.loads.partitions import read_table
from tidemark.session import run_dir
from tidemark.sources.files import stream_table
from tidemark.streaming import jobs as S

T0 = dt.datetime(2024, 1, 1, 10, 0)
LAYOUT = "event_id long, event_timestamp timestamp, event_type string, source_system string, status string, latency_ms double"


def add_file(spark, path, events):
    data = [(i, T0 + dt.timedelta(minutes=m), "A", "APP", status, 10.0) for i, m, status in events]
    spark.createDataFrame(data, LAYOUT).coalesce(1).write.mode("append").parquet(path)


def test_copies_are_dropped_across_batches_and_restarts(spark):
    source, out, ck = (run_dir(spark, x) for x in ("src", "out", "ck"))

    def tick():
        raw = stream_table(spark, source, 1).select(F.to_json(F.struct("*")).alias("body"))
        S.ingest_events(raw, out, ck).awaitTermination()

    add_file(spark, source, [(1, 0, "SUCCESS"), (2, 1, "SUCCESS"), (1, 3, "SUCCESS")])
    tick()
    add_file(spark, source, [(2, 4, "SUCCESS"), (3, 5, "SUCCESS")])
    tick()
    tick()
    assert sorted(r.event_id for r in read_table(spark, out).collect()) == [1, 2, 3]


def test_hourly_table_after_several_batches(spark):
    source, out, ck = (run_dir(spark, x) for x in ("src", "out", "ck"))
    add_file(spark, source, [(1, 0, "SUCCESS"), (2, 70, "FAILURE")])
    S.hourly_events(stream_table(spark, source, 1), out, ck).awaitTermination()
    add_file(spark, source, [(3, 75, "FAILURE"), (4, 80, "SUCCESS")])
    S.hourly_events(stream_table(spark, source, 1), out, ck).awaitTermination()
    got = {r.event_hour: (r.event_count, r.failures) for r in S.latest_hours(read_table(spark, out)).collect()}
    assert got == {T0: (1, 0), T0 + dt.timedelta(hours=1): (3, 2)}
    small = run_dir(spark, "compacted")
    S.compact_hours(read_table(spark, out), small)
    compacted = read_table(spark, small)
    assert compacted.count() == 2
    assert sorted(S.latest_hours(compacted).collect()) == sorted(S.latest_hours(read_table(spark, out)).collect())


def test_a_repeated_batch_leaves_the_same_rows(spark):
    path = run_dir(spark, "out")
    S.write_batch(spark.range(3), 0, path)
    S.write_batch(spark.range(5), 1, path)
    S.write_batch(spark.range(5), 1, path)
    assert read_table(spark, path).count() == 8


def test_volume_guard_finds_low_and_silent_windows(spark):
    source, out, ck = (run_dir(spark, x) for x in ("src", "out", "ck"))
    add_file(spark, source, [(i, i % 5, "SUCCESS") for i in range(10)] + [(50, 6, "SUCCESS")] + [(60 + i, 16, "SUCCESS") for i in range(10)] + [(99, 30, "SUCCESS")])
    S.volume_guard(stream_table(spark, source), out, ck, minutes=5).awaitTermination()
    low = {r.window_start: r.events for r in S.low_windows(read_table(spark, out), 10, 5).collect()}
    assert low == {T0 + dt.timedelta(minutes=m): int(m == 5) for m in (5, 10, 20, 25)}


def test_late_rows_are_kept_aside(spark):
    source, main, side, ck = (run_dir(spark, x) for x in ("src", "main", "side", "ck"))
    add_file(spark, source, [(i, i, "SUCCESS") for i in range(6)])
    rows = stream_table(spark, source).withColumn("loaded", F.col("event_timestamp") + F.make_interval(hours=F.when(F.col("event_id") < 2, 30).otherwise(1)))
    S.late_rows(rows, main, side, ck, "loaded", "event_timestamp", "12 HOURS").awaitTermination()
    assert read_table(spark, side).count() == 2 and read_table(spark, main).count() == 4


def test_no_event_is_lost_in_any_order(spark):
    source, out, late, ck, hours = (run_dir(spark, x) for x in ("src", "out", "late", "ck", "hours"))

    def tick():
        raw = stream_table(spark, source, 1).select(F.to_json(F.struct("*")).alias("body"))
        S.ingest_events(raw, out, ck, late).awaitTermination()

    day = 24 * 60
    add_file(spark, source, [(1, 3 * day, "SUCCESS"), (2, 3 * day + 1, "SUCCESS")])
    tick()
    add_file(spark, source, [(3, 0, "SUCCESS"), (1, 3 * day + 2, "SUCCESS"), (4, 3 * day + 3, "SUCCESS")])
    tick()
    add_file(spark, source, [(5, day, "FAILURE"), (3, 5, "SUCCESS")])
    tick()
    tick()
    assert sorted(r.event_id for r in read_table(spark, out).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.event_id for r in read_table(spark, late).collect()) == [3, 5]
    S.hourly_events(stream_table(spark, source, 1), hours, run_dir(spark, "ck")).awaitTermination()
    assert S.latest_hours(read_table(spark, hours)).agg(F.sum("event_count")).first()[0] == 7


def add_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "body string").coalesce(1).write.mode("append").parquet(path)


def test_lines_read_are_stored_copies_or_set_aside(spark):
    source, out, aside, ck = (run_dir(spark, x) for x in ("src", "out", "aside", "ck"))

    def tick():
        S.ingest_events(stream_table(spark, source, 1), out, ck, aside_path=aside).awaitTermination()

    good = '{"event_id": %d, "event_timestamp": "2024-01-01T10:%02d:00Z", "event_type": "A"}'
    no_id = '{"event_timestamp": "2024-01-01T1%d:00:00Z", "event_type": "A"}'
    add_lines(spark, source, [good % (1, 0), good % (1, 3), "not json", no_id % 1, no_id % 2, '{"event_id": 5'])
    tick()
    add_lines(spark, source, [good % (1, 4), good % (2, 5), "not json", None, " ", '{"event_id": 9}'])
    tick()
    tick()
    assert sorted(r.event_id for r in read_table(spark, out).collect()) == [1, 2]
    got = sorted((r.reason, r.body) for r in read_table(spark, aside).where("body is not null").collect())
    assert got == sorted([("unreadable", "not json")] * 2 + [("unreadable", '{"event_id": 5'), ("no id", no_id % 1), ("no id", no_id % 2), ("empty", " "), ("no time", '{"event_id": 9}')])
    # Twelve lines: two stored, two copies, eight set aside.
    assert read_table(spark, aside).count() == 8


def test_rows_without_a_key_are_stored_each(spark):
    source, out, ck = (run_dir(spark, x) for x in ("src", "out", "ck"))
    add_file(spark, source, [(None, 0, "SUCCESS"), (None, 0, "SUCCESS"), (1, 1, "SUCCESS"), (1, 2, "SUCCESS")])
    events = stream_table(spark, source, 1).withColumn("event_date", F.to_date("event_timestamp"))
    S.dedup_stream(events, out, ck).awaitTermination()
    add_file(spark, source, [(None, 0, "SUCCESS"), (1, 3, "SUCCESS")])
    S.dedup_stream(stream_table(spark, source, 1).withColumn("event_date", F.to_date("event_timestamp")), out, ck).awaitTermination()
    assert sorted(str(r.event_id) for r in read_table(spark, out).collect()) == ["1", "None", "None", "None"]


def test_batches_hold_more_files_where_there_are_more_events(spark, tables, monkeypatch):
    from tidemark.plans import p14_streams as plans

    made = []
    monkeypatch.setattr(plans, "ROWS_A_FILE", tables.events.count() // 20)
    monkeypatch.setattr(plans, "run_dir", lambda s, label: made.append(run_dir(s, label)) or made[-1])
    sizes, out = [], run_dir(spark, "ck")
    S.each_batch(plans._ops_stream(tables), out, lambda df, batch: sizes.append(df.count())).awaitTermination()
    assert len(spark.read.parquet(made[0]).inputFiles()) >= 20
    assert len(sizes) == 4 and sum(sizes) == tables.events.count()


def test_files_of_days_do_not_grow_with_the_tasks(spark):
    out = run_dir(spark, "days")
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("id", F.lit(5)).cast("int")).alias("event_date"))
    S.write_days(rows.repartition(16), 0, out, "event_date", 4000)
    stored = spark.read.parquet(out)
    assert len(stored.inputFiles()) == 5 and stored.select("event_id").distinct().count() == 4000
