"""Deduplication with bounded state: in-time copies from the state, late ones from stored days, none lost."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.loads.partitions import read_table
from tidemark.session import run_dir
from tidemark.sources.files import stream_table
from tidemark.streaming.bounded import dedup_in_time

T0 = dt.datetime(2024, 1, 1, 10, 0)
LAYOUT = "event_id long, event_timestamp timestamp, note string"


@pytest.fixture
def job(spark):
    source, out, ck = (run_dir(spark, x) for x in ("src", "out", "ck"))

    def send(*events):
        """One file, read as one batch: (id, minutes after the start or None)."""
        rows = [(i, None if m is None else T0 + dt.timedelta(minutes=m), f"{i}@{m}") for i, m in events]
        spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(source)
        raw = stream_table(spark, source, 1).withColumn("event_date", F.to_date("event_timestamp"))
        dedup_in_time(raw, out, ck, within_minutes=15).awaitTermination()

    send.stored = lambda: sorted(r.note for r in read_table(spark, out).collect())
    send.late = lambda: sorted(r.note for r in read_table(spark, f"{out}-late").collect())
    send.days_read = lambda: [r.days_read for r in read_table(spark, f"{out}-progress").orderBy("batch_id").collect()]
    send.path = out
    return send


def test_copies_in_time_need_no_stored_rows(job):
    job((1, 0), (2, 1), (1, 3))
    job((2, 10), (3, 12))
    job((3, 14), (4, 30))
    job((4, 40), (5, 60))
    assert job.stored() == ["1@0", "2@1", "3@12", "4@30", "5@60"]
    assert set(job.days_read()) == {0}


def test_late_rows_are_kept_once(job):
    job((1, 0), (2, 100))
    job((1, 5), (3, 20), (3, 25), (4, 101))
    job((3, 20), (1, 0))
    job((2, 100), (4, 101), (5, 200))
    job((2, 100), (6, 100), (6, 100))
    assert job.stored() == ["1@0", "2@100", "3@20", "4@101", "5@200", "6@100"]
    assert job.late() == ["3@20", "6@100"]


def test_a_copy_in_time_of_a_late_row_is_found(job):
    job((1, 0), (2, 100))
    job((7, 84),)  # just behind the mark at 85, so the state forgets it
    job((7, 90),)  # its copy is in time
    assert job.stored() == ["1@0", "2@100", "7@84"]


def test_rows_without_key_or_time_are_each_stored(job):
    job((1, 0), (None, 1), (None, 1), (2, None), (2, None))
    job((None, 200), (None, 1), (2, None))
    job((None, 1), (1, 0))
    assert job.stored() == ["1@0", "2@None", "2@None", "2@None", "None@1", "None@1", "None@1", "None@1", "None@200"]


def test_in_time_batches_do_not_open_the_table(job, tmp_path):
    job((1, 0), (2, 1))
    from pathlib import Path

    files = [p for p in Path(job.path.removeprefix("file:")).rglob("*.parquet")]
    assert files
    for p in files:
        p.write_bytes(b"not readable")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    job((1, 4), (3, 5))
    assert job.days_read()[-1] == 0


@pytest.mark.parametrize("seed", [3])
def test_any_order_of_arrival_gives_each_key_once(job, seed):
    """Copies lie up to 15 minutes apart and arrive in any batch; the start of the job is repeated before each."""
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        at = rng.randrange(0, 600)
        rows += [(i, at + rng.randrange(0, 15)) for _ in range(rng.randrange(1, 4))]
    rng.shuffle(rows)
    for k in range(5):
        job(*rows[k::5])
    assert sorted(int(n.split("@")[0]) for n in job.stored()) == list(range(60))


def test_a_batch_writes_a_day_in_one_file(spark, job):
    job(*[(i, i % 9) for i in range(300)])
    assert len(spark.read.parquet(job.path).inputFiles()) == 1
    assert len(job.stored()) == 300
