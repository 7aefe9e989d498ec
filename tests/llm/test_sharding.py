"""The permutation is a bijection that can be computed from one number; shards are gapless and even."""

from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from tidemark.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_bijection(n):
    assert sorted(sharding.permute(range(n), n).tolist()) == list(range(n))
    assert n < 5 or sharding.permute(range(n), n).tolist() != sharding.permute(range(n), n, seed=1).tolist()


def test_one_row_without_the_others():
    places = sharding.permute(range(1000), 1000)
    assert all(sharding.locate(k, 1000, 16) == (places[k] % 16, places[k] // 16) for k in range(0, 1000, 37))


def test_neighbours_are_spread():
    places = sharding.permute(range(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), places)[0, 1]) < 0.05


def test_documents(spark):
    rows = [(k, f"text {k}" * (k % 5), "z") for k in range(100)] + [(7, "same", "z")] * 40 + [(None, None, "z"), (101, "", "z"), (102, "é😀", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    got = sharding.shard_documents(df, 16).collect()
    again = sharding.shard_documents(df.repartition(5), 16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert set(slots) == set(range(16)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_no_rows(spark):
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
