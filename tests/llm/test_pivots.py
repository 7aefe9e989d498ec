"""Pivot search against brute force: recall, exact scores, ties, copies and vectors that take no part."""

import numpy as np
from conftest import SMALL

from tidemark.llm import pivots

SCHEMA = "vec_id bigint, embedding array<float>, rank string"


def brute(rows, every, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in ids[ids % every == 0]:
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def answers(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, np.float32(r.embedding)) for r in df.collect()]
    want, got = brute(rows, 100), answers(pivots.nearest(df))
    hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(v) for q, v in want.items()}
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0])) and len(found) == 10
        assert all(abs(s - exact[q].get(a, s)) < 1e-12 for a, s in found)


def test_recall_over_shards_and_a_crowd(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    x = np.concatenate([rng.normal(size=(1500, 16)), centre + 1e-3 * rng.normal(size=(1500, 16))]).astype(np.float32)
    rows = [(k, v.tolist(), "r") for k, v in enumerate(x)]
    got = answers(pivots.search(spark.createDataFrame(rows, SCHEMA), lambda i: i % 100 == 0, shard=1000, block=8, length=128, pivots=256))
    want = brute(rows, 100)
    hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_copies_tie_to_the_smaller_id(spark):
    rows = [(k, [1.0, 2.0], None) for k in range(1000)] + [(5000, [9.0, 9.0], None)]
    got = answers(pivots.search(spark.createDataFrame(rows, SCHEMA), lambda i: i == 500, shard=300, least=20))
    assert got == {500: [(k, 0.0) for k in range(10)]}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (100, None, None), (200, [0.0, 0.0], None), (300, [nan, 1.0], None), (1, [2.0, 0.0], None), (2, [inf, 0.0], None), (3, [1.0, None], None), (None, [1.0, 1.0], None), (4, [], None), (5, [1.0, 0.0, 0.0], None), (0, [1.0, 0.0], "a")]
    assert answers(pivots.nearest(spark.createDataFrame(rows[:-1], SCHEMA))) == {0: [(1, 1.0)]}
    assert pivots.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
