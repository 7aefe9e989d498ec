"""Hard negatives against scoring every pair."""

import math

import numpy as np
import pytest
from conftest import SMALL

from tidemark.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, score string"
TINY = {"part": 60, "sample": 64, "most_cells": 4, "leaf": 8}


def brute(rows, every=50):
    kept = {}
    for i, x, label, *_ in rows:
        if label is None or x is None or any(e is None or not math.isfinite(e) for e in x):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept[i, label, tuple(math.floor(256 * float(np.float32(e))) for e in x)] = None
    kept = list(kept)
    out = []
    for i, label, x in kept:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), math.inf if j is None else j, j, other) for j, other, y in kept if j != i]
        scored.sort(key=lambda s: s[:2])
        for p, _, positive, other in [s for s in scored if s[3] == label][:5]:
            fits = [(-s, j) for s, _, j, o in scored if o != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(i, positive, k, j, -p, s) for k, (s, j) in enumerate(fits[:3], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r))


def found(df):
    return order(tuple(r) for r in df.collect())


def crowd(seed, n=600, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + 0.2 * rng.normal(size=(n, dim))
    x[: n // 3] = centres[0]  # a third of all rows are one vector
    x[n // 3 : n // 3 + 20] = 0
    return [(k, [float(np.float32(e)) for e in v], int(rng.integers(0, 4)), "r", "s") for k, v in enumerate(x)]


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert want and found(negatives.hard_negatives(df)) == order(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_many_cells_and_parts(spark, seed):
    rows = crowd(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(negatives.mine(df, lambda i: i % 50 == 0, negatives.turned, **TINY)) == order(brute(rows)) != []


def test_the_tree_leaves_siblings_out():
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.repeat(rng.normal(size=(20, 8)), 200, axis=0) + 3 * rng.normal(size=(4000, 8)))
    radius = float(np.sqrt((x**2).sum(1)).max())
    finder = negatives.Finder(np.arange(4000), np.zeros(4000, int), x, radius, 5, True, leaf=64)
    q = x[::400]
    who, row, score = finder.find(q, np.arange(0, 4000, 400), np.zeros(10, int), np.full(10, -np.inf), np.full(10, np.inf))
    assert finder.scored < 0.3 * 10 * 4000
    for k in range(10):
        s = x @ q[k]
        s[400 * k] = -np.inf
        best = np.lexsort((np.arange(4000), -s))[:5]
        assert row[who == k].tolist() == best.tolist() and score[who == k].tolist() == s[best].tolist()


def test_a_cell_out_of_reach_gets_no_question():
    rng = np.random.default_rng(5)
    x = np.floor(256 * np.repeat(np.eye(8), 50, axis=0) + rng.normal(size=(400, 8)))
    radius = float(np.sqrt((x**2).sum(1)).max())
    cells = negatives.Cells(x, radius, 8)
    _, ranges = cells.place(x)
    cells.measure(ranges)
    who, _ = cells.reached(x[:1], np.array([0.9 * 256**2]), np.array([np.inf]))
    assert cells.n >= 8 and 1 <= len(who) <= 2


def test_rows_that_take_no_part_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1, "r", "s"), (0, [1.0, 0.5], 1, "r", "s"), (1, [0.9, 0.5], 1, "", ""), (1, [0.9, 0.5], 1, "", ""), (2, [0.8, 0.1], 2, "", ""), (3, [0.7, 0.1], 3, "", ""),
        (4, [0.6], 2, "", ""), (5, [], 2, "", ""), (6, [nan, 1.0], 2, "", ""), (7, [0.8, 0.1], 1, "", ""), (8, [inf, 1.0], 2, "", ""), (9, [None, 1.0], 2, "", ""), (10, None, 2, "", ""),
        (11, [0.8, 0.1], None, "", ""), (None, [0.8, 0.1], 2, "", ""), (None, [0.9, 0.4], 1, "", ""), (50, [0.0, 0.0], 1, "", ""), (50, [-1.0, 0.0], 1, "", ""), (0, [0.7, 0.7], 4, "", ""), (12, [0.0, 0.0], 3, "", ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(negatives.hard_negatives(df)) == order(brute(rows)) != []


def test_nothing_to_find(spark):
    for rows in ([], [(0, None, None, None, None)], [(0, [1.0], 1, "", "")], [(0, [], 1, "", ""), (1, [], 1, "", "")], [(50, [1.0], 1, "", ""), (51, [1.0], 1, "", "")]):
        assert negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []
