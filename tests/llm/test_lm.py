"""Language-model scores: base score by hand, a model that sums to one, beats the unigram and repeats itself."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
from conftest import SMALL

from tidemark.llm import lm
from tidemark.llm.common import tokenizer_path


def base_scores(rows):
    words = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: i is not None and crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for i, t in rows]


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, digest string").repartition(3)
    got = sorted(lm.score_documents(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.base_score))
    want = sorted(base_scores(rows), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5] and abs(g.base_score - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert g.score < 0 and math.isfinite(g.score)
    return got


def test_base_score_by_hand(spark):
    rows = [(k, f"Word{k % 3} the\x0bthe of Éa éa {'x ' * k}") for k in range(25)] + [(3, "Word0 the"), (3, "Word0 the"), (None, "null id"), (90, None), (91, ""), (92, "long words " * 9000)]
    got = check(spark, rows)
    assert len({r.score for r in got if r.doc_id in (90, 91)}) == 1


def test_without_training_documents(spark):
    held = next(k for k in range(99) if crc32(str(k).encode()) % 5 == 1)
    check(spark, [(held, "only this one")])
    assert lm.score_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_beats_the_unigram_model_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    path = tokenizer_path()
    train = [t.encode() for i, t in docs.collect() if crc32(str(i).encode()) % 5 != 1]
    test = [t.encode() for i, t in docs.collect() if crc32(str(i).encode()) % 5 == 1]
    coded = lm._coded(train, path)
    counts = sum(np.bincount(c, minlength=lm.VOCABULARY) for c in coded).astype(float)
    classes = lm.Classes(counts)
    assert np.allclose(np.bincount(classes.of, np.exp(classes.log_share), lm.CLASSES), 1)
    model = lm.train(spark.createDataFrame([(bytearray(t),) for t in train], "text binary"), classes, path, rounds=3, one_in=2)
    held = lm._coded(test, path)
    log = np.log((counts + 0.5) / (counts + 0.5).sum())
    assert lm.scores(model, classes, held).sum() > sum(log[c].sum() for c in held)


def test_windows_score_each_id_once():
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    texts = [np.arange(n, dtype=np.int32) for n in (1, lm.BLOCK, lm.BLOCK + 1, 5 * lm.BLOCK + 3)]
    rows, ids, first, owner = lm.blocks_of(texts, classes)
    for k, t in enumerate(texts):
        mine = ids[owner == k].ravel()
        assert mine[mine >= 0].tolist() == t.tolist()
        assert first[owner == k].tolist() == [True] + [False] * (int((owner == k).sum()) - 1)
    model = lm.new_model(classes)
    alone = [float(lm.scores(model, classes, [t])[0]) for t in texts]
    assert np.allclose(alone, lm.scores(model, classes, texts), rtol=1e-5)


def test_later_ids_do_not_change_earlier_ones():
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    model = lm.new_model(classes)
    rng = np.random.default_rng(0)
    long = rng.integers(0, lm.VOCABULARY, 70).astype(np.int32)
    steps = [float(lm.scores(model, classes, [long[:n]])[0]) for n in range(1, 71)]
    assert all(b < a for a, b in zip(steps, steps[1:]))
    other = np.r_[long[:40], rng.integers(0, lm.VOCABULARY, 30)].astype(np.int32)
    assert np.isclose(float(lm.scores(model, classes, [other[:40]])[0]), steps[39])


def test_gradients():
    rng = np.random.default_rng(1)
    model = {k: x.astype(np.float64) for k, x in lm.new_model(lm.Classes(np.ones(lm.VOCABULARY))).items()}
    rows = rng.integers(0, lm.OWN_ROWS, (3, 2 * lm.BLOCK)).astype(np.int16)
    goals = rng.integers(-1, lm.CLASSES, (3, lm.BLOCK))
    first = np.array([True, False, False])
    _, g = lm.gradients(model, rows, goals, first)
    for k in model:
        at = tuple(rng.integers(0, s) for s in model[k].shape) if k != "e" else (int(rows[1, 50]), 3)
        up, down = ({a: b.copy() for a, b in model.items()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        slope = (lm.gradients(up, rows, goals, first)[0] - lm.gradients(down, rows, goals, first)[0]) / 2e-4
        assert abs(slope - g[k][at]) < 1e-3 * max(1e-3, abs(slope))


def test_training_learns_from_every_id_once():
    path = tokenizer_path()
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    texts = [b"", None, b"one two three", b"many words in a row " * 200, b"other " * 31]
    every = np.concatenate([classes.of[c] for c in lm._coded(texts, path)])
    turns = [lm.drawn(texts, classes, path, lm.ONE_IN, r) for r in range(lm.TRAIN_ROUNDS)]
    learned = np.concatenate([goals.ravel() for _, goals, _ in turns])
    assert sorted(learned[learned >= 0].tolist()) == sorted(every.tolist())
    assert sum(int(first.sum()) for _, _, first in turns) == len(texts) and lm.CLASSES >= 64


def test_weights_that_all_underflow():
    """Exponents far below zero in every place of a window: the weights are still shares of one."""
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    low = lm.new_model(classes)
    text = np.arange(3 * lm.BLOCK, dtype=np.int32)
    plain = lm.scores(low, classes, [text])
    low["near"] -= 200
    assert np.allclose(lm.scores(low, classes, [text]), plain, rtol=1e-4)


def test_gradients_of_windows_that_share_blocks():
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    rng = np.random.default_rng(2)
    model = {k: x.astype(np.float64) + rng.normal(0, 0.1, x.shape) for k, x in lm.new_model(classes).items()}
    texts = [rng.integers(0, lm.VOCABULARY, n).astype(np.int32) for n in (5, 4 * lm.BLOCK, 3 * lm.BLOCK + 7)]
    rows, ids, first, _ = lm.blocks_of(texts, classes)
    goals = np.where(ids >= 0, classes.of[np.maximum(ids, 0)].astype(np.int64), -1)
    # The third window is left out, so the fourth follows none.
    kept = np.flatnonzero(np.arange(len(rows)) != 2)
    together = lm.gradients(model, rows[kept], goals[kept], first[kept])
    share = (goals[kept] >= 0).sum(axis=1) / (goals[kept] >= 0).sum()
    alone = [lm.gradients(model, rows[[k]], goals[[k]], first[[k]]) for k in kept]
    assert np.isclose(together[0], sum(s * a[0] for s, a in zip(share, alone)))
    for k in model:
        assert np.allclose(together[1][k], sum(s * a[1][k] for s, a in zip(share, alone)), rtol=1e-4, atol=1e-7)


def test_ids_are_looked_up_once_for_all_steps(spark, monkeypatch):
    """The pass that cuts chunks keeps each document's ids, in order, and marks equal texts: nothing looks them up again."""
    texts = ["Two words", "x " * 700, "", "Two words", "Éa İ. tail;"]
    monkeypatch.setattr(lm, "CHUNK_DOCS", 4)
    df = spark.createDataFrame([(k, k == 2, bytearray(t.encode())) for k, t in enumerate(texts)], "doc_id bigint, held_out boolean, text binary").coalesce(1)
    rows = lm._chunks(df, tokenizer_path()).collect()
    found = [r for r in rows if r.kind == lm.IDS]
    assert [np.frombuffer(r.ids, "<u2").tolist() for r in found] == [c.tolist() for c in lm._coded([t.encode() for t in texts], tokenizer_path())]
    assert [r.mark for r in found] == [crc32(t.encode()) for t in texts] and [r.learned for r in found] == [1, 1, 0, 1, 1]
    assert [r.key is None for r in found] == [False, False, False, True, False]
    assert {r.key for r in found if r.key} == {r.key for r in rows if r.kind == lm.TEXT}
    assert {r.key: r.learned for r in rows if r.kind == lm.WORD and r.chunk == found[0].chunk} == {b"": 3, b"two": 2, b"words": 2, b"x": 700}


def test_gradients_of_more_windows_than_a_step():
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    rng = np.random.default_rng(3)
    model = lm.new_model(classes)
    rows, ids, first, _ = lm.blocks_of([rng.integers(0, lm.VOCABULARY, (lm.STEP + 9) * lm.BLOCK).astype(np.int32)], classes)
    goals = classes.of[ids].astype(np.int64)
    whole, parts = lm.gradients(model, rows, goals, first), [lm.gradients(model, rows[a], goals[a], first[a]) for a in (slice(lm.STEP), slice(lm.STEP, None))]
    share = (lm.STEP / len(rows), 9 / len(rows))
    assert np.isclose(whole[0], sum(s * p[0] for s, p in zip(share, parts)), rtol=1e-5)
    for k in model:
        assert np.allclose(whole[1][k], sum(s * p[1][k] for s, p in zip(share, parts)), rtol=1e-3, atol=1e-6)


def test_exponents_that_overflow():
    """Queries, keys and class terms far above zero take the careful way and leave the shares as they are."""
    classes = lm.Classes(np.ones(lm.VOCABULARY))
    model = lm.new_model(classes)
    text = np.arange(3 * lm.BLOCK, dtype=np.int32)
    plain = lm.scores(model, classes, [text])
    model["near"] += 100
    model["c"] += 100
    assert np.allclose(lm.scores(model, classes, [text]), plain, rtol=1e-4)
