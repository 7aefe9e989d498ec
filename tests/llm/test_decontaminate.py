"""Decontamination against exhaustive approximate matching."""

import random

import numpy as np

from tidemark.llm import decontaminate as d

WORDS = "the of and thand tion ering ountion shere ofthe nder erand inthe".split()


def passage(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = "#"
        elif kind == 1:
            out.insert(k, "#")
        else:
            del out[k]
    return "".join(out)


def least_edits(item, text):
    """Sellers' algorithm, all diagonals."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_matches_are_those_of_the_exhaustive_search():
    rng = random.Random(7)
    items = [(k, passage(rng, 30)) for k in range(8)]
    index = d.Index(items)
    for trial in range(60):
        item, text = rng.choice(items)
        doc = passage(rng, 20).upper() + " " + edited(rng, text, rng.randrange(0, 16)) + " " + passage(rng, 20)
        got = {m[0]: m for m in index.matches(doc)}
        for k, t in items:
            best = least_edits(t, doc.lower())
            assert (k in got) == (best <= int(d.EDIT_RATE * len(t))), (trial, k, best)
            if k in got:
                _, start, end, edits = got[k]
                assert edits == best and least_edits(t, doc[start:end].lower()) == best


def test_gram_hashes_tell_runs_apart():
    x = np.array([1, 2, 3, 1, 2, 3, 4, 1, 2, 3], np.uint32)
    h = d.gram_hashes(x, 3)
    assert len(h) == 8 and h[0] == h[3] == h[7] and len(set(h.tolist())) == 6
    assert len(d.gram_hashes(x, 12)) == 0 and len(d.gram_hashes(x, 10)) == 1


def test_short_long_and_repeated_items():
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    index = d.Index([(1, "tiny one"), (2, long), (3, "x" * 30), (4, "")])
    doc = "a Tiny  one, tiny one. " + long + " " + "x" * 30 + " end " + long[:600]
    found = index.matches(doc)
    assert (1, 13, 21, 0) in found and any(m[0] == 3 for m in found)
    spans = [m for m in found if m[0] == 2]
    assert spans[0][1] == 23 and spans[0][2] >= 23 + len(long) - d.WINDOW and len(spans) == 2
    assert d.Index([]).matches("anything at all here") == [] and index.matches("") == []


def test_documents(spark):
    rng = random.Random(3)
    text = passage(rng, 30)
    bench = spark.createDataFrame([(1, text), (2, passage(rng, 25)), (3, None), (4, ""), (None, passage(rng, 30))], "item_id bigint, text string")
    rows = [(1, "intro " + text + " end", "x"), (1, "intro " + text + " end", "x"), (2, passage(rng, 200), None), (3, None, "x"), (4, "", "x"), (None, text, "x"), (5, passage(rng, 20_000) + text, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, passages string")
    for size in (4_000_000, 200):
        hits = d.contaminated(docs, bench, block_chars=size).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in hits) == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (5, 1, 0)]
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert d.drop_contaminated(docs, bench.limit(0)).count() == 7 and d.contaminated(docs.limit(0), bench).collect() == []
