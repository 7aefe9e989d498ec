"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter
from functools import partial

import numpy as np
import pytest

from tidemark.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, words string, n string, f string"


def brute(rows, least, top=2000, longest=5):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                counts.update((lang, ws[i : i + k]) for i in range(len(ws) - k + 1))
    frequent = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}

    def inside(small, large):
        return any(large[i : i + len(small)] == small for i in range(len(large) - len(small) + 1))

    out = []
    for (lang, p), a in frequent.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for (x, q), b in frequent.items()):
            continue
        cuts = [(1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in sorted({x[0] for x in out}):
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, k, *x[1:]) for k, x in enumerate(mine[:top], 1)]
    return ranked


def found(df):
    return sorted(tuple(r) for r in df.collect())


def texts():
    long = " ".join(["New York is  a big\tapple tree"] * 40)
    rows = [(k, "the red fox, the red fox jumps! THE red fox; é É élan vital\x0bélan vital.", "en" if k % 2 else None) for k in range(6)]
    rows += [(7, long, "en"), (8, None, "en"), (9, "", None), (10, " .,;\t\n ", "de"), (11, "a a a a a a a", "de"), (11, "a a a a a a a", "de"), (12, "x\x1fy x\x1fy x\x1fy x\x1fy \x00 \x00 \x00", "xx"), (13, " w  w  w   q", "xx")]
    return [(*r, "w", "n", "f") for r in rows]


@pytest.mark.parametrize("buckets", [1 << 12, 1 << 16])
def test_small_texts(spark, monkeypatch, buckets):
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for least in (2, 3, 5):
        assert found(phrases.collocations(df, least, buckets=buckets)) == sorted(brute(rows, least)) != []
    assert found(phrases.collocations(df, 2, top=3)) == sorted(brute(rows, 2, top=3))
    monkeypatch.setattr(phrases, "STEP", 5)
    monkeypatch.setattr(phrases, "REMEMBERED", 4)
    assert found(phrases.collocations(df, 2)) == sorted(brute(rows, 2))


def test_given_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    assert found(phrases.collocations(df, 30)) == sorted(brute(rows, 30)) != []


def test_scores_beyond_64_bits(spark):
    rows = [("en", [], 9 * 10**14), ("en", ["a", "b"], 4 * 10**13), ("en", ["a"], 10**14), ("en", ["b"], 6 * 10**13)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, words array<string>, f bigint")).collect()
    assert [(r.a, r.l, r.r, r.score) for r in got] == [(4 * 10**13, 10**14, 6 * 10**13, 1000 * 4 * 10**13 * 9 * 10**14 // (10**14 * 6 * 10**13))]


def test_nothing_to_find(spark):
    make = partial(spark.createDataFrame, schema=SCHEMA)
    assert found(phrases.collocations(make([]), 2)) == []
    assert found(phrases.collocations(make([(1, None, None, "", "", "")]), 2)) == []
    assert found(phrases.collocations(make([(1, "one two three", "en", "", "", "")]), 2)) == []


def test_rare_phrases_open_no_windows(spark):
    """Rare phrases add up in no counter, also where they are many: hardly a window goes beyond a word here."""
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(20_000)}" for _ in range(10_000)), "en", "", "", "") for k in range(40)]
    texts = phrases._texts(spark.createDataFrame(rows, SCHEMA).repartition(2), "text", "lang")
    counted = phrases.windows(texts, phrases.reachable(texts, 2)).cache()
    assert counted.agg({"n": "sum"}).head()[0] == 400_000
    assert 20_000 <= counted.count() < 22_000


def test_empty_language_and_rare_first_words(spark):
    rows = [(1, "a b a b. once a b", "", "", "", ""), (2, "ü. only here", "ü \t", "", "", ""), (3, "", "", "", "", ""), (4, "a b", None, "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for least in (1, 2, 300):
        assert found(phrases.collocations(df, least)) == sorted(brute(rows, least))


@pytest.mark.parametrize(("buckets", "top", "dense"), [(1 << 32, 200, 10), (1 << 32, 390, 1 << 18), (1 << 12, 390, 10), (1 << 12, 200, 1 << 18)])
def test_counts_of_counters(monkeypatch, buckets, top, dense):
    monkeypatch.setattr(phrases, "DENSE", dense)
    rng = np.random.default_rng(5)
    sparse = phrases._Sparse(buckets, top)
    few = np.append(rng.integers(0, 3 << sparse.width, 300), [0, buckets - 1]).astype(np.uint32)
    tasks = [rng.choice(few, 40_000) for _ in range(3)]
    sums, whole = {}, Counter()
    for codes in tasks:
        for k, n in Counter(codes.tolist()).items():
            whole[k] += min(n, top)
        for block, steps, rest in sparse.packed(2, codes):
            sums.setdefault(block - phrases.BLOCKS, phrases._Block(sparse)).add(*sparse.unpacked(steps, rest))
    got = [(block << sparse.width) + int(at) for block in sorted(sums) for at in sums[block].reached()]
    assert got == sorted(k for k, n in whole.items() if n >= top) != []
    open_ = phrases._Open(np.array(got, np.uint32).tobytes(), buckets)
    assert open_(np.array(got, np.uint32)).all()
    assert not phrases._Open(b"", buckets)(few).any()


def test_rows_of_many_bits_come_together():
    rng = np.random.default_rng(3)
    for widths in ([2, 20, 20, 20, 20, 20], [3, 5], [1]):
        columns = [rng.integers(0, 3 if w > 1 else 1, 5_000) << (w - 2 if w > 1 else 0) for w in widths]
        order, first = phrases._sorted(columns, widths)
        rows = list(zip(*(c[order].tolist() for c in columns), strict=True))
        counts = np.diff(np.r_[first, len(rows)]).tolist()
        assert dict(zip([rows[k] for k in first], counts, strict=True)) == Counter(zip(*(c.tolist() for c in columns), strict=True))


def test_windows_of_several_steps(monkeypatch):
    """What a task adds in several steps, with other languages and words each, is sent once and in its blocks."""
    words, want, got = phrases.Words(), Counter(), Counter()
    task = phrases._Windows(words, 3)
    for langs, texts in [(["en", "de"], [b"a b c d", b"a b"]), (["fr", "en"], [b"a b", b"x a b c"])]:
        grams = phrases._Grams(words, langs, texts, 3, 1 << 32)
        length = np.arange(len(grams.ids)) % 2 + 1
        length[[k for k in range(len(length)) if not grams.word[k : k + length[k]].all()]] = 0
        task.add(grams, length, (grams.ids % 3).astype(np.int16))
        spelled = [words.words[k] for k in grams.ids]
        want.update((grams.names[grams.lang[k]].encode(), *spelled[k : k + length[k]]) for k in np.flatnonzero(grams.word))
    for batch in task.rows():
        for block, n, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            plain = task.codec.decompress(packed, size, asbytes=True)
            at = 8 * n
            for count, length in zip(phrases._from_planes(plain, n, 0).tolist(), phrases._from_planes(plain, n, 4 * n).tolist(), strict=True):
                key = tuple(plain[at : at + length].split(phrases.WORD_END))
                at += length
                assert key not in got and (len(key) == 1 or words[key[1]] % 3 == block)
                got[key] = count
    assert got == want and task.held == 0
