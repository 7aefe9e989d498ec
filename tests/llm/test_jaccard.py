"""The n-gram Jaccard join against comparing all pairs of sets."""

import random

import numpy as np
import pytest
from conftest import SMALL

from tidemark.llm import jaccard

SCHEMA = "doc_id bigint, text string, h string, n string, node string, keys string"


def slow_set(text, width=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute(rows, percent=80):
    sets = [slow_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[top(k)] = min(least.get(top(k), r[0]), r[0])
    return order((r[0], len(s), least.get(top(k))) for k, (r, s) in enumerate(zip(rows, sets)))


def order(rows):
    return sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r))


def found(df):
    return order(tuple(r) for r in df.collect())


def near_copies(seed, sizes=(1, 2, 4, 5, 6, 8, 9, 10, 12, 15, 25, 40, 41, 60, 130)):
    """Texts with copies that lie closely around the limit."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for n in sizes:
        for _ in range(4):
            base = [word() for _ in range(n)]
            texts.append(base)
            for _ in range(6):
                copy = list(base)
                for _ in range(rng.randrange(0, 2 + n // 30)):
                    at = rng.randrange(len(copy) + 1)
                    copy[at : at + rng.randrange(0, 2)] = [word()] * rng.randrange(0, 2)
                copy += [word() for _ in range(rng.randrange(0, 1 + n // 8))]
                texts.append(copy or [word()])
    rng.shuffle(texts)
    return [(k, " ".join(t), "h", "n", "x", "k") for k, t in enumerate(texts)]


@pytest.mark.parametrize("limits", [{}, {"spare": 0, "deleted_up_to": 0}, {"crowd": 2}])
def test_copies_around_the_limit(spark, limits):
    rows = near_copies(len(limits) + 1)
    got = found(jaccard.joined(spark.createDataFrame(rows, SCHEMA).repartition(3), **limits))
    want = brute(rows)
    assert got == want and 0 < sum(r[0] != r[2] for r in want) < len(rows)


def test_similar_sets_share_a_key():
    """Random sets exactly at the limit, all sizes, also where segments are few."""
    rng = np.random.default_rng(3)
    starts = jaccard.band_starts(80, 5000)
    schemes = [jaccard.Scheme(k, a, b - 1, 80) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
    for trial in range(1500):
        small = int(rng.integers(1, 40)) if trial % 3 else int(rng.integers(40, 1500))
        great = int(rng.integers(small, small * 100 // 80 + 1))
        common = next(c for c in range(small + 1) if 100 * c >= 80 * (small + great - c))
        pool = rng.integers(0, 1 << 64, small + great - common, np.uint64)
        a, b = np.unique(pool[:small]), np.unique(np.r_[pool[:common], pool[small:]])
        (ka, _, short), (kb, _, _) = (jaccard.signature(x, schemes) for x in (a, b))
        band = next(s.band for s in schemes if len(b) <= s.most)
        assert len(np.intersect1d(ka, kb)) or band in short


def test_given_texts(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(jaccard.joined(df)) == brute(rows)


def test_a_crowd_of_copies_and_a_common_text(spark):
    """A third of all texts are near copies of one, another third share most of their text but are not similar; pairs are planted there."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, shared = [word() for _ in range(80)], [word() for _ in range(70)]
    texts = [base[:k] + [word()] + base[k + 1 :] for k in (rng.randrange(80) for _ in range(150))]
    for _ in range(60):
        tail = [word() for _ in range(16)]
        texts += [shared + tail, shared + tail[:-2] + [word(), word()]]
    texts += [[word() for _ in range(50)] for _ in range(100)]
    rng.shuffle(texts)
    rows = [(k, " ".join(t), "", "", "", "") for k, t in enumerate(texts)]
    assert found(jaccard.joined(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_nulls_blanks_and_repeated_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, None), (2, ""), (None, " \t\n"), (3, text), (3, text), (None, text.upper()), (9, text.replace(" ", " \x0b")), (3, "other words here"), (4, "other WORDS here"), (None, "alone"), (7, "é É"), (8, "É é"), (10, text + " " + text)]
    rows = [(*r, "h", "n", "x", "k") for r in rows]
    assert found(jaccard.joined(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert jaccard.joined(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_very_long_text(spark):
    words = [f"w{k}" for k in range(60_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[:55_000])), (3, " ".join(words[20_000:]))]
    rows = [(*r, "", "", "", "") for r in rows]
    assert found(jaccard.joined(spark.createDataFrame(rows, SCHEMA))) == [(1, 54_996, 1), (2, 59_996, 1), (3, 39_996, 3)]


def test_texts_around_one_passage_make_few_pairs(spark, monkeypatch):
    """Texts that share 70 % with all others meet in many crowded lists; pairs that are made grow with the texts, not with their square."""
    made = []
    kind = type(spark.range(1))

    def counted(df, distinct=kind.distinct):
        if df.columns == ["id_a", "id_b"]:
            made.append(df.count())
        return distinct(df)

    monkeypatch.setattr(kind, "distinct", counted)
    for size in (30, 60):
        rng = random.Random(size)
        word = lambda: f"w{rng.randrange(10**6)}"
        shared, texts = [word() for _ in range(330)], []
        for k in range(size):
            tail = [word() for _ in range(70)]
            texts.append(shared + tail)
            if k % 3 == 0:
                # A planted pair: linked through an edit of the common part and of the tail.
                texts.append(shared[:100] + [word()] + shared[101:] + tail[:-k])
        rng.shuffle(texts)
        rows = [(k, " ".join(t), "", "", "", "") for k, t in enumerate(texts)]
        assert found(jaccard.joined(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)
    assert len(made) == 2 and made[1] <= 3 * made[0]
