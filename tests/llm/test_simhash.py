"""SimHash against a brute-force version; empty, null, repeated and crowded inputs."""

from itertools import combinations

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.graph import components

SCHEMA = "doc_id bigint, text string, fingerprint string"


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, max_bits=2):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if bin(a ^ b).count("1") <= max_bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def test_fingerprint_is_the_plain_one():
    for text in [None, "", " \t\x0b", "one", "Two words", "A b\x0cC", "a b c d e f g " * 3, "ÄÖ ß É " * 7, "x " * 20_000]:
        assert simhash.fingerprint(text.encode() if text is not None else None) & (1 << 64) - 1 == slow_print(text)


def test_documents_against_brute_force(spark):
    base = [f"w{k % 7} v{k % 11} u{k} the of and" for k in range(40)]
    texts = [*base, *base[:5], *(t + " x" for t in base[:9]), None, "", "  ", "one", "ONE"]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(3, base[3], "clash"), (None, base[0], None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {k: slow_print(t) for k, t, _ in rows}
    roots = slow_classes(set(prints.values()))
    least = {}
    for k, t, _ in rows:
        if k is not None:
            r = roots[slow_print(t)]
            least[r] = min(least.get(r, k), k)
    want = sorted((-1 if k is None else k, slow_print(t), least[roots[slow_print(t)]]) for k, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in got) == want


@pytest.mark.parametrize("bucket", [0, 4, 64])
def test_links_connect_what_is_near(spark, bucket):
    seed = 0x1234_5678_9ABC_DEF0
    prints = {seed ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(0, 64, 7)} | {seed, 0, 3, 7, (1 << 63) | 1, 0xFFFF_0000_FFFF_0000}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), bucket=bucket)
    found = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(edges).collect()}
    want = slow_classes(prints)
    groups = lambda m: {frozenset(p for p in prints if m.get(p, p) == r) for r in {m.get(p, p) for p in prints}}
    assert groups(found) == groups(want)


def test_one_document_of_each_group_stays(spark):
    text = "the same words again and again in a row"
    rows = [(5, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, "c"), (9, "quite another text with more to say", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _row string")
    assert sorted(tuple(r) for r in simhash.drop_near_duplicates(df).collect()) == [(2, text, "b"), (9, rows[4][1], None)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(900, 901), (901, 900), (5, 5)], "a bigint, b bigint"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, 900: 900, 901: 900}
