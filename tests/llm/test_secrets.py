"""Secret linking against a plain scan; scopes, copies and odd inputs."""

import hashlib
import random
import re

from tidemark.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def written(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


PARTS = ["token", "TOKEN", "Api_Key", "apikey", "password:", "secret =", ' "', "'", "=", ":", " ", "abcdef", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "deadbeef", "é", "😀", "\n", "x.y-z/+=", "user=bob ", "http://db.example:5432/x "]


def test_strong_spans_are_the_plain_ones(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(400)] + ["token:token:abcdefgh", "ſecret=abcdefg", "", None, "password=" + "a" * 50_000, "f" * 23, "f" * 24, " ".join(["token=abcdef"] * 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in secrets.report(df).collect()}
    for k, t in enumerate(texts):
        want = plain(t or "")
        assert rows[k].base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), t
        assert [rows[k].n_assign, rows[k].n_access, rows[k].n_hex] == [sum(s[1] == c for s in want) for c in range(3)]
        assert {x for x in written(want).split(",") if x} <= set(rows[k].spans.split(","))


def test_weak_parts_need_complements(spark):
    far = " " * 300
    rows = [
        (1, "user=bob"), (2, "user=bob pwd=zz11"), (3, "user=bob pwd=zz11 host=db.example"), (4, "AKIA" + "Z" * 16 + " pwd=zz11"),
        (5, "AKIA" + "Z" * 16 + far + "pwd=zz11"), (6, "token = abcdefgh on 10.1.2.3"), (7, None), (8, ""), (9, "user=bob pwd=zz11 host=db.example"),
    ]
    got = {r.doc_id: r.n_linked for r in secrets.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 3, 4: 1, 5: 0, 6: 1, 7: 0, 8: 0, 9: 3}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = "user=bob pwd=zz11 host=db.example"
    df = spark.createDataFrame([(None, text, "a", 1), (1, text, "b", 2), (1, text, "b", 2)], "doc_id bigint, text string, scope string, strong int")
    assert sorted((r.doc_id or 0, r.n_linked) for r in secrets.report(df).collect()) == [(0, 3), (1, 3), (1, 3)]
    assert secrets.report(df.limit(0)).collect() == []
