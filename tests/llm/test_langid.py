"""Language identification: held-out accuracy on the given documents and odd inputs."""

from conftest import SMALL

from tidemark.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    tested = [r for r in rows if r.held_out]
    assert len(tested) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) / len(tested) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(k, ("the of and " if k % 2 else "der die und ") * 9 + str(k), "en" if k % 2 else "de", "x") for k in range(40)]
    odd = [(100, None, "en", "x"), (101, "", None, "x"), (102, "123 ... !?", "de", "x"), (103, "the", None, "x"), (None, "der die und", None, "x"), (3, rows[3][1], "en", "x"), (104, "der die " * 30_000, None, None)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score string")).collect()}
    assert [got[k] for k in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "en", "de", "de"]


def test_one_or_no_language(spark):
    schema = "doc_id bigint, text string, lang string"
    one = langid.identify(spark.createDataFrame([(1, "words here", "xx"), (2, "others", None)], schema)).collect()
    assert {r.lang_pred for r in one} == {"xx"}
    none = langid.identify(spark.createDataFrame([(1, "words here", None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.identify(spark.createDataFrame([], schema)).collect() == []
