"""The pipeline stage by stage against brute force, and its registration."""

import re

import corpus_pipeline
import numpy as np
import pytest
from test_simhash import slow_classes, slow_print
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, pii
from tidemark.llm.common import row_hash, tokenizer_path

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ITEM = "thand ering ountion of the shere inthe erand nder tion that thing was oned for ereng and out"


def fixture(spark, folder):
    texts = {k: (f"the of and word{k} thing{k % 7} " if k % 2 else f"der die und wort{k} ding{k % 5} ") * (3 + k % 4) for k in range(40)}
    texts |= {40: texts[7], 41: texts[7].upper(), 42: None, 43: "", 44: "12 !! 34", 45: "intro words here " + ITEM + " end", 46: f"write to some.one@mail.example.com or call +1 (487) 555-7209 card 4845168114407329 from 97.51.17.173 number {9} " * 2}
    rows = [(k, t, None if t is None or k > 39 else "en" if k % 2 else "de", "s", len(t) if t is not None else None) for k, t in texts.items()] + [(3, texts[3], "en", "s", len(texts[3])), (None, texts[3], "en", "s", len(texts[3]))]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, "something else entirely that is nowhere to be found in there")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    fixture(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/out{k}")
        docs = spark.read.parquet(f"{folder}/out{k}")
        seen.append(docs)
    return folder, seen


def test_all_but_the_last_keep_the_columns(stages):
    _, seen = stages
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == seen[0].columns and df.dtypes == seen[0].dtypes for df in seen[:-1])


def key(r):
    return (-1 if r.doc_id is None else r.doc_id, r.text or "")


def test_language_keeps_every_text_with_a_letter(stages):
    _, seen = stages
    want = sorted(key(r) for r in seen[0].collect() if r.text and any(c.isalpha() for c in r.text))
    assert sorted(key(r) for r in seen[1].collect()) == want


def test_one_of_each_near_duplicate_group_stays(stages):
    _, seen = stages
    before = seen[1].collect()
    roots = slow_classes({slow_print(r.text) for r in before})
    best = {}
    for r in before:
        root = roots[slow_print(r.text)]
        best[root] = min(best.get(root, (True, 0)), (r.doc_id is None, r.doc_id or 0)) if root in best else (r.doc_id is None, r.doc_id or 0)
    assert sorted(r.doc_id for r in seen[2].collect()) == sorted(i for _, i in best.values())


def test_contaminated_documents_go(stages):
    _, seen = stages
    index = decontaminate.Index([(1, ITEM)])
    want = sorted(key(r) for r in seen[2].collect() if not index.matches(r.text))
    assert sorted(key(r) for r in seen[3].collect()) == want and 45 not in {i for i, _ in want}


def test_personal_data_is_replaced_and_nothing_else(stages):
    _, seen = stages
    after = {r.doc_id: r for r in seen[4].collect()}
    for r in seen[3].collect():
        new = after[r.doc_id].text
        if r.doc_id == 46:
            for value in ("some.one@mail", "555-7209", "4845168114407329", "97.51.17.173"):
                assert value not in new
            assert re.sub(r"\S*@\S+|[0-9]", "", new) == re.sub(r"\S*@\S+|[0-9]", "", r.text) and after[46].n_chars == len(new)
        else:
            assert tuple(after[r.doc_id]) == tuple(r)
    assert len(after) == seen[3].count() and len(pii.KINDS) == 6


def test_every_token_is_packed(stages):
    _, seen = stages
    plain = Tokenizer.from_file(tokenizer_path())
    pieces = seen[5].collect()
    for r in seen[4].collect():
        assert sum(p.length for p in pieces if p.doc_id == r.doc_id) == len(plain.encode(r.text, add_special_tokens=False).ids) + 1
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= 2048


def test_run_and_registration(spark, stages):
    import __spark_entry__

    folder, seen = stages
    drop = ["sequence_id", "offset"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).drop(*drop).collect())) == sorted(map(tuple, seen[5].drop(*drop).collect()))
    names = __spark_entry__.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))


def test_texts_stay_where_no_language_is_known(spark):
    rows = [(k, t, None, "s", 1) for k, t in enumerate(["some words", "é", "12 34", "", None])]
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, spark.createDataFrame(rows, COLUMNS), "").collect()) == [0, 1]


def test_rows_with_nulls_in_other_places_are_different(spark):
    rows = [(7, "one text", "a", None, 1), (7, "one text", None, "a", 1), (7, "one text", "a", None, 1)]
    df = spark.createDataFrame(rows, COLUMNS)
    marks = [r[0] for r in df.select(row_hash(df)).collect()]
    assert marks[0] == marks[2] != marks[1]
    kept = corpus_pipeline.near_dedup(spark, df, "").collect()
    assert len(kept) == 1 and tuple(kept[0]) in {tuple(r) for r in rows}


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
