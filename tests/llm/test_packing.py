"""Best-fit packing: token round trip, no overlap, close to the lower bound."""

from collections import defaultdict
from zlib import crc32

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.common import WordIds, tokenizer_path

ODD = ["<|endoftext|> a<|STARTOFTEXT|>b", "İstanbul don't I'M 12ab\tq\x0b\x1cz", "’s 's x's ÉCOLE, é́! ?.", "", " ", "Σίσυφος. ΣΑΣ.", "a.b.c...", "ﬁ… __init__.", "x" * 5000]


def test_ids_are_the_tokenizers():
    plain = Tokenizer.from_file(tokenizer_path())
    ids = WordIds(tokenizer_path(), remembered=6)
    for text in ODD * 2:
        assert np.frombuffer(ids.of_text(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_ids_of_random_texts():
    plain, ids = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path())
    letters = np.array(list("aZ9 .,;:!?'-_\t\u00e9\u0130\u0131I\u0307\u01c5\ufb01\u00df\u03a3\u0958\u0301\u4e2d\u05d0\u1e9e\U0001d400"))
    rng = np.random.default_rng(8)
    for _ in range(20_000):
        text = "".join(rng.choice(letters, rng.integers(1, 9)))
        assert np.frombuffer(ids.of_text(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_best_fit_chooses_the_fullest_bin():
    parent, fills = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(fills.tolist()) == [10, 10] and parent[0] == parent[2]


def check(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_documents(spark):
    plain = Tokenizer.from_file(tokenizer_path())
    texts = [*ODD, None, *("word " * n for n in (1, 30, 61, 62, 63, 64, 65, 127, 128, 200))]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "word", "x"), (1, texts[1], "x")], "doc_id bigint, text string, piece string")
    rows = packing.pack_documents(docs, capacity=64).collect()
    check(rows, 64)
    for k, t in enumerate(texts):
        coded = plain.encode(t or "", add_special_tokens=False).ids + [0]
        mine = sorted((r for r in rows if r.doc_id == k), key=lambda r: (r.piece, r.sequence_id, r.offset))
        mine = mine[::2] if k == 1 else mine
        assert [r.start for r in mine] == list(range(0, len(coded), 64))
        assert [r.ids_crc32 for r in mine] == [crc32(np.array(coded[a : a + 64], "<u4").tobytes()) for a in range(0, len(coded), 64)]
        assert sum(r.length for r in mine) == len(coded)


def test_rounds_come_close_to_the_bound(spark):
    sizes = np.random.default_rng(3).integers(1, 2049, 4000).tolist()
    pieces = spark.createDataFrame([(k, 0, 0, s, 0) for k, s in enumerate(sizes)], packing.PIECES)
    rows = packing.pack(pieces, task_bins=500).collect()
    assert len(rows) == 4000
    used = check(rows, 2048)
    one_task = len(packing.best_fit(sizes, 2048)[1])
    assert used <= 1.02 * one_task + 2


def test_bins_of_all_tasks_meet(spark):
    """Two pieces fit each other and nothing else; wherever the rounds deal them, they meet."""
    for k in range(3):
        sizes = [2047] * 12_000 + [1100 + k, 948 - k]
        pieces = spark.createDataFrame([(k, 0, 0, s, 0) for k, s in enumerate(sizes)], packing.PIECES)
        rows = packing.pack(pieces, fan_in=2, slack=0).collect()
        assert len(rows) == 12_002 and check(rows, 2048) == 12_001


def test_no_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
