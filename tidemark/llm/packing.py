"""Best-fit packing of token sequences in rounds.

Round 0 packs each partition's pieces by best fit, largest first. Bins that are
nearly full are done; the others are items of the next round, where several
partitions' bins meet in one task. A bin's pieces travel with it as rows, so no
chain of joins is needed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tokenizer_path, word_ids
from tidemark.session import cut_lineage

CAPACITY = 2048
#: Free places at which a bin counts as nearly full.
SLACK = 8
#: Bins that one task packs at most, and how many tasks' bins meet in the next round.
TASK_BINS = 200_000
FAN_IN = 8

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def best_fit(sizes, capacity: int):
    """Bin number of each item and the bins' fills: largest item first, each into the fullest bin with room."""
    import numpy as np

    order = np.argsort(-np.asarray(sizes), kind="stable")
    bin_of = np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if a bin with r free places is open
    free: list[int] = []
    for i, size in zip(order.tolist(), np.asarray(sizes)[order].tolist()):
        fitting = open_rooms >> size << size
        if fitting:
            left = (fitting & -fitting).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, at = capacity, len(free)
            free.append(capacity)
        bin_of[i] = at
        free[at] = left - size
        room[left - size].append(at)
        open_rooms |= 1 << (left - size)
    return bin_of, capacity - np.asarray(free, np.int64)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of ``docs(doc_id, text)``; a null text has the end id only."""
    import pyarrow as pa

    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        ids, end = word_ids(path), end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                coded = ids.of_text(text) + end
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"]) if rows else pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, PIECES)


def _packer(capacity: int, round_no: int):
    """Packs one task's bins: rows are pieces with the bin that holds them and their offset there."""

    def pack(key, rows):
        import numpy as np
        import pyarrow as pa

        length, offset, held = (rows.column(c).to_numpy() for c in ("length", "offset", "bin"))
        bins, at = np.unique(held, return_inverse=True)
        fills = np.zeros(len(bins), np.int64)
        np.add.at(fills, at, length)
        parent, full = best_fit(fills, capacity)
        # Where each old bin begins in its new one: the fills before it there.
        order = np.argsort(parent, kind="stable")
        before = np.cumsum(fills[order]) - fills[order]
        first = np.flatnonzero(np.r_[True, np.diff(parent[order]) != 0])
        base = np.empty(len(bins), np.int64)
        base[order] = before - np.repeat(before[first], np.diff(np.r_[first, len(order)]))
        new = np.int64(round_no << 56 | key[0].as_py() << 32) | parent
        kept = [rows.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        return pa.table([*kept, pa.array(new[at]), pa.array(offset + base[at]), pa.array(full[parent[at]])], names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill"])

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, task_bins: int = TASK_BINS, fan_in: int = FAN_IN) -> DataFrame:
    """``pieces`` (columns of PIECES, each at most ``capacity`` long) with ``sequence_id`` and ``offset``.

    Equal pieces are packed apart. The rounds go on until all bins left met in
    one task. Where they are too many for one, as a task gets at most about
    ``task_bins``, they are dealt anew to as few tasks as hold them until a round
    saves under one bin in a hundred.
    """
    schema = PIECES + ", bin bigint, offset bigint, fill bigint"
    marked = pieces.withColumns({"bin": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint"), "fill": F.col("length")})
    whole = F.col("length") == capacity
    # A piece that fills a sequence is one; its number is its own.
    left = cut_lineage(marked)
    done = left.where(whole).withColumn("bin", F.col("bin").bitwiseOR(F.lit(1 << 62)))
    left = left.where(~whole)
    n = left.count()
    tasks = max(-(-n // task_bins), min(-(-n // 2000), int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1)
    round_no = 0
    while n:
        grouped = left.withColumn("task", F.pmod(F.xxhash64("bin", F.lit(round_no)), F.lit(tasks)).cast("int"))
        packed = cut_lineage(grouped.groupBy("task").applyInArrow(_packer(capacity, round_no), schema))
        ready = F.col("fill") >= capacity - slack
        done = done.union(packed.where(ready))
        left = packed.where(~ready)
        bins = left.select("bin").distinct().count()
        fewest = max(-(-bins // task_bins), 1)
        last = tasks == 1 or tasks <= fewest and bins > 0.99 * n and round_no > 0
        round_no += 1
        if last or not bins:
            done = done.union(left)
            break
        tasks, n = max(fewest, tasks // fan_in), bins
    return done.select(*[c.split()[0] for c in PIECES.split(", ")], F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Tokenizes and packs ``docs(doc_id, text)``; one row a piece.

    Null and empty texts hold the end id alone, a null ``doc_id`` stays null,
    repeated rows are packed each, extra columns are not read.
    """
    return pack(token_pieces(docs, capacity, path=path), capacity)
