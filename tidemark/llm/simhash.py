"""SimHash near-duplicate detection by deletion-variant signatures.

Two 64-bit fingerprints at most ``max_bits`` apart, cut into
``max_bits // 2 + 1`` segments, have a segment in which they differ by at most
one bit. Each fingerprint is indexed under every segment with each single bit
made a wildcard; an equality join finds the pair and all 64 bits verify it.

Hot keys: equal texts have one fingerprint and only distinct fingerprints are
indexed. A variant with more than ``BUCKET`` members is not paired up; its
members go to a second index with ``max_bits`` wildcards anywhere, whose groups
hold at most ``2 ** max_bits`` fingerprints and need no check. Both ways are
exact; no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, row_hash, words_of
from tidemark.llm.graph import components
from tidemark.session import cut_lineage

BITS = 64
#: Members of a variant that are compared pair by pair. The second index costs about as much as pairs in a group of this size.
BUCKET = 64


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint over all ``width``-word shingles, repeats included; 0 without words."""
    import numpy as np
    from xxhash import xxh64_digest

    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - width)]]
    stops = ends[min(width, len(words)) - 1 :]
    digests = b"".join([xxh64_digest(joined[s : e - 1], 42) for s, e in zip(starts, stops)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[at : at + 4096], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fingerprint`` (long) of every row."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([fingerprint(x, width) for x in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], [*keep, "fingerprint"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "fingerprint bigint"])
    return docs.select(*keep, F.col(text).cast("binary").alias("_text")).mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def segment_masks(max_bits: int) -> list[int]:
    """For every segment and wildcard, the bits that must agree."""
    n = max_bits // 2 + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [_signed((((1 << (hi - lo)) - 1) << lo) & ~(1 << at)) for lo, hi in zip(cuts, cuts[1:]) for at in range(lo, hi)]


def wildcard_masks(max_bits: int) -> list[int]:
    full = (1 << BITS) - 1
    return [_signed(full & ~sum(1 << b for b in bits)) for bits in combinations(range(BITS), max_bits)]


def _variants(prints: DataFrame, masks: list[int]) -> DataFrame:
    """``(slot, part, fp)``: the bits of each fingerprint that a mask keeps, by the mask's place."""
    slots = F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("slot", "mask")
    return prints.select("fp", slots).select("slot", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp")


def links(prints: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``prints(fp)`` that connect all pairs at most ``max_bits`` apart.

    From groups over ``bucket`` each member is linked to the smallest of its
    second-index group, which leaves the same components with fewer edges.
    """
    variants = _variants(prints, segment_masks(max_bits))
    sizes = variants.groupBy("slot", "part").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut_lineage(variants.join(sizes, ["slot", "part"]))
    groups = shared.where(F.col("n") <= bucket).groupBy("slot", "part").agg(F.collect_list("fp").alias("fps"))
    pairs = (
        groups.select(F.explode("fps").alias("a"), "fps")
        .select("a", F.explode(F.filter("fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= max_bits))).alias("b"))
        .distinct()
    )
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    near = _variants(crowded, wildcard_masks(max_bits)).groupBy("slot", "part").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = near.select("a", F.explode("fps").alias("b")).where("a <> b").distinct()
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Texts are whole; null, empty and blank texts have fingerprint zero and are
    linked like any other. A component id is the smallest ``doc_id`` reachable
    (null only if no row of the component has one). Repeated rows are repeated
    in the result. Extra columns play no part. Empty input gives an empty result.
    """
    rows = cut_lineage(fingerprints(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), ["doc_id"], width=width))
    prints = rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    classes = _classes(prints, max_bits)
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = classes.join(smallest, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return rows.join(placed, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """``prints`` with ``root``, the component's smallest fingerprint."""
    prints = cut_lineage(prints)
    found = components(links(prints.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    return prints.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row left of each component: the smallest ``doc_id`` (nulls last), then the smallest row hash.

    All columns stay as they are, also those with clashing names.
    """
    mark, place = free_name(docs, "row"), free_name(docs, "place")
    marked = docs.withColumn(mark, row_hash(docs))
    rows = cut_lineage(fingerprints(marked.select(F.col(f"`{doc_id}`").alias("id"), F.col(mark).alias("mark"), F.col(f"`{text}`").alias("text")), ["id", "mark"], width=width))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark")).alias("best")
    prints = rows.groupBy(F.col("fingerprint").alias("fp")).agg(first)
    winners = _classes(prints, max_bits).groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.mark").alias(mark))
    kept = marked.join(winners.distinct(), mark, "left_semi")
    # Equal rows: one stays. Spark cuts each group to one row before the shuffle.
    from pyspark.sql import Window

    return kept.withColumn(place, F.row_number().over(Window.partitionBy(mark).orderBy(mark))).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
