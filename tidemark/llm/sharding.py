"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id; a keyed Feistel network permutes
the numbers. Its domain is the next power of four, and numbers that leave the
table walk on along their cycle until they are back inside. Place ``p`` of the
shuffle is slot ``p // shards`` of shard ``p % shards``, so shard and slot of any
row follow from its number alone and sizes differ by one row at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered

ROUNDS = 6
SEED = 20240229


def _mix(x):
    """A 64-bit finalizer with full avalanche, over arrays of unsigned integers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def permute(numbers, population: int, seed: int = SEED, rounds: int = ROUNDS):
    """Places of row numbers ``0 .. population - 1`` in the shuffle, a bijection for each seed."""
    import numpy as np

    half = np.uint64(max(1, ((population - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    places = np.array(numbers, np.uint64)
    walking = np.arange(len(places))
    with np.errstate(over="ignore"):
        while len(walking):
            x = places[walking]
            left, right = x >> half, x & mask
            for k in range(rounds):
                left, right = right, left ^ (_mix(right * np.uint64(2 * rounds) + np.uint64(k) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) & mask)
            places[walking] = left << half | right
            walking = walking[places[walking] >= population]
    return places.astype(np.int64)


def locate(number: int, population: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row without reading any other."""
    place = int(permute([number], population, seed)[0])
    return place % shards, place // shards


def shuffle_places(rows: DataFrame, number: str = "row_number", population: str = "population", seed: int = SEED, out: str = "place") -> DataFrame:
    """``rows`` with each row's place in the shuffle."""

    @F.pandas_udf("bigint")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for numbers, sizes in batches:
            yield pd.Series(permute(numbers.to_numpy(), int(sizes.iloc[0]), seed)) if len(numbers) else pd.Series([], dtype="int64")

    return rows.withColumn(out, place(F.col(number), F.col(population)))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs(doc_id, text)``.

    Rows are numbered by ``doc_id`` (nulls first), then by text checksum and
    size; rows equal in all three are interchangeable. The size of a text is its
    UTF-8 bytes and one, of a null text one; its checksum is that of no bytes.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = shuffle_places(numbered(narrow, "doc_id", "text_crc32", "size"), seed=seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
