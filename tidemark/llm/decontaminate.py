"""Benchmark passages in documents by q-gram lemma filtering and banded alignment.

A passage of ``m`` characters within ``e`` edits of a benchmark text shares at
least ``m - q + 1 - q * e`` of its q-grams, and their diagonals (place in the
document minus place in the benchmark text) differ by at most ``e``. Shared
q-grams are counted in bands of ``2 * (e + 1)`` diagonals that overlap by half,
so each passage lies in one band; bands that reach the bound are aligned.

Documents are read once for each block of benchmark texts. A block is bounded in
characters, so what is sent to the tasks is bounded however long the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

Q = 12
#: Edits allowed for each benchmark character.
EDIT_RATE = 0.06
#: Longer benchmark texts are looked up in windows of this length, half overlapping.
WINDOW = 512
BLOCK_CHARS = 4_000_000
#: Characters of documents whose q-grams are hashed at once.
CHUNK = 1 << 18
MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


@lru_cache(1)
def _lower_table():
    """Lower case of every character of the basic plane that stays one character; white space becomes a space."""
    import numpy as np

    table = np.arange(1 << 16, dtype=np.uint32)
    for k in range(1 << 16):
        c = chr(k)
        if c.isspace():
            table[k] = 32
        elif len(low := c.lower()) == 1:
            table[k] = ord(low)
    return table


def codes(text: str):
    """Code points in lower case, as many as the text has."""
    import numpy as np

    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(raw < 1 << 16, _lower_table()[np.minimum(raw, 0xFFFF)], raw).astype(np.uint32)


def gram_hashes(x, q: int):
    """A 64-bit rolling hash of each run of ``q`` codes, by doubling."""
    import numpy as np

    power, span = np.uint64(0x9E3779B97F4A7C15), 1
    done, total, out = 0, x.astype(np.uint64), None
    with np.errstate(over="ignore"):
        while True:
            if q >> span.bit_length() - 1 & 1:
                part = total[done:]
                out = part if out is None else out[: len(part)] * power + part[: len(out)]
                done += span
            if done == q:
                break
            total = total[: len(total) - span] * power + total[span:] if len(total) > span else total[:0]
            power, span = power * power, 2 * span
    return out ^ (out >> np.uint64(29))


def banded_distance(item, region, lo: int, hi: int, most: int) -> tuple[int, int, int] | None:
    """Best ``(edits, start, end)`` of ``item`` inside ``region`` on diagonals ``lo..hi``; None beyond ``most`` edits.

    Start and end in the region are free. Among equal edits the earliest end and
    then the latest start is taken.
    """
    import numpy as np

    width, far, n = hi - lo + 1, len(item) + len(region) + 1, len(region)
    at = np.arange(width)
    columns = lo + at
    inside = (columns >= 0) & (columns <= n)
    cost = np.where(inside, 0, far)
    start = np.where(inside, columns, -1)
    for k, c in enumerate(item):
        # In row k + 1 the place ``a`` of the band is column lo + a + k + 1.
        cols = columns + k + 1
        ok = (cols >= 1) & (cols <= n)
        same = np.zeros(width, np.int64)
        same[ok] = region[cols[ok] - 1] != c
        across = np.where(ok, cost + same, far)
        down = np.r_[cost[1:], far] + 1
        down = np.where((cols >= 0) & (cols <= n), down, far)
        best = np.minimum(across, down)
        begun = np.where(across <= down, start, np.r_[start[1:], -1])
        # Insertions run along the row: a prefix minimum of cost minus place.
        slope = best - at
        least = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == least, at, 0))
        cost, start = np.where((cols >= 0) & (cols <= n), least + at, far), begun[source]
        if cost.min() > most:
            return None
    a = int(np.argmin(cost))
    return int(cost[a]), int(start[a]), int(columns[a] + len(item))


class Index:
    """Q-grams of one block of benchmark texts."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE, window: int = WINDOW):
        import numpy as np

        self.q, self.ids, self.texts, self.edits, self.short = q, [], [], [], []
        for item, text in items:
            whole = codes(text)
            step = window // 2
            for at in range(0, max(1, len(whole) - step), step) if len(whole) > window else [0]:
                part = whole[at : at + window] if len(whole) > window else whole
                if len(part) >= q:
                    self.ids.append(item)
                    self.texts.append(part)
                    # Fewer edits where the bound would be no condition at all.
                    self.edits.append(min(int(rate * len(part)), (len(part) - q) // q))
                elif len(part):
                    self.short.append((item, part))
        grams = [gram_hashes(t, q) for t in self.texts]
        every = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.grams, self.first = np.unique(every[order], return_index=True)
        self.last = np.r_[self.first[1:], len(every)]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.edit = np.array(self.edits, np.int64)
        self.bound = self.lengths - q + 1 - q * self.edit
        bits = max(16, int(16 * len(self.grams)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self._slot(self.grams)] = True

    def _slot(self, h):
        import numpy as np

        with np.errstate(over="ignore"):
            return (h * np.uint64(0xD6E8FEB86659FD93)) >> self.shift

    def _hits(self, x):
        """``(position, owner, place)`` of the shared q-grams of ``x``."""
        import numpy as np

        h = gram_hashes(x, self.q)
        at = np.flatnonzero(self.seen[self._slot(h)])
        found = np.searchsorted(self.grams, h[at])
        found[found == len(self.grams)] = 0
        good = self.grams[found] == h[at]
        at, found = at[good], found[good]
        n = self.last[found] - self.first[found]
        which = np.repeat(self.first[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.owner[which], self.place[which]

    def candidates(self, x):
        """``(owner, lowest diagonal, highest diagonal)`` of the bands that reach the bound."""
        import numpy as np

        parts = []
        for at in range(0, len(x), CHUNK):
            pos, own, place = self._hits(x[at : at + CHUNK + self.q - 1])
            if len(pos):
                parts.append((pos + at, own, place))
        if not parts:
            return []
        pos, own, place = (np.concatenate(c) for c in zip(*parts))
        # Fewer hits in the whole text than the bound: no band can reach it.
        enough = np.bincount(own, minlength=len(self.texts)) >= self.bound
        keep = enough[own]
        pos, own, place = pos[keep], own[keep], place[keep]
        if not len(pos):
            return []
        half = self.edit[own] + 1
        band = (pos - place + self.lengths[own]) // half
        span = int(band.max()) + 3
        keys, n = np.unique(np.concatenate([own * span + band, own * span + band + 1]), return_counts=True)
        keys = keys[n >= self.bound[keys // span]]
        out: list[list[int]] = []
        for o, b in zip((keys // span).tolist(), (keys % span).tolist()):
            # Band b holds the half bands b - 1 and b.
            half_o, m = int(self.edit[o]) + 1, int(self.lengths[o])
            lo, hi = (b - 1) * half_o - m, (b + 1) * half_o - 1 - m
            if out and out[-1][0] == o and lo <= out[-1][2] + 1:
                out[-1][2] = hi
            else:
                out.append([o, lo, hi])
        return out

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item_id, start, end, edits)`` of all passages in one text, by start; code points, end exclusive."""
        x = codes(text)
        found = self._short(x)
        for o, lo, hi in self.candidates(x) if len(x) >= self.q else []:
            m, e = int(self.lengths[o]), self.edits[o]
            # A merged band may hold several passages: take them one by one along the diagonals.
            step = 2 * (e + 1)
            for a in range(lo, hi + 1, step):
                begin = max(0, a - e)
                region = x[begin : max(0, min(hi, a + step - 1) + m + e + 1)]
                exact = region.tobytes().find(self.texts[o].tobytes())
                if exact >= 0 and exact % 4 == 0:
                    found.append((self.ids[o], begin + exact // 4, begin + exact // 4 + m, 0))
                elif got := banded_distance(self.texts[o], region, a - e - begin, min(hi, a + step - 1) + e - begin, e):
                    found.append((self.ids[o], begin + got[1], begin + got[2], got[0]))
        return _apart(found)

    def _short(self, x):
        """Texts under ``q`` characters are found as they stand, between other characters than letters and digits."""
        found = []
        if self.short:
            line = "".join(map(chr, x.tolist()))
            for item, part in self.short:
                word, at = "".join(map(chr, part.tolist())), -1
                while (at := line.find(word, at + 1)) >= 0:
                    before, after = line[at - 1 : at] if at else "", line[at + len(word) : at + len(word) + 1]
                    if not before.isalnum() and not after.isalnum():
                        found.append((item, at, at + len(word), 0))
        return found


def _apart(found):
    """Of overlapping matches of one item the one with fewest edits stays; windows of a long item that touch become one."""
    kept: list[tuple[int, int, int, int]] = []
    for item, start, end, edits in sorted(found, key=lambda m: (m[0], m[1], m[3])):
        if kept and kept[-1][0] == item and start < kept[-1][2]:
            last = kept[-1]
            if end - start > last[2] - last[1] + WINDOW // 4 or end > last[2] + WINDOW // 4:
                kept[-1] = (item, last[1], max(end, last[2]), max(edits, last[3]))
            elif edits < last[3]:
                kept[-1] = (item, start, end, edits)
        else:
            kept.append((item, start, end, edits))
    return sorted(kept, key=lambda m: (m[1], m[0]))


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Benchmark texts in blocks of about ``block_chars`` characters; null and empty texts are left out."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text")).where("length(text) > 0")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // block_chars)
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def _search(items: list[tuple[int, str]], q: int, rate: float):
    @F.pandas_udf(MATCHES)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(items, q, rate)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), m)) for m in index.matches(t)] if t else [] for t in texts], dtype=object)

    return search


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "passages", q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``out``: an array of ``(item_id, start, end, edits)``, empty for clean texts and null texts.

    All columns of ``docs`` are kept and every row is answered, repeated rows each.
    """

    found = None
    for items in benchmark_blocks(benchmark, block_chars=block_chars):

        got = _search(items, q, rate)(F.col(f"`{text}`"))
        found = got if found is None else F.concat(found, got)
    if found is None:
        found = F.array().cast(MATCHES)
    return docs.withColumn(out, found)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each passage: ``doc_id, item_id, start, end, edits``."""
    rows = find_passages(docs.select("doc_id", "text"), benchmark, **options)
    return rows.select("doc_id", F.explode("passages").alias("p")).select("doc_id", "p.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; null texts stay."""
    mark = free_name(docs, "passages")
    return find_passages(docs, benchmark, out=mark, **options).where(F.size(mark) == 0).drop(mark)
