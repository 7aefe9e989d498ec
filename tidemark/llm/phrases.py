"""Collocations by top-order marginalisation.

Every word opens one window of up to ``LONGEST`` words of its piece; only these
longest windows are counted. They are padded to that length, and Spark's ROLLUP
over language and the word columns sums the counts of ever shorter prefixes, so
a phrase of any length has its count without an n-gram table of its own, and
the language's own row is the number of its words.

A window ends early where no phrase that is frequent enough can reach: a first
pass counts the hashes of all phrases in ``BUCKETS`` counters a length, and a
window stops before a phrase whose counter, or that of a phrase inside it, stays
below the limit. A counter is never less than the count of any of its phrases,
so no frequent one is cut. A window that stops before its first word is empty
and still counts for its language.

There are more counters than phrases of a length in some hundred gigabytes of
text, so they tell rare phrases from frequent ones at any such size. Only the
counters that a task uses travel, as sorted steps with their counts; only those
that reach the limit come back, at most one for each ``least`` words.

Hot keys: tasks send each of their distinct windows once, packed with others of the
same block, counters stop at the limit, and the report is limited for each
language before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

LONGEST = 5
#: Counters for the n-grams of one length, 2^32 at most. Only the work depends on it.
BUCKETS = 1 << 32
#: Ranges of the counters of one length; what a task has in a range travels as one row.
BLOCKS = 1 << 10
#: n-grams of one length, and windows, that a task gathers before it sorts and sends them.
GATHERED, GATHERED_WINDOWS = 6_000_000, 3_000_000
#: Counts of a range from which on it is added up in an array of all its counters.
DENSE = 1 << 18
#: Bits of a worker's table for each counter that reaches the limit, and most bits of it: 64 MB.
TABLE_BITS, TABLE_MOST = 32, 29
#: Words of one step of a task, and words that a task remembers between steps.
STEP, REMEMBERED = 1_000_000, 1_000_000
PAD = ""
NO_LANG = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Bytes that no UTF-8 text holds.
PIECE_END, TEXT_END, WORD_END = b"\xff", b"\xfe", b"\xff"


def _table() -> bytes:
    to = bytearray(bytes(range(256)).lower())
    for b in BREAKS:
        to[b] = 10
    return bytes(to)


def _bits(buckets: int) -> int:
    return (buckets - 1).bit_length()


class Words(dict):
    """Numbers and hashes of words; 0 and 1 are the ends of a piece and of a text."""

    def __init__(self) -> None:
        self.words: list[bytes] = []
        self.hashes: list[int] = []
        for mark in (PIECE_END, TEXT_END):
            self[mark]

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        at = self[word] = len(self.words)
        self.words.append(word)
        self.hashes.append(xxh64_intdigest(word))
        return at


def _steps(batches: Iterator, table: bytes):
    """``(languages, texts)`` of about ``STEP`` words each; a text is never cut."""
    langs, texts, size = [], [], 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            langs.append(lang)
            texts.append((text or b"").translate(table).replace(b"\n", b" " + PIECE_END + b" "))
            size += len(texts[-1])
            if size > 6 * STEP:
                yield langs, texts
                langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


class _Grams:
    """The words of one step: their numbers, languages and the hashes of the n-grams that start at them."""

    def __init__(self, words: Words, langs: list[str], texts: list[bytes], longest: int, buckets: int):
        import numpy as np
        from xxhash import xxh64_intdigest

        split = (b" " + TEXT_END + b" ").join(texts).split()
        self.ids = np.fromiter(map(words.__getitem__, split), np.int64, len(split))
        self.names = sorted(set(langs))
        place = {x: k for k, x in enumerate(self.names)}
        self.lang = np.array([place[x] for x in langs], np.int64)[np.cumsum(self.ids == 1)]
        self.word = self.ids > 1
        self.longest, self.shift = longest, np.uint64(64 - _bits(buckets))
        self.hash_of = np.array(words.hashes, np.uint64)
        self.seed = np.array([xxh64_intdigest(x.encode()) for x in self.names], np.uint64)

    def lengths(self):
        """For every length, where a phrase of it starts and the counter of each start."""
        import numpy as np

        mine, ok = self.hash_of[self.ids], self.word
        code = self.seed[self.lang] + mine
        for n in range(1, self.longest + 1):
            if n > 1:
                ok = ok[:-1] & self.word[n - 1 :]
                code = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + mine[n - 1 :]
            mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield n, ok, (mixed >> self.shift).astype(np.uint32)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))


class _Sparse:
    """Counts of one length by counter as rows ``block, steps, rest``: distances to the counter before, the lowest bytes apart, and counts."""

    def __init__(self, buckets: int, top: int):
        import numpy as np
        import pyarrow as pa

        self.width = max(0, _bits(buckets) - _bits(BLOCKS))
        self.top, self.kind = top, np.dtype(np.uint8 if top <= 0xFF else np.uint16)
        self.codec = pa.Codec("zstd", compression_level=1)

    def packed(self, n: int, codes) -> Iterator[tuple[int, bytes, bytes]]:
        import numpy as np

        codes.sort()
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        counts = np.minimum(np.diff(np.r_[first, len(codes)]), self.top).astype(self.kind)
        codes = codes[first]
        block = codes >> np.uint32(self.width)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        steps = np.diff(codes, prepend=np.uint32(0))
        steps[starts] = codes[starts] - (block[starts] << np.uint32(self.width))
        low, mid, high = (((steps >> np.uint32(k)) & np.uint32(0xFF)).astype(np.uint8) for k in (0, 8, 16))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(codes)], strict=True):
            rest = counts[a:b].tobytes() + high[a:b].tobytes() + mid[a:b].tobytes()
            yield (n - 1) * BLOCKS + int(block[a]), low[a:b].tobytes(), self.codec.compress(rest, asbytes=True)

    def unpacked(self, low: bytes, rest: bytes):
        """Counters within the block, each once and in order, and their counts."""
        import numpy as np

        n, size = len(low), self.kind.itemsize
        plain = self.codec.decompress(rest, n * (size + 2), asbytes=True)
        steps = np.frombuffer(low, np.uint8).astype(np.uint32)
        for k, shift in ((1, 8), (0, 16)):
            steps |= np.frombuffer(plain, np.uint8, n, n * (size + k)).astype(np.uint32) << np.uint32(shift)
        return np.cumsum(steps, dtype=np.uint32), np.frombuffer(plain, self.kind, n).astype(np.int32)


class _Block:
    """Sums of one block: an array of all its counters once it has many counts."""

    def __init__(self, sparse: _Sparse):
        self.sparse, self.parts, self.held, self.sums = sparse, [], 0, None

    def add(self, at, counts) -> None:
        import numpy as np

        if self.sums is not None:
            self.sums[at] = np.minimum(self.sums[at] + counts, self.sparse.top)
            return
        self.parts.append((at, counts))
        self.held += len(at)
        if self.held > DENSE:
            self.sums, parts, self.parts = np.zeros(1 << self.sparse.width, np.int32), self.parts, []
            for part in parts:
                self.add(*part)

    def reached(self):
        """The counters that come to the limit, in order."""
        import numpy as np

        if self.sums is not None:
            return np.flatnonzero(self.sums >= self.sparse.top).astype(np.uint32)
        at, counts = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return at[first][np.add.reduceat(counts[order].astype(np.int64), first) >= self.sparse.top]


def reachable(texts: DataFrame, least: int, longest: int = LONGEST, buckets: int = BUCKETS) -> list[bytes]:
    """For every length, the sorted counters whose phrases come to ``least`` or more together, as 32-bit numbers.

    At most one counter for each ``least`` words is returned. Tasks cut their counts at ``least``, which changes no counter's answer.
    """
    import numpy as np
    import pyarrow as pa

    # A limit beyond the width of a count only lets more phrases pass.
    table, top = _table(), min(least, 0xFFFF)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sparse, gathered, held = Words(), _Sparse(buckets, top), [[] for _ in range(longest)], 0
        for langs, step in _steps(batches, table):
            if len(words) > REMEMBERED:
                words = Words()
            grams = _Grams(words, langs, step, longest, buckets)
            for n, ok, code in grams.lengths():
                gathered[n - 1].append(code[ok])
            held += len(grams.ids)
            del grams
            if held > GATHERED:
                yield from rows_of(sparse, gathered)
                held = 0
        yield from rows_of(sparse, gathered)

    def rows_of(sparse: _Sparse, gathered: list[list]) -> Iterator[pa.RecordBatch]:
        for n, parts in enumerate(gathered, 1):
            codes = np.concatenate(parts) if parts else ()
            parts.clear()
            if len(codes):
                block, steps, rest = zip(*sparse.packed(n, codes), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(steps, pa.binary()), pa.array(rest, pa.binary())], ["block", "steps", "rest"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sparse, now, sums = _Sparse(buckets, top), None, None
        for b in batches:
            for block, steps, rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now:
                    yield from reached(now, sums)
                    now, sums = block, _Block(sparse)
                sums.add(*sparse.unpacked(steps, rest))
        yield from reached(now, sums)

    def reached(block: int | None, sums: _Block | None) -> Iterator[pa.RecordBatch]:
        if block is not None and len(at := sums.reached()):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([at.tobytes()], pa.binary())], ["block", "counters"])

    sent = texts.mapInArrow(count, "block int, steps binary, rest binary")
    summed = sent.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, counters binary")
    found = {r.block: bytes(r.counters) for r in summed.collect()}
    width = _Sparse(buckets, top).width
    whole = lambda k: (np.frombuffer(found[k], np.uint32) + np.uint32((k % BLOCKS) << width)).tobytes()
    return [b"".join(whole(k) for k in range(n * BLOCKS, (n + 1) * BLOCKS) if k in found) for n in range(longest)]


class _Open:
    """Whether a counter is among those given; a few others may pass."""

    def __init__(self, counters: bytes, buckets: int):
        import numpy as np

        at = np.frombuffer(counters, np.uint32)
        size = min(_bits(buckets), max(16, min(TABLE_MOST, (TABLE_BITS * len(at)).bit_length())))
        self.shift = np.uint32(_bits(buckets) - size)
        at = at >> self.shift
        self.table = np.zeros((1 << size) // 8 + 1, np.uint8)
        np.bitwise_or.at(self.table, at >> np.uint32(3), np.uint8(1) << (at & np.uint32(7)).astype(np.uint8))

    def __call__(self, codes):
        import numpy as np

        at = codes >> self.shift
        return (self.table[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1


def _sorted(columns: list, widths: list[int]):
    """The order that brings equal rows together, and where in it each kind begins; a column is below two to its width."""
    import numpy as np

    keys, room = [], 0
    for c, width in zip(columns, widths, strict=True):
        if width > room:
            keys.append(c.astype(np.uint64))
            room = 64 - width
        else:
            keys[-1] = keys[-1] << np.uint64(width) | c.astype(np.uint64)
            room -= width
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def _planes(numbers) -> bytes:
    """32-bit numbers, their lowest bytes first."""
    import numpy as np

    return np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(planes: bytes, n: int, at: int):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(planes, np.uint8, 4 * n, at).reshape(4, -1).T).view("<u4").reshape(-1)


class _Windows:
    """The distinct windows of a task and their counts, by length; sent as rows ``block, size, packed``."""

    def __init__(self, words: Words, longest: int):
        import pyarrow as pa

        self.words, self.names = words, {}
        self.parts: list[list] = [[] for _ in range(longest + 1)]
        self.held = 0
        self.codec = pa.Codec("zstd", compression_level=1)

    def add(self, grams: _Grams, length, block) -> None:
        """One window for each word of a step: how many words it has, and its block."""
        import numpy as np

        lang = np.array([self.names.setdefault(x, len(self.names)) for x in grams.names], np.int32)[grams.lang]
        for n, parts in enumerate(self.parts):
            at = np.flatnonzero(grams.word & (length == n))
            if len(at):
                columns = [lang[at], *(grams.ids[at + k].astype(np.int32) for k in range(n))]
                order, first = self._order(columns)
                some = order[first]
                parts.append([np.diff(np.r_[first, len(order)]), block[at[some]], *(c[some] for c in columns)])
                self.held += len(some)

    def _order(self, columns: list):
        return _sorted(columns, [len(self.names).bit_length(), *[len(self.words).bit_length()] * (len(columns) - 1)])

    def rows(self):
        """What was added so far as record batches."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = pa.array([x.encode() for x in self.names], pa.binary())
        for parts in self.parts:
            if not parts:
                continue
            counts, block, *columns = (np.concatenate(c) for c in zip(*parts, strict=True))
            parts.clear()
            order, first = self._order(columns)
            counts, some = np.add.reduceat(counts[order], first), order[first]
            by = np.argsort(block[some], kind="stable")
            counts, some = counts[by], some[by]
            block = block[some]
            used = np.zeros(len(self.words), bool)
            for c in columns[1:]:
                used[c] = True
            spelled, number = pa.array([self.words.words[k] for k in np.flatnonzero(used)], pa.binary()), np.cumsum(used) - 1
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            # Blocks that are spelled out at once: up to some 50,000 windows and one block.
            for some_starts in np.split(starts, np.flatnonzero(np.diff(starts // 50_000)) + 1):
                begin = int(some_starts[0])
                end = int(np.append(starts, len(block))[np.searchsorted(starts, some_starts[-1]) + 1])
                mine = some[begin:end]
                made = [names.take(pa.array(columns[0][mine])), *(spelled.take(pa.array(number[c[mine]])) for c in columns[1:])]
                keys = pc.binary_join_element_wise(*made, WORD_END).to_pylist()
                yield self._packed(keys, counts[begin:end], block[begin:end], (some_starts - begin).tolist())
        self.held = 0

    def _packed(self, keys: list[bytes], counts, block, starts: list[int]):
        import numpy as np
        import pyarrow as pa

        packed = []
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            plain = b"".join([_planes(counts[a:b]), _planes(np.fromiter(map(len, keys[a:b]), np.int64, b - a)), *keys[a:b]])
            packed.append((int(block[a]), b - a, len(plain), self.codec.compress(plain, asbytes=True)))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*packed, strict=True), kinds, strict=True)], ["block", "n", "size", "packed"])


def windows(texts: DataFrame, counters: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``lang, words, n``: the distinct longest windows with their counts."""
    import pyarrow as pa

    table = _table()
    shared = texts.sparkSession.sparkContext.broadcast(counters)
    width = max(0, _bits(buckets) - _bits(BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        open_ = [_Open(b, buckets) for b in shared.value]
        words = Words()
        found = _Windows(words, longest)
        for langs, step in _steps(batches, table):
            if len(words) > REMEMBERED:
                yield from found.rows()
                words = Words()
                found = _Windows(words, longest)
            grams = _Grams(words, langs, step, longest, buckets)
            length, block, goes_on = np.zeros(len(grams.ids), np.int8), np.zeros(len(grams.ids), np.int16), None
            for n, ok, code in grams.lengths():
                may = np.flatnonzero(ok if goes_on is None else ok & goes_on[:-1] & goes_on[1:])
                may = may[open_[n - 1](code[may])]
                goes_on = np.zeros(len(ok), bool)
                goes_on[may] = True
                length[may], block[may] = n, code[may] >> np.uint32(width)
            found.add(grams, length, block)
            if found.held > GATHERED_WINDOWS:
                yield from found.rows()
        yield from found.rows()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        def summed(parts: list[pa.Table]) -> pa.Table:
            whole = pa.concat_tables(parts).group_by("key", use_threads=False).aggregate([("n", "sum")])
            return pa.table({"key": whole["key"], "n": whole["n_sum"]})

        def rows(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            for b in summed(parts).to_batches(max_chunksize=50_000):
                split = pc.split_pattern(b.column("key"), WORD_END)
                words = pc.list_slice(split, 1).cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pc.list_element(split, 0).cast(pa.string()), words, b.column("n")], ["lang", "words", "n"])

        codec, now, parts, held, kept = pa.Codec("zstd"), None, [], 0, 0
        for b in batches:
            for block, n, size, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now:
                    if parts:
                        yield from rows(parts)
                    now, parts, held, kept = block, [], 0, 0
                plain = codec.decompress(packed, size, asbytes=True)
                ends = np.zeros(n + 1, np.int32)
                np.cumsum(_from_planes(plain, n, 4 * n), out=ends[1:])
                keys = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(plain[8 * n :])])
                parts.append(pa.table({"key": keys, "n": pa.array(_from_planes(plain, n, 0).astype(np.int64))}))
                held += n
                if held > 2 * kept + DENSE:
                    parts = [summed(parts)]
                    held = kept = len(parts[0])
        if parts:
            yield from rows(parts)

    sent = texts.mapInArrow(run, "block int, n int, size int, packed binary")
    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(add, "lang string, words array<string>, n bigint")


def marginals(counted: DataFrame, least: int, longest: int = LONGEST) -> DataFrame:
    """``lang, words, f``: languages (no words) and phrases that occur ``least`` times or more, from one ROLLUP."""
    columns = [f"w{n}" for n in range(1, longest + 1)]
    padded = counted.select("lang", *(F.coalesce(F.get("words", F.lit(k)), F.lit(PAD)).alias(c) for k, c in enumerate(columns)), "n")
    summed = padded.rollup("lang", *columns).agg(F.sum("n").alias("f"))
    words = F.filter(F.array(*columns), lambda x: x.isNotNull())
    kept = summed.where("lang is not null").select("lang", words.alias("words"), "f")
    return kept.where((F.size("words") == 0) | ((F.col("f") >= least) & ~F.array_contains("words", PAD)))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def scored(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates ``lang, phrase, a, l, r, n, score, k`` of ``marginals``, without those that a longer one of the same count holds."""
    counts = found.where("size(words) > 0").select("lang", _joined(F.col("words")).alias("phrase"), "words", "f")
    n_of = found.where("size(words) = 0").select("lang", F.col("f").alias("n"))
    candidates = counts.where("size(words) > 1").withColumnRenamed("f", "a")
    # A longer phrase of the same count exists if one that is longer by a single word does.
    size = F.size("words")
    ends = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    inside = candidates.where(size > 2).select("lang", F.explode(ends).alias("part"), "a").groupBy("lang", _joined(F.col("part")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where("longer is null or longer < a")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.slice("words", F.lit(1), F.col("k"))).alias("head"), _joined(F.expr("slice(words, k + 1, size(words) - k)")).alias("rest"))
    part = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    joined = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).join(n_of, "lang")
    exact = "cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    best = joined.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.col("cut.k").cast("bigint").alias("k"))


def collocations(docs: DataFrame, least: int = 100, top: int | None = 2000, longest: int = LONGEST, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of phrases of 2 to ``longest`` words that occur ``least`` times or more.

    Texts are ASCII-lower-cased and cut into pieces and words; a phrase lies
    within one piece. ``a``, ``l`` and ``r`` count the phrase and the two parts
    of its lowest-scoring cut, ``n`` all words of the language; the score is
    floor(1000 * a * n / (l * r)) in exact decimals. A phrase inside a longer
    one that occurs as often is left out. ``top`` limits the report of a
    language; ties go to the greater ``a``, then to the phrase in byte order.

    A null text is empty, a null language is ``und``. Repeated rows count as
    often as they occur; other columns play no part; an empty table or one
    without frequent phrases gives no rows.
    """
    texts = _texts(docs, text, lang)
    found = cut_lineage(marginals(windows(texts, reachable(texts, least, longest, buckets), longest, buckets), least, longest))
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(found, longest).withColumn("rank", F.row_number().over(first).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
