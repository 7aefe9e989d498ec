"""N-gram Jaccard join by a partition of the universe.

A text is the set of its distinct word n-grams. Sets whose similarity reaches
the limit differ in at most ``most_differing`` members, a number that grows with
their sizes, so sizes fall into bands and each band has a scheme of its own: the
universe of hashes is cut into more segments than two sets of the band can
differ in. By the pigeonhole principle such sets agree on a whole segment. The
greater set of a pair indexes all its segments under the scheme of its band. The
smaller one looks up a subset of its segments, as many as their sizes can differ
in plus one: those with most members, whose lists are shortest, and no empty
ones. Where these are too few, segments with an index of one-deletion
neighbourhoods count twice, cheapest first: agreeing but for one member uses up
two of the differences. A set that is still short is compared with all sets of
fitting size (with the given limits about one in a million small sets).

Pairs found must fit by size and by parity bits of the sets, both exact bounds;
whole sets decide.

Hot keys: equal sets are one class; a task signs each of its distinct texts once.
A list with more than ``CROWD`` classes is not paired up. Its members are
compared with the one that is in most such lists, which links most copies of one
text; after that only members of different components are compared, and only
for sets that have no other segments left to look up instead. Such a set leaves
out its longest lists, as many as it may miss, and meets in the others the sets
of its size or above. No link between classes is lost that the components need.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import words_of
from tidemark.llm.graph import components
from tidemark.session import cut_lineage, run_dir

#: Least size of a band over that of the band below.
GROWTH = 1.75
#: Segments beyond those that the pigeonhole principle needs: a share and a number.
SPARE_SHARE, SPARE = 0.1, 3
#: All segments have a one-deletion index in bands up to this size, and so many in others.
DELETED_UP_TO, DELETED = 31, 2
#: Classes of a list that are compared pair by pair.
CROWD = 16
#: Parity bits of a set, at least; greater sets have two for each member, rounded up to a power of two.
PARITY = 256
#: Parity bits that go along with a list, at most: a list's rows stay small however long a text is.
CARRIED = 4096


def shingles(text: bytes | None, width: int = 5):
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, one without words has none."""
    import numpy as np
    from xxhash import xxh64_digest

    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - width)]]
    stops = ends[min(width, len(words)) - 1 :]
    return np.unique(np.frombuffer(b"".join([xxh64_digest(joined[s : e - 1], 42) for s, e in zip(starts, stops)]), np.uint64))


def most_differing(size: int, other: int, percent: int) -> int:
    """Members in just one of two sets with this similarity, at most."""
    return (100 - percent) * (size + other) // (100 + percent)


def band_starts(percent: int, limit: int = 1 << 40) -> list[int]:
    """Least sizes of the bands; a set is similar to none beyond the next band."""
    growth, starts = max(GROWTH, 100 / percent), [1]
    while starts[-1] < limit:
        starts.append(max(starts[-1] + 1, int(starts[-1] * growth)))
    return starts


class Scheme:
    """The cut of the universe for pairs whose greater set lies in a band."""

    def __init__(self, band: int, least: int, most: int, percent: int, spare: int = SPARE, deleted_up_to: int = DELETED_UP_TO):
        differing = most_differing(most, most, percent)
        self.band, self.most, self.percent = band, most, percent
        self.segments = 1 if not differing else int((differing + 1) * (1 + SPARE_SHARE)) + spare
        self.deleted = self.segments if most <= deleted_up_to else DELETED

    def needed(self, size: int) -> int:
        """Segments that the smaller set must look up."""
        return most_differing(size, min(self.most, size * 100 // self.percent), self.percent) + 1


def _mixed(x):
    """Well spread 64-bit values."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Cut:
    """One set under one scheme: sizes and sums of its segments."""

    def __init__(self, scheme: Scheme, hashes, mixed):
        import numpy as np

        self.scheme, self.mixed = scheme, mixed
        of = ((hashes >> np.uint64(32)) * np.uint64(scheme.segments)) >> np.uint64(32)
        self.at = np.searchsorted(of, np.arange(scheme.segments + 1, dtype=np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        self.sums = total[self.at[1:]] - total[self.at[:-1]]
        self.sizes = np.diff(self.at)

    def _keys(self, segments, sums, neighbour: bool):
        import numpy as np

        base = np.uint64((self.scheme.band * 2 + neighbour) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return _mixed(sums + _mixed(segments.astype(np.uint64) + base))

    def whole(self, segments, neighbour: bool = False):
        """Keys of whole segments, in the index of segments or that of neighbours."""
        return self._keys(segments, self.sums[segments], neighbour)

    def without_one(self, segments, neighbour: bool):
        """Keys of the segments with each single member left out."""
        import numpy as np

        where = np.repeat(segments, self.sizes[segments])
        members = np.concatenate([np.arange(self.at[s], self.at[s + 1]) for s in segments]) if len(segments) else np.zeros(0, np.int64)
        return self._keys(where, self.sums[where] - self.mixed[members], neighbour)


def signature(hashes, schemes: list[Scheme]):
    """``keys, spare, short``: the keys of a set; how many it could miss; bands it could not look up fully."""
    import numpy as np

    size = len(hashes)
    mixed = _mixed(hashes)
    own = next(s for s in schemes if size <= s.most)
    keys, spare, short = [], [], []
    for scheme in schemes[own.band : own.band + 2]:
        if scheme is not own and size * 100 // scheme.percent <= own.most:
            break
        cut = Cut(scheme, hashes, mixed)
        full = np.flatnonzero(cut.sizes)
        needed = scheme.needed(size)
        paired = np.flatnonzero(cut.sizes[: scheme.deleted] > 1)
        if scheme is own:
            # As the greater set: all segments and their neighbourhoods.
            chosen = full
            keys.append(cut.without_one(paired, True))
        else:
            # A few more than needed, so that crowded lists need not be read.
            take = needed + max(2, needed // 10)
            chosen = full[np.argsort(-cut.sizes[full], kind="stable")[:take]]
        keys.append(cut.whole(chosen))
        missing = needed - len(chosen)
        if missing > 0:
            twice = paired[np.argsort(cut.sizes[paired], kind="stable")[:missing]]
            keys += [cut.whole(twice, True), cut.without_one(twice, False)]
            if len(twice) < missing:
                short.append(scheme.band)
        spare.append(max(0, -missing))
    return np.unique(np.concatenate(keys)), min(spare), short


def parity_bits(hashes):
    """For every counter, whether an odd number of members fall into it, as 64-bit numbers."""
    import numpy as np

    bits = max(PARITY, 2 << (len(hashes) - 1).bit_length()) if len(hashes) else PARITY
    odd = np.bincount(_mixed(hashes) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64)


def signed_sets(docs: DataFrame, percent: int, width: int, text: str, doc_id: str, **limits: int) -> DataFrame:
    """Per row: ``doc_id``, digest ``h`` of its set, its first 64 bits ``node``, size ``n``, band, parity bits; keys once a task for each set."""
    import numpy as np
    import pyarrow as pa

    starts = band_starts(percent)
    schemes = [Scheme(k, a, b - 1, percent, **limits) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
    names = ["doc_id", "h", "node", "n", "band", "parity", "coarse", "spare", "short", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import md5

        seen: set[bytes] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = []
                for t in part.column(1).to_pylist():
                    own = shingles(t, width)
                    h = md5(own.tobytes()).digest()
                    parity = parity_bits(own)
                    coarse = np.bitwise_xor.reduce(parity.reshape(-1, PARITY // 64))
                    keys, spare, short = (np.zeros(0, np.uint64), 0, [])
                    if len(own) and h not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(h)
                        keys, spare, short = signature(own, schemes)
                    band = next(s.band for s in schemes if len(own) <= s.most)
                    rows.append((h, int.from_bytes(h[:8], "big", signed=True), len(own), band, parity, coarse, spare, short, keys.view(np.int64)))
                if rows:
                    cols = list(zip(*rows))
                    types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names)

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, h binary, node bigint, n bigint, band int, parity array<bigint>, coarse array<bigint>, spare bigint, short array<int>, keys array<bigint>"
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)


def listed_pairs(entries: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``a, b, key`` of ``entries(key, node)``: pairs within a list, without a key; the key of a crowded one and all its members ``b`` beside the first, ``a``."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, key=None):
            for at in range(0, len(a), 50_000):
                s = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(a[s]), pa.array(b[s]), pa.nulls(len(a[s]), pa.int64()) if key is None else pa.array(key[s])], ["a", "b", "key"])

        def lists(key, node):
            """Whole lists, sorted by key and node."""
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[new, len(key)])
            size, first = np.repeat(sizes, sizes), np.repeat(node[new], sizes)
            many = (size > crowd) & (node != first)
            yield from out(first[many], node[many], key[many])
            few = (size > 1) & (size <= crowd)
            key, node = key[few], node[few]
            for step in range(1, min(crowd, int(sizes.max(initial=1)))):
                same = key[step:] == key[:-step]
                if not same.any():
                    break
                yield from out(node[:-step][same], node[step:][same])

        held_key, held_node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        running: tuple[int, int] | None = None  # key and first member of a crowded list that goes on
        for b in batches:
            key = np.r_[held_key, b.column(0).to_numpy()]
            node = np.r_[held_node, b.column(1).to_numpy()]
            fresh = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
            key, node = key[fresh], node[fresh]
            if running is not None:
                more = int(np.searchsorted(key, running[0], side="right"))
                yield from out(np.full(more, running[1]), node[:more], key[:more])
                key, node = key[more:], node[more:]
                if not len(key):
                    held_key, held_node = key, node
                    continue
                running = None
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            yield from lists(key[:last], node[:last])
            held_key, held_node = key[last:], node[last:]
            if len(held_key) > crowd:
                yield from lists(held_key, held_node)
                running = int(held_key[0]), int(held_node[0])
                held_key, held_node = held_key[:0], held_node[:0]
        if len(held_key):
            yield from lists(held_key, held_node)

    return entries.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "a bigint, b bigint, key bigint")


def _folded(bits: Column, to: Column) -> Column:
    """Parity bits with half as many counters where the other side has fewer."""
    half = F.floor(F.size(bits) / 2).cast("int")
    folded = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > F.size(to), folded).otherwise(bits)


def _may_be_similar(percent: int) -> Column:
    """Bounds by size and by parity bits, of columns with the endings _a and _b.

    Sets of fitting size have as many counters or twice as many. Each counter
    that differs stands for a member in just one of the sets.
    """
    a, b = F.col("parity_a"), F.col("parity_b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    apart = F.aggregate(F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(sizes, apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).otherwise(False)


def _coarsely_similar(percent: int) -> Column:
    """The bound by parity bits with ``PARITY`` counters, of columns with the endings _a and _b."""
    apart = sum(F.bit_count(F.col(f"coarse{k}_a").bitwiseXOR(F.col(f"coarse{k}_b"))) for k in range(PARITY // 64))
    return apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def _carried(parity: Column) -> Column:
    """Parity bits with at most ``CARRIED`` counters."""
    longs = CARRIED // 64
    folded = F.transform(F.sequence(F.lit(0), F.lit(longs - 1)), lambda k: F.aggregate(F.sequence(k, F.size(parity) - 1, F.lit(longs)), F.lit(0).cast("bigint"), lambda x, at: x.bitwiseXOR(F.get(parity, at))))
    return F.when(F.size(parity) > longs, folded).otherwise(parity)


class Join:
    """The steps of one join; ``classes``: one row for each distinct set, with its number ``id``."""

    def __init__(self, docs: DataFrame, percent: int, width: int, text: str, doc_id: str, crowd: int, **limits: int):
        self.docs, self.percent, self.width, self.text, self.doc_id, self.crowd = docs, percent, width, text, doc_id, crowd
        folder = f"{run_dir(docs.sparkSession, 'jaccard')}/signed"
        signed_sets(docs, percent, width, text, doc_id, **limits).write.parquet(folder)
        self.signed = docs.sparkSession.read.parquet(folder)
        facts = ["node", "n", "band", "parity", "coarse"]
        every = self.signed.where("n > 0").groupBy("h").agg(F.min("doc_id").alias("least"), F.max("spare").alias("spare"), *[F.min(c).alias(c) for c in facts])
        self.classes = cut_lineage(every.withColumn("id", F.monotonically_increasing_id()))

    def _side(self, end: str, *more: str) -> DataFrame:
        kept = ["id", "n", "parity", *more]
        return self.classes.select(*[F.col(c).alias(f"{c}_{end}") for c in kept])

    def _numbered(self, pairs: DataFrame) -> DataFrame:
        """Pairs of classes for pairs ``a, b`` of nodes, as far as size and parity allow."""
        joined = pairs.join(self._side("a", "node"), F.col("a") == F.col("node_a")).join(self._side("b", "node"), F.col("b") == F.col("node_b"))
        return joined.where(_may_be_similar(self.percent)).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    def _short(self) -> DataFrame:
        """Sets that could not look up a band fully, with all sets of that band."""
        short = self.signed.where(F.size("short") > 0).select("h", F.explode("short").alias("band_b")).distinct()
        asked = short.join(self.classes.select("h", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "parity")]), "h")
        return asked.join(self._side("b", "band"), "band_b").where((F.col("id_a") != F.col("id_b")) & _may_be_similar(self.percent)).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    def similar(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` of class numbers whose whole sets are similar."""
        import pyarrow as pa

        width, percent = self.width, self.percent
        pairs = cut_lineage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().join(self.classes.select("id", "h", "least"), "id")

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from hashlib import md5

            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    b = batch.slice(at, 256)
                    made = [shingles(t, width).tobytes() for t in b.column(2).to_pylist()]
                    # The same id may stand for other texts too.
                    right = pa.array([md5(m).digest() == h for m, h in zip(made, b.column(1).to_pylist())], pa.bool_())
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["id", "members"]).filter(right)

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np

            for b in batches:
                kept = []
                for x, y in zip(b.column(2), b.column(3)):
                    one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    kept.append(100 * common >= percent * (len(one) + len(other) - common))
                yield b.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

        texts = self.docs.select(F.col(f"`{self.doc_id}`").alias("doc_id"), F.col(f"`{self.text}`").cast("binary").alias("text"))
        found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["least"])).select("id", "h", "text").mapInArrow(sets, "id bigint, members binary")
        folder = f"{run_dir(self.docs.sparkSession, 'jaccard')}/sets"
        found.dropDuplicates(["id"]).write.parquet(folder)
        one, other = (self.docs.sparkSession.read.parquet(folder).select(F.col("id").alias(c), F.col("members").alias(f"members_{c}")) for c in "ab")
        return cut_lineage(pairs.join(one, "a").join(other, "b").select("a", "b", "members_a", "members_b").mapInArrow(check, "a bigint, b bigint"))

    def links(self) -> DataFrame:
        """Edges ``a, b`` between class numbers that connect all similar classes."""
        entries = self.signed.select("node", F.explode("keys").alias("key")).select("key", "node")
        listed = cut_lineage(listed_pairs(entries, self.crowd).distinct())
        pairs = self._numbered(listed.where("key is null").select("a", "b")).union(self._short())
        crowded = listed.where("key is not null")
        if crowded.isEmpty():
            return self.similar(pairs)
        members = cut_lineage(crowded.select("key", F.col("a").alias("node")).union(crowded.select("key", "b")).distinct())
        edges = self.similar(pairs.union(self._numbered(self._to_centres(members))))
        return edges.union(self.similar(self._across(members, edges)))

    def _to_centres(self, members: DataFrame) -> DataFrame:
        """Every member of a crowded list with the member of it that is in most crowded lists."""
        lists = members.groupBy("node").agg(F.count("*").alias("lists"))
        centres = members.join(lists, "node").groupBy("key").agg(F.max(F.struct("lists", "node"))["node"].alias("a"))
        return members.join(centres, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()

    def _across(self, members: DataFrame, edges: DataFrame) -> DataFrame:
        """Pairs of crowded lists between different components, for sets without enough other segments."""
        found = components(edges).withColumnRenamed("node", "id")
        roots = self.classes.join(found, "id", "left").select("node", "id", F.coalesce("root", "id").alias("root"), "spare")
        pairs = self.met(cut_lineage(members.join(roots, "node").drop("node"))).distinct()
        return pairs.join(self._side("a"), "id_a").join(self._side("b"), "id_b").where(_may_be_similar(self.percent)).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    def met(self, placed: DataFrame) -> DataFrame:
        """Pairs ``id_a, id_b`` that meet in a list of ``placed(key, id, root, spare)``, have different roots and pass the bounds.

        The smaller set of a pair asks. It may miss ``spare`` of its lists, so it
        leaves out the costliest; a list within one component costs nothing.
        """
        lists = placed.groupBy("key").agg(F.count("*").alias("cost"), (F.min("root") < F.max("root")).alias("split"))
        costly = placed.join(lists.withColumn("cost", F.when(F.col("split"), F.col("cost")).otherwise(0)), "key")
        cheapest, own = Window.partitionBy("id").orderBy("cost", "key"), Window.partitionBy("id")
        chosen = costly.withColumn("place", F.row_number().over(cheapest)).withColumn("lists", F.count("*").over(own))
        asked = cut_lineage(chosen.where("split and place <= lists - spare").select("key", "id", "root"))
        facts = self.classes.select("id", "n", *[F.col("coarse")[k].alias(f"coarse{k}") for k in range(PARITY // 64)], _carried(F.col("parity")).alias("parity"))
        ends = lambda df, end: df.join(facts, "id").select("key", *[F.col(c).alias(f"{c}_{end}") for c in ("id", "root", *facts.columns[1:])])
        answering = placed.join(asked.select("key").distinct(), "key").select("key", "id", "root")
        # Pairs that a bound rules out are never made: the cheap bound first, the sharp one for what it leaves.
        near = (F.col("root_a") != F.col("root_b")) & (F.col("n_a") <= F.col("n_b")) & _coarsely_similar(self.percent)
        return ends(asked, "a").join(ends(answering, "b"), "key").where(F.when(near, _may_be_similar(self.percent)).otherwise(False)).select("id_a", "id_b")


def joined(docs: DataFrame, percent: int = 80, width: int = 5, text: str = "text", doc_id: str = "doc_id", crowd: int = CROWD, **limits: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Whole texts are ASCII-lower-cased and split at white space into the set of
    their distinct ``width``-word shingles (64-bit hashes); fewer words are one
    shingle. Rows are linked where ``percent`` or more of the shingles of both
    are common to both. ``component_id`` is the smallest ``doc_id`` reachable by
    links, itself included (null ids do not count).

    Null, empty and blank texts have no shingles and are linked with nothing:
    their component is their own id, which may be null. Repeated rows are
    repeated in the result. Other columns play no part. Empty input gives an
    empty result. ``limits`` (``spare``, ``deleted_up_to``) change the schemes,
    not the result.
    """
    join = Join(docs, percent, width, text, doc_id, crowd, **limits)
    found = components(join.links()).withColumnRenamed("node", "id")
    rooted = join.classes.select("id", "h", "least").join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    placed = rooted.join(smallest, "root").select("h", "component")
    rows = join.signed.select("doc_id", "h", "n")
    with_words = rows.where("n > 0").join(placed, "h").select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return with_words.union(rows.where("n = 0").select("doc_id", "n", F.col("doc_id")))
