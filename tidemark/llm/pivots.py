"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Each shard of the index
posts its vectors in one inverted file a pivot, with the pivot's place in the
vector's list. A query reads the files of its own nearest pivots, ranks the
vectors by Spearman's footrule over those lists (a pivot that a list lacks
counts as its end) and the best are ranked again by exact distance.

The queries are a stated part of the table: they meet every shard in blocks of
bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

#: Pivots, drawn by the hash of the vector; the length of the ordered lists.
PIVOTS = 512
LIST = 256
#: Of each shard, the share and the least number of vectors that are ranked again.
SHARE, LEAST = 0.35, 400
#: Vectors in a shard and queries in a block, about.
SHARD, BLOCK = 20_000, 4_096


def valid_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v`` of rows with an id and a vector that is neither null, empty nor zero and has finite parts only."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return rows.select(F.col(f"`{vec_id}`").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(finite & some)


def of_one_length(vectors: DataFrame) -> DataFrame:
    """Vectors of the most frequent length, of equally frequent ones the smallest; others have no distance to them and take no part."""
    first = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return vectors if first is None else vectors.where(F.size("v") == first["n"])


def choose_pivots(vectors: DataFrame, n: int = PIVOTS):
    """At most ``n`` distinct vectors with the smallest hashes, as a matrix."""
    import numpy as np

    picked = vectors.groupBy(F.xxhash64("v").alias("h")).agg(F.min("v").alias("v")).orderBy("h").limit(n).collect()
    return np.array([r["v"] for r in picked], np.float64)


def pivot_lists(x, pivots, length: int):
    """The ``length`` nearest pivots of each row in order, ties to the earlier pivot."""
    import numpy as np

    far = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
    return np.argsort(far, axis=1, kind="stable")[:, :length].astype(np.int16)


def footrule(query_list, starts, members, places, length: int, n: int):
    """Footrule distances of one query list to ``n`` vectors from the inverted files of its pivots."""
    import numpy as np

    total = np.full(n, length * (length + 1), np.int32)
    for at, pivot in enumerate(query_list.tolist()):
        lo, hi = starts[pivot], starts[pivot + 1]
        # A shared pivot counts the difference of places instead of two missing ones.
        total[members[lo:hi]] += np.abs(places[lo:hi] - at) - (length - at) - (length - places[lo:hi])
    return total


def _searcher(pivots, k: int, length: int, share: float, least: int):
    def search(index, queries):
        import numpy as np
        import pyarrow as pa

        out: list[tuple[int, int, float]] = []
        ids = index.column("vec_id").to_numpy()
        asked = queries.column("query_id").to_numpy()
        if len(ids) and len(asked):
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            matrix = lambda col: np.asarray(col.combine_chunks().values.to_numpy(), np.float64).reshape(len(col), -1)
            x = matrix(index.column("v"))[order]
            q = matrix(queries.column("v"))
            size = min(length, len(pivots))
            lists = pivot_lists(x, pivots, size)
            # Inverted files: members of each pivot, smallest id first, with the pivot's place.
            flat = lists.ravel()
            by = np.argsort(flat, kind="stable")
            members, places = (by // size).astype(np.int64), (by % size).astype(np.int32)
            starts = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
            take = max(least, int(share * len(ids)), k + 1)
            for row, query_list in zip(range(len(asked)), pivot_lists(q, pivots, size)):
                rank = footrule(query_list, starts, members, places, size, len(ids))
                # Ties at the cut go to smaller ids: rows are in id order and the rank is made unique.
                near = np.argpartition(rank * np.int64(len(ids)) + np.arange(len(ids)), take - 1)[:take] if take < len(ids) else np.arange(len(ids))
                far = np.sqrt(((x[near] - q[row]) ** 2).sum(1))
                other = ids[near] != asked[row]
                near, far = near[other], far[other]
                best = np.lexsort((ids[near], far))[:k]
                out += [(int(asked[row]), int(ids[near[b]]), float(far[b])) for b in best]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

    return search


def search(rows: DataFrame, is_query, k: int = 10, pivots: int = PIVOTS, length: int = LIST, share: float = SHARE, least: int = LEAST, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query(vec_id)`` holds.

    Nearest by Euclidean distance, ties to the smaller id; fewer rows only where
    the table has fewer candidates. Rows with the query's own id are no candidates;
    invalid vectors and those of an odd length take no part.
    """
    vectors = of_one_length(cut_lineage(valid_vectors(rows)))
    counts = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query(F.col("vec_id")), 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard)), max(1, -(-counts["q"] // block))
    table = choose_pivots(vectors, pivots)
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    posted = vectors.select(spread(shards, 1).alias("shard"), every(blocks, "block"), "vec_id", "v")
    asked = vectors.where(is_query(F.col("vec_id"))).select(every(shards, "shard"), spread(blocks, 2).alias("block"), F.col("vec_id").alias("query_id"), "v")
    found = posted.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_searcher(table, k, length, share, least), "query_id bigint, vec_id bigint, score double")
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(rows: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``; see ``search``."""
    return search(rows, lambda i: i % every == 0, k)
