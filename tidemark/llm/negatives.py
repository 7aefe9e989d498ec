"""Hard negatives by a multiway hyperplane tree with distance ranges.

Vectors are whole numbers; a score is their inner product. One more coordinate
gives all rows the same length, so a score is an angle: the higher the score,
the smaller the angle between anchor and row. A node of the tree has ``FANOUT``
split points and gives every vector to the nearest one. Each split point stores
the smallest and largest angle to the vectors of every sibling, measured over
all rows. What an anchor asks for lies in an annulus of angles; by the triangle
inequality a sibling whose range misses the annulus as seen from a split point
holds none of it. Leaves are scored exactly.

The upper levels are fitted on a bounded sample and deal the rows out to cells;
every task builds the lower levels over its part of a cell. A question first
goes to the cell it falls in, which bounds its annulus, then to all cells that
the annulus reaches.

Hot keys: of equal vectors with one label only as many ids as an answer can hold
take part; a cell with many rows is dealt out to parts of about ``PART`` rows.
Questions are a stated part of the table and meet the rows in blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

FANOUT, LEAF = 12, 512
#: Rows in a part of a cell, about; rows that the upper levels are fitted on, at most; cells that they aim at, at most.
PART, SAMPLE, CELLS = 20_000, 8_192, 1_024
#: Questions that a task answers together.
BLOCK = 512
#: Angles are compared with this much to spare.
SPARE = 1e-6


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", relabel=None, scale: int = 256) -> DataFrame:
    """``vec_id, label, v`` of the distinct rows with a label and a finite vector; parts of ``v`` are floor(scale * x)."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    v = F.transform(x, lambda e: F.floor(e * scale).cast("double"))
    found = rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").alias("label"), x.alias("x"), v.alias("v"))
    found = found.where("label is not null and x is not null")
    new = F.col("label") if relabel is None else relabel(F.col("vec_id"), F.col("label"))
    return found.where(F.forall("x", _finite)).select("vec_id", new.alias("label"), "v").distinct()


def _least_ids(vectors: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest ids of equal vectors with one label; more cannot be among the first ``n - 1`` of any answer."""
    first = Window.partitionBy(F.xxhash64("v"), "label", "v").orderBy(F.col("vec_id").asc_nulls_last())
    return vectors.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n).drop("place")


@dataclass(eq=False)
class Node:
    """Split points with their added coordinate and children, or the rows of a leaf.

    ``low`` and ``high``: the range of angles from each split point to each sibling's vectors.
    ``number`` is the place among the inner nodes or the leaves of the upper levels.
    """

    points: object = None
    added: object = None
    low: object = None
    high: object = None
    children: list | None = None
    rows: object = None
    number: int = -1


def _padded(column, dim: int):
    """A list column as a matrix; missing last parts are zero."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _added(x, radius: float):
    """The coordinate that brings each row to length ``radius``."""
    import numpy as np

    return np.sqrt(np.maximum(radius**2 - (x**2).sum(1), 0.0))


def _angle(products, radius: float):
    import numpy as np

    return np.arccos(np.clip(products / radius**2, -1.0, 1.0)) if radius else np.zeros_like(products)


def _split(x, added, rows, radius: float, fanout: int, seed: int):
    """Distinct split points among ``rows`` far from each other, and the nearest one of every row."""
    import numpy as np

    draw = np.random.default_rng(seed).permutation(len(rows))[: 4 * fanout]
    pool = rows[draw]
    chosen = [0]
    far = np.full(len(pool), np.inf)
    for _ in range(fanout - 1):
        at = pool[chosen[-1]]
        far = np.minimum(far, _angle(x[pool] @ x[at] + added[pool] * added[at], radius))
        far[chosen] = -1.0
        if far.max() <= SPARE:
            break
        chosen.append(int(far.argmax()))
    picked = pool[chosen]
    angles = _angle(x[rows] @ x[picked].T + np.outer(added[rows], added[picked]), radius)
    return picked, angles, angles.argmin(axis=1)


def build(x, added, rows, radius: float, fanout: int = FANOUT, leaf: int = LEAF, seed: int = 0) -> Node:
    """The tree over ``rows`` of the matrix; a node whose rows cannot be told apart is a leaf."""
    import numpy as np

    if len(rows) <= leaf:
        return Node(rows=rows)
    picked, angles, nearest = _split(x, added, rows, radius, fanout, seed)
    if len(picked) < 2:
        return Node(rows=rows)
    mine = [nearest == k for k in range(len(picked))]
    low = np.array([angles[m].min(axis=0) if m.any() else np.full(len(picked), np.inf) for m in mine]).T
    high = np.array([angles[m].max(axis=0) if m.any() else np.full(len(picked), -np.inf) for m in mine]).T
    children = [build(x, added, rows[m], radius, fanout, leaf, seed + k + 1) for k, m in enumerate(mine)]
    return Node(x[picked], added[picked], low, high, children)


def _meets(node: Node, child: int, to_points, inner, outer):
    """For every question, whether the child's ranges seen from all split points reach the annulus."""
    import numpy as np

    near = np.maximum(to_points - outer[:, None], inner[:, None] - to_points) - SPARE
    far = to_points + outer[:, None] + SPARE
    return ((node.low[:, child] <= far) & (node.high[:, child] >= near)).all(axis=1)


def _question_angles(q, size, points, radius: float):
    """Angles between questions (no added coordinate) and points."""
    import numpy as np

    scale = np.where(size > 0, size, 1.0)[:, None] * (radius or 1.0)
    return np.arccos(np.clip(q @ points.T / scale, -1.0, 1.0))


def _annulus(low, high, size, radius: float):
    """Angles at which scores from ``low`` to ``high`` lie; a zero question reaches everything."""
    import numpy as np

    scale = np.where(size > 0, size, 1.0) * (radius or 1.0)
    inner = np.where(size > 0, np.arccos(np.clip(high / scale, -1.0, 1.0)), 0.0)
    outer = np.where(size > 0, np.arccos(np.clip(low / scale, -1.0, 1.0)), np.pi)
    return inner, outer


class Finder:
    """The first ``k`` rows of a set for many questions at once.

    A question asks for rows of its own label (``same``) or of all others with
    scores from ``low`` to ``high``; greater scores first, then smaller ids.
    """

    def __init__(self, ids, labels, x, radius: float, k: int, same: bool, leaf: int = LEAF, fanout: int = FANOUT):
        import numpy as np

        self.ids, self.labels, self.x, self.radius, self.k, self.same = ids, labels, x, radius, k, same
        self.tree = build(x, _added(x, radius), np.arange(len(x)), radius, fanout, leaf)
        self.scored = 0

    def find(self, q, own, label, low, high):
        """``(question, row, score)`` arrays: at least the first ``k`` of each question, best first, at most ``k``."""
        import numpy as np

        self.q, self.own, self.label, self.low, self.high = q, own, label, low.copy(), high
        self.size = np.sqrt((q**2).sum(1))
        self.hits: list = []
        self._visit(self.tree, np.arange(len(q)))
        if not self.hits:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        who, row, score = (np.concatenate(c) for c in zip(*self.hits))
        order = np.lexsort((row, self.ids[row], -score, who))
        who, row, score = who[order], row[order], score[order]
        first = np.searchsorted(who, who)
        kept = np.arange(len(who)) - first < self.k
        return who[kept], row[kept], score[kept]

    def _visit(self, node: Node, asked) -> None:
        import numpy as np

        if node.rows is not None:
            for at in range(0, len(node.rows), 4 * LEAF):
                self._score(node.rows[at : at + 4 * LEAF], asked)
            return
        to_points = _question_angles(self.q[asked], self.size[asked], node.points, self.radius)
        # Near children first: their rows narrow the annulus for the others.
        for c in np.argsort(to_points.mean(axis=0)):
            inner, outer = _annulus(self.low[asked], self.high[asked], self.size[asked], self.radius)
            on = asked[_meets(node, c, to_points, inner, outer)]
            if len(on):
                self._visit(node.children[c], on)

    def _score(self, rows, asked) -> None:
        import numpy as np

        self.scored += len(rows) * len(asked)
        scores = self.q[asked] @ self.x[rows].T
        alike = self.label[asked][:, None] == self.labels[rows][None]
        fits = (alike if self.same else ~alike) & (self.own[asked][:, None] != self.ids[rows][None]) & (scores <= self.high[asked][:, None])
        scores = np.where(fits, scores, -np.inf)
        if len(rows) >= self.k:
            best = np.partition(scores, -self.k, axis=1)[:, -self.k]
            self.low[asked] = np.maximum(self.low[asked], best)
        who, at = np.nonzero(fits & (scores >= self.low[asked][:, None]))
        self.hits.append((asked[who], rows[at], scores[who, at]))


class Cells:
    """The upper levels: which cell a vector falls in and which cells an annulus reaches."""

    def __init__(self, x, radius: float, cells: int, fanout: int = FANOUT):
        import numpy as np

        self.radius, self.n = radius, 0
        leaf = max(1, -(-len(x) // max(1, cells)))
        self.root = build(x, _added(x, radius), np.arange(len(x)), radius, fanout, leaf)
        self.nodes: list[Node] = []
        self._name(self.root)

    def _name(self, node: Node) -> None:
        if node.children is None:
            node.number, node.rows = self.n, None
            self.n += 1
            return
        node.number = len(self.nodes)
        self.nodes.append(node)
        for c in node.children:
            self._name(c)

    def place(self, x):
        """Cells of vectors, and for every node, split point and child the range of angles seen: ``(node, point, child, low, high)``."""
        import numpy as np

        added, out, ranges = _added(x, self.radius), np.zeros(len(x), np.int64), []

        def walk(node: Node, rows) -> None:
            if node.children is None:
                out[rows] = node.number
                return
            angles = _angle(x[rows] @ node.points.T + np.outer(added[rows], node.added), self.radius)
            nearest = angles.argmin(axis=1)
            for c, child in enumerate(node.children):
                m = nearest == c
                if m.any():
                    ranges.extend((node.number, i, c, float(angles[m, i].min()), float(angles[m, i].max())) for i in range(len(node.points)))
                    walk(child, rows[m])

        walk(self.root, np.arange(len(x)))
        return out, ranges

    def measure(self, ranges: list[tuple]) -> None:
        """Take the ranges over all rows in place of those of the sample."""
        import numpy as np

        for node in self.nodes:
            shape = (len(node.points), len(node.points))
            node.low, node.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for k, i, c, low, high in ranges:
            self.nodes[k].low[i, c], self.nodes[k].high[i, c] = low, high

    def home(self, q):
        """The cell that a question falls in."""
        return self.place(q)[0]

    def reached(self, q, low, high):
        """``(question, cell)`` of all cells that hold a row between the scores, as far as the ranges tell."""
        import numpy as np

        size = np.sqrt((q**2).sum(1))
        inner, outer = _annulus(low, high, size, self.radius)
        pairs: list = []

        def walk(node: Node, asked) -> None:
            if node.children is None:
                pairs.append((asked, np.full(len(asked), node.number)))
                return
            to_points = _question_angles(q[asked], size[asked], node.points, self.radius)
            for c, child in enumerate(node.children):
                on = asked[_meets(node, c, to_points, inner[asked], outer[asked])]
                if len(on):
                    walk(child, on)

        walk(self.root, np.arange(len(q)))
        return tuple(np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2


class Index:
    """Rows of ``whole_vectors`` dealt out to the parts of cells, ready for questions."""

    def __init__(self, vectors: DataFrame, ids_kept: int, part: int = PART, sample: int = SAMPLE, most_cells: int = CELLS, leaf: int = LEAF):
        import numpy as np
        import pyarrow as pa

        self.spark, self.leaf = vectors.sparkSession, leaf
        self.rows = cut_lineage(_least_ids(vectors, ids_kept).withColumn("row", F.monotonically_increasing_id()))
        facts = self.rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))).alias("radius")).first()
        self.n, self.dim, self.radius = facts["n"], facts["dim"] or 0, facts["radius"] or 0.0
        drawn = self.rows.select("v", F.xxhash64("v", "vec_id").alias("h")).orderBy("h", "v").limit(sample).select("v").toArrow()
        cells = Cells(_padded(drawn["v"], self.dim), self.radius, min(most_cells, -(-self.n // part)))
        self.cells = cells
        dim = self.dim

        def place(batches):
            for b in batches:
                at, ranges = cells.place(_padded(b["v"], dim))
                yield pa.RecordBatch.from_arrays([b["row"], pa.array(at, pa.int64()), *(pa.nulls(b.num_rows, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()))], names)
                if ranges:
                    made = [pa.array(c, t) for c, t in zip(zip(*ranges), (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(ranges), pa.int64()), pa.nulls(len(ranges), pa.int64()), *made], names)

        names = ["row", "cell", "node", "point", "child", "low", "high"]
        placed = cut_lineage(self.rows.select("row", "v").mapInArrow(place, "row bigint, cell bigint, node int, point int, child int, low double, high double"))
        ranges = placed.where("node is not null").groupBy("node", "point", "child").agg(F.min("low"), F.max("high")).collect()  # FANOUT rows a cell at most
        cells.measure([tuple(r) for r in ranges])
        at = placed.where("row is not null").select("row", "cell")
        sizes = at.groupBy("cell").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))  # CELLS rows at most
        self.parts = cut_lineage(sizes)
        spread = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        self.dealt = cut_lineage(self.rows.join(at, "row").join(self.parts, "cell").select("cell", spread.alias("part"), "vec_id", "label", "v"))

    def ask(self, questions: DataFrame, k: int, same: bool) -> DataFrame:
        """``question, vec_id, score``: the first ``k`` rows of every question.

        ``questions``: ``question`` (unique), ``own`` (id that is no answer),
        ``label``, ``v`` and the least and greatest score, ``low`` and ``high``.
        """
        questions = cut_lineage(questions.select("question", "own", "label", "v", "low", "high"))
        at_home = cut_lineage(self._answers(self._sent(questions, None), k, same))
        bounds = self._first(at_home, k).groupBy("question").agg(F.count("*").alias("found"), F.min("score").cast("double").alias("least"))
        narrowed = questions.join(bounds, "question", "left").withColumn("low", F.when(F.col("found") >= k, F.greatest("low", "least")).otherwise(F.col("low"))).drop("found", "least")
        both = at_home.unionByName(self._answers(self._sent(cut_lineage(narrowed), True), k, same))
        return self._first(both, k)

    @staticmethod
    def _first(found: DataFrame, k: int) -> DataFrame:
        best = Window.partitionBy("question").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def _sent(self, questions: DataFrame, others: bool | None) -> DataFrame:
        """Questions with the parts they go to: those of the home cell, or of all other cells that the annulus reaches."""
        import pyarrow as pa

        cells, dim = self.cells, self.dim

        def route(batches):
            import numpy as np

            for b in batches:
                q = _padded(b["v"], dim)
                home = cells.home(q)
                if others is None:
                    who, cell = np.arange(len(q)), home
                else:
                    who, cell = cells.reached(q, *(b[c].to_numpy(zero_copy_only=False) for c in ("low", "high")))
                    who, cell = who[cell != home[who]], cell[cell != home[who]]
                for at in range(0, len(who), 8_192):
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(who[at : at + 8_192])) for c in b.columns), pa.array(cell[at : at + 8_192], pa.int64())], [*b.schema.names, "cell"])

        schema = ", ".join([*(f"{c} {t}" for c, t in questions.dtypes), "cell bigint"])
        sent = questions.mapInArrow(route, schema).join(self.parts, "cell")
        return sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def _answers(self, sent: DataFrame, k: int, same: bool) -> DataFrame:
        import pyarrow as pa

        dim, radius, leaf = self.dim, self.radius, self.leaf

        def answer(rows, asked):
            import numpy as np

            out = [], [], []
            if rows.num_rows and asked.num_rows:
                # A row without an id comes after all others.
                ids = rows["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
                own = asked["own"].to_numpy()
                codes = pa.concat_arrays([rows["label"].combine_chunks(), asked["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
                finder = Finder(ids, codes[: len(ids)], _padded(rows["v"], dim), radius, k, same, leaf)
                q, label = _padded(asked["v"], dim), codes[len(ids) :]
                low, high = (asked[c].to_numpy() for c in ("low", "high"))
                names = asked["question"].to_numpy()
                for at in range(0, len(own), BLOCK):
                    s = slice(at, at + BLOCK)
                    who, row, score = finder.find(q[s], own[s], label[s], low[s], high[s])
                    for column, values in zip(out, (names[s][who], row, score)):
                        column.append(values)
                flat = [np.concatenate(c) for c in out]
                return pa.table([pa.array(flat[0], pa.int64()), rows["vec_id"].take(pa.array(flat[1], pa.int64())), pa.array(flat[2].astype(np.int64), pa.int64())], names=["question", "vec_id", "score"])
            return pa.table([pa.array([], pa.int64())] * 3, names=["question", "vec_id", "score"])

        groups = self.dealt.groupBy("cell", "part").cogroup(sent.groupBy("cell", "part"))
        return groups.applyInArrow(answer, "question bigint, vec_id bigint, score bigint")


def mine(
    rows: DataFrame, is_anchor, relabel=None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", **size: int,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its first ``positives`` other rows of the same
    label by score, ties to the smaller id; for each, the first ``negatives``
    rows of other labels whose score is between ``low`` and ``high`` percent of
    the positive's. Every answer is exact.

    ``is_anchor(vec_id)`` chooses the anchors, ``relabel(vec_id, label)`` changes
    labels first. Rows with a null label or vector or a part that is null or not
    finite take no part; a row without an id is never an anchor and comes last
    among equal scores. Shorter vectors count as padded with zeros; zero and
    empty vectors score 0. Equal rows count once; rows that share an id are never
    each other's answers. Other columns play no part. Scores are exact while they
    and their sums stay below 2**53. An empty table gives no rows.
    """
    vectors = cut_lineage(whole_vectors(rows, vec_id, embedding, label, relabel))
    index = Index(vectors, max(positives, negatives) + 1, **size)
    wanted = vectors.where(is_anchor(F.col("vec_id"))).withColumn("question", F.monotonically_increasing_id())
    anchors = cut_lineage(wanted.withColumn("own", F.col("vec_id")))
    infinite = F.lit(float("inf"))
    found = index.ask(anchors.withColumn("low", -infinite).withColumn("high", infinite), positives, True)
    pairs = found.select(F.col("question").alias("anchor"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = cut_lineage(pairs.withColumn("question", F.monotonically_increasing_id()))
    # The scores s with low * p <= 100 * s <= high * p; none if p is negative.
    p = F.col("positive_score")
    windows = pairs.withColumn("low", F.ceil(p * low / F.lit(100).cast("decimal(3,0)")).cast("double")).withColumn("high", F.floor(p * high / F.lit(100).cast("decimal(3,0)")).cast("double"))
    asked = windows.where("low <= high").join(anchors.select(F.col("question").alias("anchor"), "own", "label", "v"), "anchor")
    hard = index.ask(asked, negatives, False).select("question", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = pairs.join(anchors.select(F.col("question").alias("anchor"), F.col("own").alias("anchor_id")), "anchor").join(hard, "question")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def turned(vec_id: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """Noisy labels: those of every seventh id move on by one."""
    return F.when(vec_id % every == 0, (label + 1) % labels).otherwise(label)


def hard_negatives(rows: DataFrame, every: int = 50) -> DataFrame:
    """Anchors are the rows whose id is divisible by ``every``; see ``mine``."""
    return mine(rows, lambda i: i % every == 0, turned)
