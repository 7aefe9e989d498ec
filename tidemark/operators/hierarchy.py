"""Recursive walks as level-by-level joins (Q024-Q026, lineage closure).

Each level is one distributed join. Levels are checkpointed to the shared
folder, which cuts the growing plan and survives the loss of an executor. Counts
and quantities are combined per node at every level, so the walk never holds one
row per ancestor pair or per path.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_counted, cut_lineage

def levels(start: DataFrame, step: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """The start rows and every following level until one is empty. The caller has ruled out cycles."""
    current, rows = cut_counted(start)
    found = []
    while rows:
        found.append(current)
        current, rows = cut_counted(step(current))
    return found or [current]


def require_no_loop(links: DataFrame) -> None:
    """Raises if following ``links(node, above)`` from some node never ends; each node has one row at most.

    Links are doubled, so each round looks twice as far up and a chain of n
    nodes takes log2(n) rounds. A way longer than the number of nodes repeats one.
    """
    far, nodes = cut_counted(links.where("above IS NOT NULL"))
    left, reach = nodes, 1
    while reach <= nodes and left:
        up = far.select(F.col("node").alias("above"), F.col("above").alias("_next"))
        far, left = cut_counted(far.join(up, "above").select("node", F.col("_next").alias("above")))
        reach *= 2
    if left:
        raise ValueError("the hierarchy has a cycle")


def peeled(links: DataFrame) -> DataFrame:
    """``(node, depth)`` of every node of ``links(node, next)``; depth is the longest way from a node without predecessors.

    Nodes that no remaining link points to are taken away, round by round. If a
    round takes none, what is left holds a cycle, which raises.
    """
    left, n = cut_counted(links.distinct())
    depth, found = 0, [left.select("node", F.lit(0).alias("depth"))]
    while n:
        # A link stays until the round of its start, so its end lies at least one deeper.
        ends = left.select(F.col("next").alias("node"))
        found.append(ends.withColumn("depth", F.lit(depth + 1)))
        left, remaining = cut_counted(left.join(ends.distinct(), "node", "left_semi"))
        if remaining == n:
            raise ValueError("the hierarchy has a cycle")
        n, depth = remaining, depth + 1
    return stacked(found).groupBy("node").agg(F.max("depth").alias("depth"))


def require_no_cycle(links: DataFrame) -> None:
    """Raises if ``links(node, next)`` hold a cycle; a node may have several links.

    A link of a cycle starts where one ends and ends where one starts. All others
    are taken away round by round from both ends, so a tree loses most of its
    links, the lowest, in the first rounds.
    """
    left, n = cut_counted(links.distinct())
    while n:
        starts, ends = left.select(F.col("node").alias("next")), left.select(F.col("next").alias("node"))
        inner = left.join(ends.distinct(), "node", "left_semi").join(starts.distinct(), "next", "left_semi")
        left, remaining = cut_counted(inner)
        if remaining == n:
            raise ValueError("the hierarchy has a cycle")
        n = remaining


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def manager_chain(employees: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Q024: the way up from each start employee (all when none is given).

    One row per step: depth 0 is the employee, the chain text grows upwards. A
    cycle among all employees raises.
    """
    people = employees.select("employee_key", "full_name", "manager_employee_key")
    require_no_loop(people.select(F.col("employee_key").alias("node"), F.col("manager_employee_key").alias("above")))
    first = people if start is None else people.join(start, "employee_key", "left_semi")
    seed = first.select(
        F.col("employee_key").alias("start_key"),
        F.lit(0).alias("depth"),
        "full_name",
        F.col("full_name").alias("chain"),
        F.col("manager_employee_key").alias("next_key"),
    )
    above = people.select(
        F.col("employee_key").alias("next_key"),
        F.col("full_name").alias("boss"),
        F.col("manager_employee_key").alias("after"),
    )

    def up(level: DataFrame) -> DataFrame:
        return level.join(above, "next_key").select(
            "start_key",
            (F.col("depth") + 1).alias("depth"),
            F.col("boss").alias("full_name"),
            F.concat_ws(" > ", "chain", "boss").alias("chain"),
            F.col("after").alias("next_key"),
        )

    return stacked(levels(seed, up)).drop("next_key")


def report_counts(employees: DataFrame, active_only: bool = True, top: int | None = None) -> DataFrame:
    """Q025: everyone below each manager, direct reports included.

    With ``active_only`` a branch counts when its topmost member is active. A
    level holds the number of descendants at that distance, one row per manager.
    """
    live = F.col("employment_status") == "ACTIVE" if active_only else F.lit(True)
    edges = employees.where(F.col("manager_employee_key").isNotNull()).select(
        F.col("employee_key").alias("child"), F.col("manager_employee_key").alias("manager"), live.alias("live")
    )

    require_no_loop(edges.select(F.col("child").alias("node"), F.col("manager").alias("above")))

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("manager").agg(
            F.sum("n").alias("below"), F.sum(F.when(F.col("live"), F.col("n")).otherwise(0)).alias("counted")
        )

    def down(level: DataFrame) -> DataFrame:
        deeper = level.select(F.col("manager").alias("child"), F.col("below").alias("n"))
        return fold(edges.join(deeper, "child"))

    all_levels = stacked(levels(fold(edges.withColumn("n", F.lit(1).cast("long"))), down))
    totals = (
        all_levels.groupBy(F.col("manager").alias("manager_key"))
        .agg(F.sum("counted").alias("total_reports"))
        .where("total_reports > 0")
    )
    return totals if top is None else totals.orderBy(F.col("total_reports").desc(), "manager_key").limit(top)


def bom_explosion(bom: DataFrame, root: int) -> DataFrame:
    """Q026: quantity of every component below ``root``, multiplied along each path. A cycle in the bill raises."""
    edges = bom.select(
        F.col("parent_product_key").alias("parent"),
        F.col("component_product_key").alias("part"),
        F.col("quantity_per_unit").cast("decimal(28,0)").alias("per_unit"),
    )
    require_no_cycle(edges.select(F.col("parent").alias("node"), F.col("part").alias("next")))
    # Every level joins with the same edges: they are made, shuffled and sorted once.
    edges = cut_lineage(edges.repartition("parent").sortWithinPartitions("parent"))
    first = edges.where(F.col("parent") == root).groupBy("part").agg(F.sum("per_unit").alias("qty"))

    def down(level: DataFrame) -> DataFrame:
        step = level.select(F.col("part").alias("parent"), "qty").join(edges, "parent")
        return step.groupBy("part").agg(F.sum((F.col("qty") * F.col("per_unit")).cast("decimal(28,0)")).cast("decimal(28,0)").alias("qty"))

    total = stacked(levels(first.withColumn("qty", F.col("qty").cast("decimal(28,0)")), down))
    return total.groupBy(F.col("part").alias("component_product_key")).agg(F.sum("qty").alias("total_qty"))


def downstream(edges: DataFrame, start_table: str, start_column: str) -> DataFrame:
    """All columns fed by one column, with the length of the longest way to each (0 for direct).

    Only links below the start are peeled. A cycle there has no longest way and
    raises; ``reachable`` copes with cycles.
    """
    links, _, start = _links(edges, start_table, start_column)
    below = _as_source(reachable(edges, start_table, start_column))
    source, target = F.struct("source_table", "source_column"), F.struct(F.col("target_table").alias("source_table"), F.col("target_column").alias("source_column"))
    inside = links.where(start).unionByName(links.join(below, ["source_table", "source_column"], "left_semi")).distinct()
    depths = peeled(inside.select(source.alias("node"), target.alias("next"))).where("depth > 0")
    return depths.select(F.col("node.source_table").alias("target_table"), F.col("node.source_column").alias("target_column"), (F.col("depth") - 1).alias("depth"))


def reachable(edges: DataFrame, start_table: str, start_column: str) -> DataFrame:
    """All columns fed by one column with their shortest distance. Columns already
    reached leave the frontier, so cycles end by themselves.
    """
    links, heads, start = _links(edges, start_table, start_column)
    key = ["target_table", "target_column"]
    frontier, rows = cut_counted(heads(links.where(start)).withColumn("depth", F.lit(0)))
    seen, depth = frontier, 0
    while rows:
        depth += 1
        reached = heads(links.join(_as_source(frontier), ["source_table", "source_column"], "left_semi"))
        frontier, rows = cut_counted(reached.join(seen, key, "left_anti").withColumn("depth", F.lit(depth)))
        seen = seen.unionByName(frontier)
    return seen


def _links(edges: DataFrame, start_table: str, start_column: str):
    links = edges.select("source_table", "source_column", "target_table", "target_column").distinct()
    start = (F.col("source_table") == start_table) & (F.col("source_column") == start_column)
    return links, lambda df: df.select("target_table", "target_column").distinct(), start


def _as_source(level: DataFrame) -> DataFrame:
    return level.select(F.col("target_table").alias("source_table"), F.col("target_column").alias("source_column"))
