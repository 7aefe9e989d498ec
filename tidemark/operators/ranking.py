"""Exact order statistics without a single-task sort.

A global ``ntile`` / ``percent_rank`` / ``percentile`` needs the position of a
row in a total order. An unpartitioned window would move every row into one
task. Here the rows are range-partitioned on the full order (Spark samples the
cut points), the partition number is kept as a bucket, and the running count per
bucket gives each bucket its exact start position. Only the order inside a
bucket is then left, which is an ordinary partitioned window.

The bucketed rows are checkpointed once: every later step sees the same buckets,
also after an executor is lost, and the input is computed only once. Building
these frames therefore runs a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


MIN_RANGES = 32


def _in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with the number of their value range. More ranges than shuffle partitions keep each one small."""
    ranges = max(MIN_RANGES, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(df.repartitionByRange(ranges, *order).withColumn("_bucket", F.spark_partition_id()))


def global_positions(df: DataFrame, value: str, key: str, descending: bool = False) -> DataFrame:
    """Add ``position`` (1-based rank in the order value, key) and ``population``.

    ``key`` is unique, so a value shared by many rows is still cut into ranges.
    """
    first = F.col(value).desc() if descending else F.col(value).asc()
    placed = _in_ranges(df.where(F.col(value).isNotNull()), first, F.col(key).asc())
    # One row per range partition reaches this single-partition window.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("population", F.sum("_n").over(Window.partitionBy(F.lit(1))))
        .drop("_n")
    )
    inside = Window.partitionBy("_bucket").orderBy(first, F.col(key).asc())
    return placed.join(starts, "_bucket").withColumn("position", F.col("_start") + F.row_number().over(inside)).drop("_bucket", "_start")


def tile_of(position: str | Column, population: str | Column, tiles: int) -> Column:
    """The NTILE number of a position: the first ``population % tiles`` tiles hold one row more."""
    p = F.col(position) if isinstance(position, str) else position
    n = F.col(population) if isinstance(population, str) else population
    base = F.floor(n / tiles)
    extra = n % tiles
    head = extra * (base + 1)
    return F.when(p <= head, F.floor((p - 1) / (base + 1)) + 1).otherwise(
        extra + F.floor((p - 1 - head) / F.greatest(base, F.lit(1))) + 1
    ).cast("int")


def ntile_by_value(
    df: DataFrame, value: str, key: str, tiles: int, out: str, descending: bool = True
) -> DataFrame:
    placed = global_positions(df, value, key, descending)
    return placed.withColumn(out, tile_of("position", "population", tiles)).drop("position", "population")


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[tuple[str, float]], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated percentiles, one row per group (one row in all when ``by`` is empty).

    Works on the value histogram, so repeated values collapse before they are
    ordered, and a hot group is spread over several value ranges.
    """
    by = list(by)
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("pos")) for name, p in probs])
    points = _interpolated(hist, value, by, wanted)
    pick = [F.max(F.when(F.col("_name") == name, F.col("_val"))).alias(name) for name, _ in probs]
    return points.groupBy(*by).agg(*pick)


def bracketed_percentiles(df: DataFrame, value: str, probs: Sequence[tuple[str, float]], accuracy: int = 2000) -> DataFrame:
    """``exact_percentiles`` of a whole column, ordering only the rows around the wanted ranks.

    Mergeable quantile summaries give each percentile a bracket, a count tells how
    many rows lie below it and that the wanted ranks lie inside, and the ranks
    are taken from the bracket's rows, about 4 of ``accuracy``. Three scans of one
    column take the place of a shuffle of all its values. Values so repeated or
    so few that a bracket misses its rank go through ``exact_percentiles``.
    """
    rows = df.where(F.col(value).isNotNull()).select(value)
    margin = 2 / accuracy
    edges = [min(1.0, max(0.0, p + side)) for _, p in probs for side in (-margin, margin)]
    found = rows.agg(F.percentile_approx(value, edges, accuracy)).first()[0]  # two numbers for each percentile
    if found is None:
        return exact_percentiles(df, value, probs)
    brackets = [(F.lit(low), F.lit(high)) for low, high in zip(found[::2], found[1::2])]
    counts = [F.count_if(F.col(value) < low) for low, _ in brackets] + [F.count_if(F.col(value) <= high) for _, high in brackets]
    total, *ends = rows.agg(F.count("*"), *counts).first()
    below, upto = ends[: len(probs)], ends[len(probs) :]
    positions = [p * (total - 1) for _, p in probs]
    if any(b > int(pos) or -int(-pos // 1) >= u for b, u, pos in zip(below, upto, positions)):
        return exact_percentiles(df, value, probs)
    inside = F.array_compact(F.array(*[F.when(F.col(value).between(*edge), F.lit(name)) for edge, (name, _) in zip(brackets, probs)]))
    hist = rows.withColumn("_which", F.explode(inside)).groupBy("_which", value).agg(F.count("*").alias("_n"))
    places = [F.when(F.col("_which") == name, F.lit(float(pos - b))) for (name, _), pos, b in zip(probs, positions, below)]
    wanted = F.array(F.struct(F.col("_which").alias("name"), F.coalesce(*places).alias("pos")))
    points = _interpolated(hist, value, ["_which"], wanted)
    return points.agg(*[F.max(F.when(F.col("_name") == name, F.col("_val"))).alias(name) for name, _ in probs])


def _interpolated(hist: DataFrame, value: str, by: list[str], wanted: Column) -> DataFrame:
    """``_val`` at each ``pos`` of ``wanted``, structs of name and 0-based position in the group; ``hist`` counts values as ``_n``."""
    marked = _in_ranges(hist, *by, value)

    # At most one row per group and range partition from here on.
    scope = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    run = scope.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        marked.groupBy(*by, "_bucket")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_start", F.coalesce(F.sum("_bn").over(run), F.lit(0)))
        .withColumn("_total", F.sum("_bn").over(scope))
    )
    targets = (
        buckets.withColumn("_t", F.explode(wanted))
        .withColumn("_pos", F.col("_t.pos"))
        .withColumn("_at", F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))))
        .where((F.col("_at") >= F.col("_start")) & (F.col("_at") < F.col("_start") + F.col("_bn")))
        .select(*by, "_bucket", "_start", F.col("_t.name").alias("_name"), "_pos", "_at")
        .distinct()
    )
    seen = Window.partitionBy(*by, "_bucket", "_name", "_at").orderBy(value)
    hits = (
        marked.join(targets, [*by, "_bucket"])
        .withColumn("_upto", F.col("_start") + F.sum("_n").over(seen.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("_upto") > F.col("_at"))
        .groupBy(*by, "_name", "_pos", "_at")
        .agg(F.min(value).cast("double").alias("_val"))
    )
    frac = F.max("_pos") - F.floor(F.max("_pos"))
    low = F.min_by("_val", "_at")
    high = F.max_by("_val", "_at")
    return hits.groupBy(*by, "_name").agg((low + (high - low) * frac).alias("_val"))


def top_by_position(
    df: DataFrame, value: str, key: str, n: int, digits: int = 4
) -> DataFrame:
    """The n largest rows with their PERCENT_RANK and CUME_DIST over all rows.

    Only rows at or above the n-th value matter: every other row is below them,
    so two counts per distinct top value replace a sort of the whole table.
    """
    from tidemark.functions import ratio

    src = df.where(F.col(value).isNotNull())
    top = src.orderBy(F.col(value).desc(), F.col(key)).limit(n)
    hist = src.groupBy(value).agg(F.count("*").alias("_n"))
    totals = src.agg(F.count("*").alias("_total"))
    # n is a report size, so the distinct top values number at most n.
    tops = hist.orderBy(F.col(value).desc()).limit(n)
    upward = Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    placed = tops.withColumn("_ge", F.sum("_n").over(upward)).withColumn("_total", totals.scalar())
    ranks = placed.select(
        value,
        ratio(F.col("_total") - F.col("_ge"), F.col("_total") - 1, digits).alias("pct_rank"),
        ratio(F.col("_total") - F.col("_ge") + F.col("_n"), F.col("_total"), digits).alias("cum_dist"),
    )
    return top.join(ranks, value)
