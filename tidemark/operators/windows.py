"""Ranking, offset, running and distribution operators (Q001-Q018).

Row-level inputs are aggregated or limited per group before any window, so no
window partition grows with the row count of a hot key. Windows without a
partition run over daily series only, whose length is the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    count_where,
    counts_as_gmv,
    half_up,
    is_posted,
    ratio,
    share,
    units_between,
)
from tidemark.operators.ranking import bracketed_percentiles, ntile_by_value, top_by_position


def gmv_by(txns: DataFrame, *keys: str, out: str = "gmv_usd") -> DataFrame:
    """Certified GMV at the grain of ``keys``."""
    return txns.where(counts_as_gmv()).groupBy(*keys).agg(F.sum("amount_usd").alias(out))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """The first n rows of each group.

    Spark limits every map task to n rows per group ahead of the shuffle
    (WindowGroupLimit), so a hot group costs n rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def dedup_latest(df: DataFrame, keys: Sequence[str], newest: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Q001: one row per key, the one loaded last."""
    order = [F.col(newest).desc(), *[F.col(c).desc() for c in tie_breakers]]
    return top_n(df, keys, order, 1).drop("rn")


def first_event_per_key(df: DataFrame, key: str, when: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """Q002: earliest row per key as a map-side combined aggregate."""
    head = F.min(F.struct(when, tie, *[c for c in keep if c not in (when, tie)])).alias("h")
    return df.groupBy(key).agg(head).select(key, *[F.col(f"h.{c}").alias(c) for c in keep])


def rank_metric(df: DataFrame, part: str, metric: str) -> DataFrame:
    """Q003: RANK and DENSE_RANK of an aggregated metric within a partition."""
    w = Window.partitionBy(part).orderBy(F.col(metric).desc())
    return df.select("*", F.rank().over(w).alias("rank_standard"), F.dense_rank().over(w).alias("rank_dense"))


def period_delta(daily: DataFrame, day: str, metric: str, lag: int) -> DataFrame:
    """Q004, Q005: change against the value ``lag`` rows earlier in a daily series."""
    earlier = F.lag(metric, lag).over(Window.orderBy(day))
    return daily.withColumn("prior", earlier).select(
        day,
        metric,
        "prior",
        (F.col(metric) - F.col("prior")).alias("change"),
        ratio(F.col(metric) - F.col("prior"), "prior").alias("pct_change"),
    )


def run_interval(runs: DataFrame, name: str | None = None, newest: int | None = None) -> DataFrame:
    """Q006: gap to the next finish of the same job.

    For one job and the newest n runs only those n rows are needed: the next
    finish of each is among them. Without a limit the runs are chained by month
    so one busy job is spread over many tasks.
    """
    done = runs.where(F.col("run_finished_at").isNotNull())
    if name is not None:
        done = done.where(F.col("pipeline_name") == name)
    if newest is not None:
        if name is None:
            done = top_n(done, ["pipeline_name"], [F.col("run_finished_at").desc(), F.col("run_id").desc()], newest).drop("rn")
        else:
            done = done.orderBy(F.col("run_finished_at").desc(), F.col("run_id").desc()).limit(newest)
        w = Window.partitionBy("pipeline_name").orderBy("run_finished_at", "run_id")
        chained = done.withColumn("next_finished", F.lead("run_finished_at").over(w))
    else:
        chained = next_in_key(done, "pipeline_name", "run_finished_at", "run_id", "next_finished")
    return chained.select(
        "pipeline_name",
        "run_id",
        "run_finished_at",
        "next_finished",
        units_between("MINUTE", "run_finished_at", "next_finished").alias("gap_minutes"),
    )


def next_in_key(df: DataFrame, key: str, when: str, tie: str, out: str, chunk: str = "MONTH") -> DataFrame:
    """LEAD of ``when`` within ``key``, split by time chunk.

    A plain LEAD needs all rows of a key in one task. Here the window is
    (key, chunk); the first row of the next non-empty chunk is added to each
    chunk as a marker row. There is one marker per key and chunk.
    """
    rows = df.withColumn("_chunk", F.date_trunc(chunk, F.col(when)))
    heads = rows.groupBy(key, "_chunk").agg(F.min(when).alias(when))
    back = F.lag("_chunk").over(Window.partitionBy(key).orderBy("_chunk"))
    markers = (
        heads.withColumn("_chunk", back)
        .where(F.col("_chunk").isNotNull())
        .withColumn("_marker", F.lit(1))
    )
    both = rows.withColumn("_marker", F.lit(0)).unionByName(markers, allowMissingColumns=True)
    w = Window.partitionBy(key, "_chunk").orderBy("_marker", when, tie)
    return both.withColumn(out, F.lead(when).over(w)).where("_marker = 0").drop("_marker", "_chunk")


def decile_by_value(txns: DataFrame, tiles: int = 10) -> DataFrame:
    """Q007: customers by lifetime value, highest value in tile 1, ties by key."""
    ltv = gmv_by(txns, "customer_key", out="lifetime_value")
    return ntile_by_value(ltv, "lifetime_value", "customer_key", tiles, "ltv_decile")


def session_first_last(events: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Q008: first and last event type and event count of each session."""
    src = events if types is None else events.where(F.col("event_type").isin(*types))
    at = F.struct("event_timestamp", "event_id")
    return src.groupBy("session_id").agg(
        F.min_by("event_type", at).alias("first_event"),
        F.max_by("event_type", at).alias("last_event"),
        F.count("*").alias("events_in_session"),
    )


def running_total(daily: DataFrame, day: str, metric: str, out: str, reset_by: Column | None = None) -> DataFrame:
    """Q009: cumulative metric over a daily series, optionally restarting per period."""
    w = Window.orderBy(day) if reset_by is None else Window.partitionBy(reset_by).orderBy(day)
    return daily.withColumn(out, F.sum(metric).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def window_mean(metric: str, w, digits: int = 2) -> Column:
    value = F.col(metric)
    return half_up(F.try_divide(F.sum(value).over(w).cast("double"), F.count(value).over(w).cast("double")), digits)


def moving_average(daily: DataFrame, day: str, metric: str, rows: int, out: str, by: str | None = None) -> DataFrame:
    """Q010: mean over the current and the preceding ``rows - 1`` rows."""
    w = Window.orderBy(day) if by is None else Window.partitionBy(by).orderBy(day)
    return daily.withColumn(out, window_mean(metric, w.rowsBetween(1 - rows, 0)))


def share_of_total(df: DataFrame, part: str, metric: str, out: str, digits: int = 4) -> DataFrame:
    """Q011, Q021: each row's part of its partition total."""
    return df.withColumn(out, share(metric, Window.partitionBy(part), digits))


def rank_and_trend(df: DataFrame, day: str, key: str, metric: str, rows: int = 7) -> DataFrame:
    """Q012: rank within the day beside the key's own moving average."""
    within_day = Window.partitionBy(day).orderBy(F.col(metric).desc())
    ranked = df.withColumn("rank_today", F.rank().over(within_day))
    return moving_average(ranked, day, metric, rows, "trailing_avg", by=key)


def top_products_per_day(txns: DataFrame, n: int = 3) -> DataFrame:
    """Q013: best products of each day and business unit."""
    sales = gmv_by(txns, "txn_date", "bu_code", "product_key")
    return top_n(sales, ["txn_date", "bu_code"], [F.col("gmv_usd").desc(), F.col("product_key")], n).drop("rn")


def nth_value_per_day(txns: DataFrame, n: int = 2) -> DataFrame:
    """Q014: the n-th highest amount of each day, NULL on days with fewer rows."""
    order = [F.col("amount_usd").desc(), F.col("txn_id"), F.col("txn_no")]
    best = top_n(txns.where(counts_as_gmv()), ["txn_date"], order, n)
    at_n = F.col("rn") == n
    return best.groupBy("txn_date").agg(
        F.max(F.when(at_n, F.col("txn_id"))).alias("nth_txn"),
        F.max(F.when(at_n, F.col("amount_usd"))).alias("nth_amount"),
    )


def percent_position(txns: DataFrame, n: int = 20) -> DataFrame:
    """Q015: percent rank and cumulative share of the n largest posted amounts."""
    posted = txns.where(is_posted()).select("txn_id", "txn_no", "amount_usd")
    return top_by_position(posted, "amount_usd", "txn_no", n)


def event_funnel(events: DataFrame, enter: str, buy: str, fail: str) -> DataFrame:
    """Q016: daily counts of the funnel steps and the entry-to-order ratio."""
    kind = F.col("event_type")
    return (
        events.groupBy("event_date")
        .agg(
            count_where(kind == enter).alias("entries"),
            count_where(kind == buy).alias("orders"),
            count_where(kind == fail).alias("failures"),
        )
        .withColumn("conversion", ratio("orders", "entries"))
    )


def reopened_cases(cases: DataFrame, low: int = 1, high: int = 7) -> DataFrame:
    """Q017: cases followed by another of the same customer within low..high days of closing."""
    chained = next_in_key(cases, "customer_key", "opened_at", "case_number", "next_opened")
    return chained.select(
        "case_number",
        "customer_key",
        "resolved_at",
        "next_opened",
        units_between("DAY", "resolved_at", "next_opened").alias("days_to_next"),
    ).where(F.col("days_to_next").between(low, high))


def iqr_outliers(txns: DataFrame, factor: float = 1.5) -> DataFrame:
    """Q018: posted amounts above Q3 + factor * IQR, with exact quartiles."""
    posted = txns.where(is_posted()).select("txn_id", "txn_no", "amount_usd")
    quartiles = bracketed_percentiles(posted, "amount_usd", [("q1", 0.25), ("q3", 0.75)])
    fence = quartiles.select(half_up(F.col("q3") + factor * (F.col("q3") - F.col("q1")), 4).alias("fence"))
    return (
        posted.withColumn("upper_fence", fence.scalar())
        .where(F.col("amount_usd") > F.col("upper_fence"))
        .select("txn_id", "txn_no", "amount_usd", half_up("upper_fence", 2).alias("upper_fence"))
    )




def trailing_mean(
    df: DataFrame, key: str, order: Sequence[str], value: str, rows: int, out: str, chunk: str = "MONTH"
) -> DataFrame:
    """Mean of ``value`` over the ``rows`` preceding rows of the same key, the current row left out.

    Row positions and running sums are built per (key, time chunk) on top of the
    chunk totals, and the trailing sum is the difference of two running sums, so
    a key with very many rows is never ordered in one task. ``order[0]`` is a date.
    """
    rows_in = df.withColumn("_chunk", F.date_trunc(chunk, F.col(order[0])))
    chunks = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows_in.groupBy(key, "_chunk")
        .agg(F.count("*").alias("_n"), F.count(value).alias("_c"), F.sum(value).alias("_s"))
        .select(key, "_chunk", *[F.coalesce(F.sum(c).over(chunks), F.lit(0)).alias(f"{c}0") for c in ("_n", "_c", "_s")])
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows_in.join(starts, [key, "_chunk"])
        .withColumn("_pos", F.col("_n0") + F.row_number().over(inside))
        .withColumn("_cnt", F.col("_c0") + F.count(value).over(before))
        .withColumn("_sum", F.col("_s0") + F.coalesce(F.sum(value).over(before), F.lit(0)))
        .drop("_chunk", "_n0", "_c0", "_s0")
    )
    edge = placed.select(key, (F.col("_pos") + rows).alias("_pos"), F.col("_cnt").alias("_cnt_e"), F.col("_sum").alias("_sum_e"))
    span_sum = (F.col("_sum") - F.coalesce("_sum_e", F.lit(0))).cast("double")
    span_cnt = F.col("_cnt") - F.coalesce("_cnt_e", F.lit(0))
    return (
        placed.join(edge, [key, "_pos"], "left")
        .withColumn(out, F.try_divide(span_sum, span_cnt.cast("double")))
        .drop("_pos", "_cnt", "_sum", "_cnt_e", "_sum_e")
    )
