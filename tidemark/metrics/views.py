"""Certified metric views (V1-V4) and the pre-aggregates refreshed by day (M1-M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    bucketed,
    count_where,
    counts_as_gmv,
    day_literal,
    half_up,
    mean_of,
    percent,
    ratio,
    sum_where,
    trunc_ts,
    units_between,
)
from tidemark.operators.ranking import ntile_by_value
from tidemark.session import cut_lineage


def executive_daily(txns: DataFrame, units: DataFrame, regions: DataFrame, products: DataFrame) -> DataFrame:
    """V1: KPIs by day, business unit and region.

    Rows are combined per (day, unit, region, customer), so the distinct customers
    are a plain count, and per (day, unit, region, product), so margins meet sums
    and no single transaction meets the product dimension. Both become cells,
    which are few, before they are joined.
    """
    cell = ["txn_date", "bu_code", "region_key"]
    good = counts_as_gmv()
    margins = products.where("is_current").select("product_key", "margin_pct")
    counted = (
        txns.groupBy(*cell, "customer_key")
        .agg(
            count_where(good).alias("n"),
            sum_where("amount_usd", good).alias("gmv"),
            sum_where(F.abs("amount_usd"), F.col("txn_type") == "REFUND").alias("refunds"),
            F.sum("amount_usd").alias("total"),
        )
        .groupBy(*cell)
        .agg(
            F.sum("n").alias("txn_count"),
            count_where(F.col("n") > 0).alias("active_customers"),
            F.sum("gmv").alias("gmv_usd"),
            F.sum("refunds").alias("refunds_usd"),
            ratio(F.sum("gmv"), F.sum("n"), 2).alias("avg_order_value_usd"),
            F.sum("total").alias("_total"),
        )
    )
    per_product = txns.groupBy(*cell, "product_key").agg(F.sum("amount_usd").alias("total")).join(margins, "product_key")
    weighted = per_product.groupBy(*cell).agg(F.sum(F.col("total") * F.col("margin_pct")).alias("_weighted"))
    kpis = counted.join(weighted, cell, "left").withColumn("blended_margin_rate", ratio("_weighted", "_total", 4))
    return (
        kpis.join(units, "bu_code")
        .join(regions.select("region_key", "region_name"), "region_key")
        .select(
            F.col("txn_date").alias("metric_date"), "bu_code", "bu_name", "region_key", "region_name", "txn_count",
            "active_customers", "gmv_usd", "refunds_usd", "avg_order_value_usd", "blended_margin_rate",
        )
    )


def day_measures(health: DataFrame, runs: DataFrame, cost: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Quality score, longest run in hours and cost, one row per day each."""
    scores = health.groupBy(F.col("score_date").alias("metric_date")).agg(mean_of("dq_score", 4).alias("dq_score"))
    hours = runs.groupBy(F.col("run_date").alias("metric_date")).agg(
        F.max(units_between("HOUR", "run_started_at", "run_finished_at")).alias("freshness_hours")
    )
    spend = cost.groupBy(F.col("job_date").alias("metric_date")).agg(half_up(F.sum("cost_usd"), 2).alias("cost_usd"))
    return scores, hours, spend


def with_day_measures(daily: DataFrame, health: DataFrame, runs: DataFrame, cost: DataFrame) -> DataFrame:
    for measure in day_measures(health, runs, cost):
        daily = daily.join(measure, "metric_date", "left")
    return daily


def executive_overview(daily: DataFrame, health: DataFrame, runs: DataFrame, cost: DataFrame) -> DataFrame:
    """V2: V1 with quality, run hours and cost of the day."""
    kept = daily.select(
        "metric_date", "bu_name", "region_name", "txn_count", "active_customers", "gmv_usd", "avg_order_value_usd", "blended_margin_rate"
    )
    return with_day_measures(kept, health, runs, cost)


# Upper bounds in days since the last purchase.
ENGAGEMENT = [(30, "ACTIVE"), (90, "AT_RISK"), (180, "DORMANT")]


def customer_360(customers: DataFrame, txns: DataFrame, cases: DataFrame, as_of: str) -> DataFrame:
    """V3: value, recency, quartiles, open cases and engagement of each current customer with purchases."""
    activity = txns.where(counts_as_gmv()).groupBy("customer_key").agg(
        F.count("*").alias("total_txns"),
        F.sum("amount_usd").alias("lifetime_value_usd"),
        F.max("txn_date").alias("last_txn_date"),
        F.datediff(day_literal(as_of), F.max("txn_date")).alias("days_since_last_txn"),
        F.count_distinct("account_key").alias("account_count"),
    )
    waiting = cases.where(F.col("status").isin("OPEN", "IN_PROGRESS")).groupBy("customer_key").agg(F.count("*").alias("open_cases"))
    members = customers.where("is_current").select("customer_key", "customer_id", "full_name", "customer_segment", "tier", "is_active")
    # Keys and measures alone are placed in order; names join after.
    base = cut_lineage(members.select("customer_key").join(activity, "customer_key"))
    valued = ntile_by_value(base.select("customer_key", "lifetime_value_usd"), "lifetime_value_usd", "customer_key", 4, "value_quartile").drop("lifetime_value_usd")
    recent = ntile_by_value(
        base.select("customer_key", "days_since_last_txn"), "days_since_last_txn", "customer_key", 4, "recency_quartile", descending=False
    ).drop("days_since_last_txn")
    days = F.col("days_since_last_txn")
    return (
        members.join(base, "customer_key")
        .join(valued, "customer_key")
        .join(recent, "customer_key")
        .join(waiting, "customer_key", "left")
        .withColumn("open_cases", F.coalesce("open_cases", F.lit(0)))
        .withColumn("engagement_status", bucketed("days_since_last_txn", [(days <= top, name) for top, name in ENGAGEMENT], "LAPSED"))
    )


def platform_health(runs: DataFrame) -> DataFrame:
    """V4: daily run success, failures, scores and unfinished runs."""
    n = F.count("*")
    return runs.groupBy("run_date").agg(
        percent(count_where(F.col("status") == "SUCCESS"), n).alias("run_success_rate"),
        count_where(F.col("status") == "FAILED").alias("run_failures"),
        mean_of(F.coalesce("dq_score", F.lit(100).cast("decimal(5,2)")), 2).alias("avg_dq_score"),
        percent(count_where(F.col("dq_passed")), n).alias("dq_pass_rate"),
        count_where(F.col("run_finished_at").isNull()).alias("still_running"),
    )


def daily_gmv_by_bu(txns: DataFrame) -> DataFrame:
    """M1: transactions, customers and GMV by day and unit."""
    return txns.where(counts_as_gmv()).groupBy(F.col("txn_date").alias("metric_date"), "bu_code").agg(
        F.count("*").alias("txn_count"), F.count_distinct("customer_key").alias("active_customers"), F.sum("amount_usd").alias("gmv_usd")
    )


def hourly_ops_events(events: DataFrame, hour: Column | None = None) -> DataFrame:
    """M2: events, mean latency and failures by hour, system and type."""
    hour = trunc_ts("HOUR", "event_timestamp") if hour is None else hour
    return events.groupBy("event_date", hour.alias("event_hour"), "source_system", "event_type").agg(
        F.count("*").alias("event_count"), mean_of("latency_ms", 0).alias("avg_latency_ms"), count_where(F.col("status") == "FAILURE").alias("failures")
    )


def daily_cost_by_user(cost: DataFrame) -> DataFrame:
    """M3: queries, terabytes and cost by day, user and dataset."""
    return cost.groupBy("job_date", "user_email", "dataset_id").agg(
        F.count("*").alias("query_count"),
        half_up(F.sum("bytes_processed") / 1e12, 3).alias("terabytes_processed"),
        half_up(F.sum("cost_usd"), 2).alias("cost_usd"),
    )


def dq_trend_daily(health: DataFrame) -> DataFrame:
    """M4: mean score and failed checks by product and day."""
    return health.groupBy("score_date", "data_product_name").agg(mean_of("dq_score", 4).alias("dq_score"), F.sum("checks_failed").alias("checks_failed"))


BITMAP_CELL = ["metric_date", "bu_code", "bucket"]
#: Days of the rolling customer counts.
ROLLING_DAYS = (7, 30, 90)


def customer_bitmaps(txns: DataFrame) -> DataFrame:
    """M1's customers as exact state that adds up: a bitmap of the keys by day, unit and range of keys."""
    kept = txns.where(counts_as_gmv() & F.col("customer_key").isNotNull())
    cell = [F.col("txn_date").alias("metric_date"), "bu_code", F.bitmap_bucket_number("customer_key").alias("bucket")]
    return kept.groupBy(*cell).agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("customers"))


def add_bitmaps(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Stored bitmaps with those of newly loaded rows; nothing is counted anew."""
    return stored.select(*BITMAP_CELL, "customers").unionByName(more).groupBy(*BITMAP_CELL).agg(F.bitmap_or_agg("customers").alias("customers"))


def _rolled(stored: DataFrame, as_of: str, days: tuple[int, ...]) -> DataFrame:
    """Rows of each trailing window up to ``as_of``, with ``window_days``; only the days of the longest are read."""
    last = day_literal(as_of)
    near = stored.where((F.col("metric_date") > F.date_sub(last, max(days))) & (F.col("metric_date") <= last))
    spread = near.withColumn("window_days", F.explode(F.array(*[F.lit(d) for d in days])))
    return spread.where(F.col("metric_date") > F.date_sub(last, F.col("window_days")))


def rolling_customers(stored: DataFrame, as_of: str, days: tuple[int, ...] = ROLLING_DAYS) -> DataFrame:
    """Distinct customers of the trailing windows by unit, exactly, from the stored bitmaps alone."""
    united = _rolled(stored, as_of, days).groupBy("bu_code", "window_days", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    return united.groupBy("bu_code", "window_days").agg(F.sum("n").alias("active_customers"))


def customer_sketches(txns: DataFrame, lg_config: int = 14) -> DataFrame:
    """The same state as sketches of fixed size, for counts that may be off by about 1 %; exact bitmaps are the default."""
    return txns.where(counts_as_gmv()).groupBy(F.col("txn_date").alias("metric_date"), "bu_code").agg(F.hll_sketch_agg("customer_key", lg_config).alias("customers"))


def rolling_customers_about(stored: DataFrame, as_of: str, days: tuple[int, ...] = ROLLING_DAYS) -> DataFrame:
    """``rolling_customers`` from sketches."""
    united = _rolled(stored, as_of, days).groupBy("bu_code", "window_days").agg(F.hll_union_agg("customers").alias("customers"))
    return united.select("bu_code", "window_days", F.hll_sketch_estimate("customers").alias("active_customers"))
