"""Subtotals, pivots and conditional aggregates (Q031-Q042)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    bucketed,
    count_where,
    counts_as_gmv,
    half_up,
    percent,
    ratio,
    sum_where,
    trunc_ts,
    ts_literal,
    units_between,
    week_monday,
)
from tidemark.operators.windows import gmv_by, top_n


def rollup_gmv(txns: DataFrame, day: str = "txn_date", unit: str = "bu_code") -> DataFrame:
    """Q031: day x unit, day and grand total with their grouping flags."""
    return _subtotals(txns.where(counts_as_gmv()), lambda df: df.rollup(day, unit), [day, unit])


def cube_gmv(txns: DataFrame, dims: Sequence[str] = ("region_key", "channel_code", "txn_type")) -> DataFrame:
    """Q032: every combination of the dimensions."""
    return _subtotals(txns.where(counts_as_gmv()), lambda df: df.cube(*dims), list(dims))


def _subtotals(df: DataFrame, grouped, dims: list[str]) -> DataFrame:
    # Grouped to the finest grain first: the expansion then multiplies groups, not rows.
    finest = df.groupBy(*dims).agg(F.sum("amount_usd").alias("g"))
    flags = [F.grouping(d).cast("int").alias(f"all_{d}") for d in dims]
    return grouped(finest).agg(F.sum("g").alias("gmv_usd"), *flags)


def grouping_sets_gmv(txns: DataFrame, unit: str = "bu_code", day: str = "txn_date") -> DataFrame:
    """Q033: unit x day, unit, day and the grand total."""
    finest = gmv_by(txns, unit, day, out="g")
    sets = [[F.col(unit), F.col(day)], [F.col(unit)], [F.col(day)], []]
    return finest.groupingSets(sets, unit, day).agg(F.sum("g").alias("gmv_usd"))


def case_sla(cases: DataFrame, as_of_ts: str) -> DataFrame:
    """Q034: total, closed and breached cases and attainment by priority."""
    finished = F.coalesce("resolved_at", ts_literal(as_of_ts))
    return cases.groupBy("priority").agg(
        F.count("*").alias("total_cases"),
        count_where(F.col("status") == "CLOSED").alias("closed_cases"),
        count_where(F.col("sla_due_at") < finished).alias("breached"),
        percent(count_where(F.col("sla_due_at") >= finished), F.count("*")).alias("attainment_pct"),
    )


def pivot_weekly(txns: DataFrame, regions: DataFrame, names: Sequence[str]) -> DataFrame:
    """Q035: weekly GMV with one column per named region and a total."""
    weekly = gmv_by(txns.withColumn("week_start", week_monday("txn_date")), "week_start", "region_key", out="g").join(regions, "region_key")
    picks = [sum_where("g", F.col("region_name") == n).alias(f"gmv_{n.lower().replace(' ', '_')}") for n in names]
    return weekly.groupBy("week_start").agg(*picks, F.sum("g").alias("total_gmv"))


LAYERS = ("raw", "staging", "core", "analytics")


def layer_of(reference: str = "table_reference") -> Column:
    """The storage layer named by a table reference."""
    expr = None
    for layer in LAYERS:
        hit = F.col(reference).like(f"%{layer}%")
        expr = F.when(hit, layer) if expr is None else expr.when(hit, layer)
    return expr.otherwise("other")


def unpivot_cost(cost: DataFrame) -> DataFrame:
    """Q036: daily cost per layer, first wide, then one row per layer."""
    tagged = cost.groupBy("job_date", layer_of().alias("layer")).agg(F.sum("cost_usd").alias("c"))
    wide = tagged.groupBy("job_date").agg(
        *[F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("c"))), F.lit(0)).alias(f"{name}_cost") for name in LAYERS]
    )
    return wide.unpivot("job_date", [f"{n}_cost" for n in LAYERS], "layer_name", "cost_usd")


def high_gmv_high_fail(txns: DataFrame, min_gmv: float, min_failed: int) -> DataFrame:
    """Q037: units with both high amounts and many failed transactions."""
    return (
        txns.groupBy("bu_code")
        .agg(F.sum("amount_usd").alias("gmv_usd"), count_where(F.col("status") == "FAILED").alias("failed_txns"))
        .where((F.col("gmv_usd") > min_gmv) & (F.col("failed_txns") > min_failed))
    )


def event_status_matrix(events: DataFrame) -> DataFrame:
    """Q038: event types by status with the success rate."""
    counts = {s.lower(): count_where(F.col("status") == s) for s in ("SUCCESS", "FAILURE", "TIMEOUT")}
    return events.groupBy("event_type").agg(
        *[c.alias(n) for n, c in counts.items()], percent(counts["success"], F.count("*")).alias("success_rate")
    )


def weighted_margin(txns: DataFrame, products: DataFrame) -> DataFrame:
    """Q039: amount-weighted margin per category.

    Sales are summed per product before the join, so a best-seller is one row there.
    """
    sales = gmv_by(txns, "product_key", out="s").join(products.where("is_current"), "product_key")
    profit = F.sum(F.col("s") * F.col("margin_pct"))
    return sales.groupBy("product_category").agg(
        F.sum("s").alias("sales"), half_up(profit, 2).alias("gross_profit"), ratio(profit, F.sum("s")).alias("weighted_margin")
    )


# Upper bounds in days of the age buckets.
AGE_BUCKETS = [(1, "0-1 days"), (3, "1-3 days"), (7, "3-7 days")]


def open_case_age(cases: DataFrame, as_of_ts: str, open_states: Sequence[str] = ("OPEN", "IN_PROGRESS"), buckets=AGE_BUCKETS) -> DataFrame:
    """Q040: open cases per age bucket with their part of all open cases."""
    age = units_between("DAY", "opened_at", ts_literal(as_of_ts))
    label = bucketed("opened_at", [(age < top, name) for top, name in buckets], "7+ days")
    counted = cases.where(F.col("status").isin(*open_states)).groupBy(label.alias("age_bucket")).agg(F.count("*").alias("open_cases"))
    return counted.withColumn("pct_of_open", percent("open_cases", F.sum("open_cases").over(Window.partitionBy())))


def not_engaged(regions: DataFrame, customers: DataFrame, txns: DataFrame, min_customers: int) -> DataFrame:
    """Q041: regions kept even without customers; customers with and without GMV.

    Buyers are made distinct before the join, so each customer stays one row and
    both distinct counts become plain counts.
    """
    buyers = txns.where(counts_as_gmv()).select(F.col("customer_key").alias("buyer_key")).distinct()
    current = customers.where("is_current").select("region_key", "customer_key").distinct()
    joined = current.join(buyers, F.col("customer_key") == F.col("buyer_key"), "left")
    per_region = joined.groupBy("region_key").agg(F.count("buyer_key").alias("active"), F.count("customer_key").alias("total_customers"))
    return (
        regions.join(per_region, "region_key", "left")
        .select("region_name", F.coalesce("active", F.lit(0)).alias("active"), F.coalesce("total_customers", F.lit(0)).alias("total_customers"))
        .where(F.col("total_customers") > min_customers)
        .withColumn("not_engaged_pct", percent(F.col("total_customers") - F.col("active"), "total_customers"))
    )


def top_products_array(txns: DataFrame, n: int = 5) -> DataFrame:
    """Q042: ordered array of each unit's best products. At most n elements per unit are collected."""
    best = top_n(gmv_by(txns, "bu_code", "product_key"), ["bu_code"], [F.col("gmv_usd").desc(), F.col("product_key")], n)
    items = F.sort_array(F.collect_list(F.struct("rn", "product_key", "gmv_usd")))
    return best.groupBy("bu_code").agg(items.alias("i")).select(
        "bu_code", F.transform("i", lambda x: F.struct(x["product_key"].alias("product_key"), x["gmv_usd"].alias("gmv_usd"))).alias("top_products")
    )


def hourly_slots(usage: DataFrame, scale: float = 1.0, digits: int = 2) -> DataFrame:
    """Q093, T4: peak and mean slots per hour."""
    mean = F.try_divide(F.sum("slot_count").cast("double"), F.count("slot_count").cast("double"))
    return usage.groupBy(trunc_ts("HOUR", "period_start").alias("hour_slot")).agg(
        half_up(F.max("slot_count") / scale, digits).alias("peak_slots"), half_up(mean / scale, digits).alias("avg_slots")
    )
