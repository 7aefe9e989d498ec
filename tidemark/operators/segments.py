"""Segmentation, existence tests and combined sources (Q019-Q023, Q027-Q030)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import bucketed, counts_as_gmv, day_literal, mean_of, ratio, ts_literal, units_between
from tidemark.operators.windows import gmv_by, top_n

# Lower bounds of the value segments and of the lifetime-value buckets.
VALUE_SEGMENTS = [(50000, "A"), (10000, "B"), (1000, "C")]
LTV_BUCKETS = [(100000, "1. VVVIP"), (25000, "2. VIP"), (5000, "3. Core")]


def rfm(txns: DataFrame, as_of: str, segments=VALUE_SEGMENTS) -> DataFrame:
    """Recency, frequency and monetary value of each customer with its value segment."""
    per_customer = txns.where(counts_as_gmv()).groupBy("customer_key").agg(
        F.count("*").alias("frequency"),
        F.sum("amount_usd").alias("monetary"),
        F.datediff(day_literal(as_of), F.max("txn_date")).alias("recency_days"),
    )
    steps = [(F.col("monetary") > low, label) for low, label in segments]
    return per_customer.withColumn("value_segment", bucketed("monetary", steps, "D"))


def rfm_segments(txns: DataFrame, as_of: str) -> DataFrame:
    """Q019: customers, mean value and mean recency per value segment."""
    return rfm(txns, as_of).groupBy("value_segment").agg(
        F.count("*").alias("customers"),
        mean_of("monetary", 2).alias("avg_ltv"),
        mean_of("recency_days", 1).alias("avg_recency_days"),
    )


def last_success(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "SUCCESS").groupBy("target_table").agg(F.max("run_finished_at").alias("last_ok"))


def sla_status(catalog: DataFrame, runs: DataFrame, as_of_ts: str) -> DataFrame:
    """Q020: hours since the last good load of each certified table against its limit."""
    hours = units_between("HOUR", "last_ok", ts_literal(as_of_ts))
    certified = catalog.where("is_certified")
    return certified.join(last_success(runs), certified.table_id == F.col("target_table"), "left").select(
        "table_name",
        "data_owner",
        "criticality",
        "sla_hours",
        hours.alias("hours_since_load"),
        F.when(hours > F.col("sla_hours"), "BREACHED").otherwise("OK").alias("sla_status"),
    )


def share_vs_enterprise(txns: DataFrame, part: str = "bu_code") -> DataFrame:
    """Q021: GMV of each part beside the same-day total, from one aggregation."""
    day = Window.partitionBy("txn_date")
    return gmv_by(txns, "txn_date", part, out="bu_gmv").withColumn("enterprise_gmv", F.sum("bu_gmv").over(day)).withColumn(
        "share_pct", ratio("bu_gmv", "enterprise_gmv")
    )


def customers_with_case(customers: DataFrame, cases: DataFrame, priority: str, as_of_ts: str, days: int) -> DataFrame:
    """Q022: active current customers with a case of this priority in the last ``days`` days."""
    since = ts_literal(as_of_ts) - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = cases.where((F.col("priority") == priority) & (F.col("opened_at") >= since))
    return customers.where("is_current AND is_active").join(recent, "customer_key", "left_semi")


def unsold_products(products: DataFrame, txns: DataFrame, as_of: str) -> DataFrame:
    """Q023: active products without a transaction since the first of the month."""
    month = F.trunc(day_literal(as_of), "MM")
    sold = txns.where(F.col("txn_date") >= month)
    return products.where(F.col("is_current") & (F.col("status") == "ACTIVE")).join(sold, "product_key", "left_anti")


def ltv_buckets(txns: DataFrame, buckets=LTV_BUCKETS) -> DataFrame:
    """Q027: customers and total value per lifetime-value bucket."""
    ltv = gmv_by(txns, "customer_key", out="ltv")
    steps = [(F.col("ltv") >= low, label) for low, label in buckets]
    return ltv.groupBy(bucketed("ltv", steps, "4. Low").alias("customer_bucket")).agg(
        F.count("*").alias("customers"), F.sum("ltv").alias("total_value")
    )


def gmv_per_customer(txns: DataFrame, business_units: DataFrame) -> DataFrame:
    """Q028: active customers, GMV and GMV per customer of each business unit.

    Aggregated to (unit, customer) first, so the distinct count is a plain count
    of combined rows and a hot unit is spread over its customers.
    """
    per_customer = gmv_by(txns, "bu_code", "customer_key", out="g")
    per_unit = per_customer.groupBy("bu_code").agg(F.count("customer_key").alias("active_customers"), F.sum("g").alias("gmv_usd"))
    return per_unit.join(business_units, "bu_code").select(
        "bu_name", "active_customers", "gmv_usd", ratio("gmv_usd", "active_customers", 2).alias("gmv_per_customer")
    )


def all_recent_escalated(customers: DataFrame, cases: DataFrame, as_of_ts: str, days: int = 180) -> DataFrame:
    """Q029: active customers with cases and none unescalated in the last ``days`` days."""
    since = ts_literal(as_of_ts) - F.expr(f"INTERVAL {int(days)} DAYS")
    calm = cases.where(~F.col("is_escalated") & (F.col("opened_at") >= since))
    return (
        customers.where("is_active")
        .join(cases.select("customer_key"), "customer_key", "left_semi")
        .join(calm, "customer_key", "left_anti")
    )


def unified_ledger(day: Column | None = None, **sources: DataFrame) -> DataFrame:
    """Q030: rows of several systems under one schema, tagged with their source."""
    out = None
    for tag, df in sources.items():
        part = (df if day is None else df.where(day)).withColumn("source_system", F.lit(tag.upper()))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
