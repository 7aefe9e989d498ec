"""KPI specifications and their evaluation (A1-A3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, day_literal, half_up, is_posted, sum_where, ts_literal, units_between

WINDOW_DAYS = {"1d": 0, "7d": 7, "30d": 30, "90d": 90}
AGGREGATIONS = {
    "SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "COUNT": F.count, "COUNT DISTINCT": F.count_distinct,
}


def kpi(df: DataFrame, metric: str, aggregation: str, dimensions: Sequence[str], window: str, as_of: str, day: str = "txn_date") -> DataFrame:
    """A1: an aggregation of posted rows over a trailing window. Unknown windows mean 30 days."""
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"aggregation {aggregation!r} is none of {sorted(AGGREGATIONS)}")
    missing = [c for c in (metric, *dimensions, day) if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    since = F.date_sub(day_literal(as_of), WINDOW_DAYS.get(window, 30))
    return df.where(is_posted() & (F.col(day) >= since)).groupBy(*dimensions).agg(AGGREGATIONS[aggregation](metric).alias("value"))


@dataclass(frozen=True)
class KpiSpec:
    """Limits of a KPI: beyond ``breach`` is a breach, between the two limits a warning."""

    kpi_id: str
    name: str
    unit: str
    higher_is_better: bool
    breach: float
    warn: float


# The certified KPIs with their limits.
CERTIFIED = [
    KpiSpec("KPI-001", "Gross Merchandise Value", "USD", True, 2_500_000, 2_700_000),
    KpiSpec("KPI-002", "Average Order Value", "USD", True, 72, 82),
    KpiSpec("KPI-003", "Active Customers", "count", True, 38_000, 42_000),
    KpiSpec("KPI-004", "Support SLA Attainment", "%", True, 92, 95),
    KpiSpec("KPI-005", "Enterprise DQ Score", "score", True, 95, 97),
    KpiSpec("KPI-006", "Service Error Rate", "%", False, 3.5, 2),
    KpiSpec("KPI-007", "Daily Cloud Cost", "USD", False, 30_000, 20_000),
    KpiSpec("KPI-008", "Run Success Rate", "%", True, 96, 99),
    KpiSpec("KPI-009", "Gross Margin", "%", True, 27, 30),
    KpiSpec("KPI-010", "Chargeback Rate", "%", False, 2.5, 1.5),
    KpiSpec("KPI-011", "Data Freshness", "min", False, 45, 15),
]


def kpi_status(value: Column, breach: Column, warn: Column, higher: Column) -> Column:
    """A3: BREACH, WARNING or ON_TRACK in the direction that is good for this KPI; no value has no status."""
    beyond = F.when(higher, value < breach).otherwise(value > breach)
    short = F.when(higher, value < warn).otherwise(value > warn)
    return F.when(value.isNull(), F.lit(None)).when(beyond, "BREACH").when(short, "WARNING").otherwise("ON_TRACK")


def specs_frame(df: DataFrame, specs: Sequence[KpiSpec] = CERTIFIED) -> DataFrame:
    rows = [(s.kpi_id, s.name, s.unit, s.higher_is_better, float(s.breach), float(s.warn)) for s in specs]
    return df.sparkSession.createDataFrame(rows, "kpi_id string, name string, unit string, higher boolean, breach double, warn double")


def certified_values(tables: Mapping[str, DataFrame], as_of: str, events_as_of: str) -> DataFrame:
    """Value of every certified KPI. KPIs over one table share one pass over it."""
    today, events_today = day_literal(as_of), day_literal(events_as_of)

    def since(day: str, days: int, end: Column = today) -> Column:
        return F.col(day).between(F.date_sub(end, days), end)

    def share(cond: Column, scope: Column) -> Column:
        return 100 * F.try_divide(count_where(cond & scope).cast("double"), count_where(scope).cast("double"))

    txns, month, week = tables["transactions"], since("txn_date", 30), since("txn_date", 7)
    sold = is_posted() & month
    per_txn = txns.agg(
        sum_where("amount_usd", sold & (F.col("amount_usd") > 0)).cast("double").alias("KPI-001"),
        F.try_divide(sum_where("amount_usd", sold).cast("double"), count_where(sold).cast("double")).alias("KPI-002"),
        F.count_distinct(F.when(sold, F.col("customer_key"))).cast("double").alias("KPI-003"),
        share(F.col("txn_type") == "CHARGEBACK", week).alias("KPI-010"),
        units_between("MINUTE", F.max("etl_loaded_at"), ts_literal(f"{as_of} 00:00:00")).cast("double").alias("KPI-011"),
    )
    per_product = txns.where(sold).groupBy("product_key").agg(F.sum("amount_usd").alias("s"))
    margin = per_product.join(tables["dim_product"].where("is_current"), "product_key").agg(
        (100 * F.try_divide(F.sum((F.col("s") * F.col("margin_pct")).cast("decimal(38,6)")).cast("double"), F.sum("s").cast("double"))).alias("KPI-009")
    )
    met = F.col("resolved_at") <= F.col("sla_due_at")
    parts = [
        per_txn,
        margin,
        tables["support_cases"].agg(share(met, since("opened_date", 7)).alias("KPI-004")),
        tables["dq_health"].where(F.col("score_date") == today).agg(F.try_divide(F.sum("dq_score").cast("double"), F.count("*").cast("double")).alias("KPI-005")),
        tables["ops_events"].agg(share(F.col("status") == "FAILURE", since("event_date", 1, events_today)).alias("KPI-006")),
        tables["query_cost"].where(F.col("job_date") == today).agg(F.sum("cost_usd").cast("double").alias("KPI-007")),
        tables["pipeline_runs"].agg(share(F.col("status") == "SUCCESS", since("run_date", 7)).alias("KPI-008")),
    ]
    longs = [p.select(F.inline(F.array(*[F.struct(F.lit(c).alias("kpi_id"), half_up(f"`{c}`", 2).alias("value")) for c in p.columns]))) for p in parts]
    return reduce(DataFrame.unionByName, longs)


def certified_kpis(tables: Mapping[str, DataFrame], as_of: str, events_as_of: str) -> DataFrame:
    """A2: the certified KPIs with value and status."""
    values = certified_values(tables, as_of, events_as_of)
    return values.join(specs_frame(values), "kpi_id").select(
        "kpi_id", "name", "unit", "value", kpi_status(F.col("value"), F.col("breach"), F.col("warn"), F.col("higher")).alias("kpi_state")
    )
