"""Finance, support, operations, cost and adoption KPIs (Q078-Q088)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    count_where,
    counts_as_gmv,
    day_literal,
    half_up,
    is_posted,
    mean_of,
    percent,
    ratio,
    sum_where,
    ts_literal,
    units_between,
    week_monday,
)
from tidemark.operators.grouping import LAYERS, layer_of
from tidemark.operators.ranking import exact_percentiles


def signed_amount(amount: str = "amount_usd") -> Column:
    """The one sign rule: refunds count against revenue whatever sign they are stored with."""
    return F.when(F.col("txn_type") == "REFUND", -F.abs(F.col(amount))).otherwise(F.col(amount))


def pnl_bridge(txns: DataFrame, products: DataFrame, since: Column | None = None) -> DataFrame:
    """Q078: net and gross revenue, chargebacks and margins by business unit."""
    posted = txns.where(is_posted())
    if since is not None:
        posted = posted.where(F.col("txn_date") >= since)
    per_product = posted.groupBy("bu_code", "product_key").agg(
        F.sum(signed_amount()).alias("net"),
        sum_where("amount_usd", ~F.col("txn_type").isin("REFUND", "CHARGEBACK")).alias("gross"),
        sum_where("amount_usd", F.col("txn_type") == "CHARGEBACK").alias("cb"),
        F.sum("amount_usd").alias("total"),
    )
    joined = per_product.join(products.where("is_current").select("product_key", "margin_pct"), "product_key")
    margin = F.sum((F.col("total") * F.col("margin_pct")).cast("decimal(38,6)"))
    return joined.groupBy("bu_code").agg(
        F.sum("net").alias("net_revenue_usd"),
        F.sum("gross").alias("gross_revenue_usd"),
        F.sum("cb").alias("chargebacks_usd"),
        half_up(margin, 2).alias("gross_margin_usd"),
        ratio(F.sum("gross") - F.sum("cb") - margin, F.sum("gross")).alias("net_margin_rate"),
    )


def mtd_vs_last(txns: DataFrame, as_of: str) -> DataFrame:
    """Q079: month to date against the whole previous month, units active this month. One scan."""
    today = day_literal(as_of)
    first = F.trunc(today, "MM")
    this_month = F.col("txn_date") >= first
    span = txns.where(counts_as_gmv() & F.col("txn_date").between(F.add_months(first, -1), today))
    sums = span.groupBy("bu_code").agg(
        F.sum(F.when(this_month, F.col("amount_usd"))).alias("mtd_gmv"), sum_where("amount_usd", ~this_month).alias("last_month_gmv")
    )
    return sums.where(F.col("mtd_gmv").isNotNull()).withColumn(
        "mom_change", ratio(F.col("mtd_gmv") - F.col("last_month_gmv"), "last_month_gmv")
    )


def fcr_csat_weekly(cases: DataFrame) -> DataFrame:
    """Q080: first-contact resolution, satisfaction and escalation by week and case type."""
    n = F.count("*")
    return cases.groupBy(week_monday("opened_date").alias("week_start"), "case_type").agg(
        n.alias("cases"),
        percent(count_where((F.col("reopen_count") == 0) & (F.col("status") == "CLOSED")), n).alias("fcr_pct"),
        mean_of("satisfaction_score", 2).alias("avg_csat"),
        percent(count_where(F.col("is_escalated")), n).alias("escalation_pct"),
    )


# Attainment targets by priority, 85 for the rest.
SLA_TARGETS = {"P1": 98, "P2": 95, "P3": 90}


def sla_by_priority(cases: DataFrame, targets=SLA_TARGETS, rest: int = 85) -> DataFrame:
    """Q081: closed-in-time share of each priority beside its target."""
    met = count_where((F.col("resolved_at") <= F.col("sla_due_at")) & (F.col("status") == "CLOSED"))
    target = None
    for name, value in targets.items():
        hit = F.col("priority") == name
        target = F.when(hit, value) if target is None else target.when(hit, value)
    return cases.groupBy("priority").agg(
        F.count("*").alias("total_cases"), met.alias("met_sla"), percent(met, F.count("*")).alias("sla_pct")
    ).withColumn("sla_target_pct", target.otherwise(rest))


def service_slo(events: DataFrame, top: int | None = 20) -> DataFrame:
    """Q082: requests, failures, error rate and exact p95 latency per service."""
    failed = count_where(F.col("status") == "FAILURE")
    counts = events.groupBy("service_name").agg(
        F.count("*").alias("requests"), failed.alias("failures"), percent(failed, F.count("*"), 4).alias("error_rate_pct")
    )
    if top is not None:
        counts = counts.orderBy(F.col("failures").desc(), "service_name").limit(top)
    p95 = exact_percentiles(events, "latency_ms", [("p95", 0.95)], by=["service_name"])
    return counts.join(p95.select("service_name", half_up("p95", 0).alias("p95_latency_ms")), "service_name", "left")


def slo_trend(events: DataFrame, above: float = 1.0) -> DataFrame:
    """Q083: weekly error rate over the limit beside the week before."""
    weekly = events.groupBy(week_monday("event_date").alias("week_start"), "service_name").agg(
        percent(count_where(F.col("status") == "FAILURE"), F.count("*")).alias("error_rate_pct")
    )
    earlier = F.lag("error_rate_pct").over(Window.partitionBy("service_name").orderBy("week_start"))
    return weekly.withColumn("prior_week_rate", earlier).where(
        (F.col("error_rate_pct") > above) & F.col("prior_week_rate").isNotNull()
    )


def top_queries(cost: DataFrame, n: int = 10) -> DataFrame:
    """Q084: the queries with the highest total cost."""
    totals = cost.groupBy("user_email", "query_id").agg(
        F.sum("cost_usd").alias("c"), half_up(F.sum("bytes_processed") / 1e12, 3).alias("tb_processed"), F.count("*").alias("executions")
    )
    return totals.orderBy(F.col("c").desc(), "user_email", "query_id").limit(n).select(
        "user_email", "query_id", half_up("c", 2).alias("cost_usd"), "tb_processed", "executions"
    )


def cost_by_layer(cost: DataFrame) -> DataFrame:
    """Q085: cost of each storage layer and its part of the total."""
    order = F.create_map(*[x for i, name in enumerate((*LAYERS, "other"), 1) for x in (F.lit(name), F.lit(f"{i}_{name}"))])
    by_layer = cost.groupBy(layer_of().alias("l")).agg(F.sum("cost_usd").alias("c"))
    return by_layer.select(
        F.element_at(order, F.col("l")).alias("layer"),
        half_up("c", 2).alias("cost_usd"),
        percent("c", F.sum("c").over(Window.partitionBy())).alias("cost_share_pct"),
    )


def weekly_active(activity: DataFrame) -> DataFrame:
    """Q086: weekly active users and dashboard views per user."""
    users, views = F.count_distinct("employee_key"), count_where(F.col("activity_type") == "DASHBOARD_VIEW")
    return activity.groupBy(week_monday("activity_date").alias("week_start")).agg(
        users.alias("weekly_active_users"), views.alias("dashboard_views")
    ).withColumn("views_per_user", ratio("dashboard_views", "weekly_active_users", 2))


def stale_dashboards(activity: DataFrame, as_of: str, app: str = "Tableau", days: int = 30) -> DataFrame:
    """Q087: viewers, views and last use of each dashboard, with its state."""
    last = F.max("activity_date")
    return activity.where(F.col("app_name") == app).groupBy("resource_name").agg(
        F.count_distinct("employee_key").alias("viewers"),
        count_where(F.col("activity_type") == "DASHBOARD_VIEW").alias("views"),
        last.alias("last_viewed"),
        F.when(last < F.date_sub(day_literal(as_of), days), "STALE").otherwise("ACTIVE").alias("usage"),
    )


def data_case_share(cases: DataFrame, as_of_ts: str, words: Sequence[str] = ("data", "report")) -> DataFrame:
    """Q088: cases whose note mentions data or reports against the rest."""
    note = F.lower("case_note")
    hit = F.lit(False)
    for word in words:
        hit = hit | note.like(f"%{word}%")
    hours = units_between("HOUR", "opened_at", F.coalesce("resolved_at", ts_literal(as_of_ts)))
    return cases.groupBy(F.when(hit, "DATA_RELATED").otherwise("OPERATIONAL").alias("root_cause_bucket")).agg(
        F.count("*").alias("cases"), mean_of(hours, 1).alias("avg_handle_hours")
    )
