"""Cost summary, alert rows and catalog refresh (SQ3-SQ6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, day_literal, half_up, sum_where, ts_literal, units_between
from tidemark.operators.joins import upsert


def _per_user(cost: DataFrame, day: str | None) -> DataFrame:
    src = cost if day is None else cost.where(F.col("job_date") == day_literal(day))
    curated = F.col("table_reference").like("%core_layer%") | F.col("table_reference").like("%analytics_layer%")
    return src.groupBy("job_date", "user_email").agg(F.sum("cost_usd").alias("c"), F.count("*").alias("n"), sum_where("cost_usd", curated).alias("t1"))


def cost_summary(cost: DataFrame, day: str | None = None, user_limit: float = 1000) -> DataFrame:
    """SQ3: total, top spender, number of users above the limit and cost on the curated layers, per day."""
    spender = F.struct(F.col("c"), F.col("user_email"))
    return _per_user(cost, day).groupBy(F.col("job_date").alias("summary_date")).agg(
        half_up(F.sum("c"), 2).alias("total_cost_usd"),
        F.sum("n").alias("total_queries"),
        F.max(spender)["user_email"].alias("top_spender_user"),
        half_up(F.max("c"), 2).alias("top_spender_cost_usd"),
        count_where(F.col("c") > user_limit).alias("anomalous_users"),
        half_up(F.sum("t1"), 2).alias("tier_1_query_cost_usd"),
    )


def anomalous_users(cost: DataFrame, day: str | None = None, user_limit: float = 1000) -> DataFrame:
    """SQ3: the users above the limit, a row per day and user, so a day with many of them is no large value."""
    over = _per_user(cost, day).where(F.col("c") > user_limit)
    return over.select(F.col("job_date").alias("summary_date"), "user_email", half_up("c", 2).alias("cost_usd"))


def alert_rows(df: DataFrame, kind: str, severity: Column, subject: Column, message: Column, source: Column, as_of_ts: str) -> DataFrame:
    """Rows of the alert table. The id is a digest of what the alert says, so a retried task writes the same id."""
    at = ts_literal(as_of_ts)
    return df.select(
        F.md5(F.concat_ws("|", F.lit(kind), subject, source, F.lit(as_of_ts))).alias("alert_id"),
        F.lit(kind).alias("alert_type"),
        severity.alias("severity"),
        subject.alias("subject"),
        message.alias("message"),
        at.alias("triggered_at"),
        F.to_date(at).alias("triggered_date"),
        F.lit("OPEN").alias("status"),
        source.alias("source_table"),
    )


def freshness_alerts(catalog: DataFrame, as_of_ts: str, criticality: str = "T1") -> DataFrame:
    """SQ4: critical tables older than their limit."""
    age = units_between("HOUR", "last_loaded_at", ts_literal(as_of_ts))
    stale = catalog.where(F.col("last_loaded_at").isNotNull() & (age > F.col("sla_hours")) & (F.col("criticality") == criticality))
    text = F.concat(
        F.lit("Table "), F.col("table_name"), F.lit(" last loaded "), age.cast("string"),
        F.lit(" hours ago. SLA is "), F.col("sla_hours").cast("string"), F.lit(" hours."),
    )
    return alert_rows(stale, "FRESHNESS", F.lit("HIGH"), F.concat(F.lit("Freshness breach: "), F.col("table_name")), text, F.col("table_id"), as_of_ts)


def dq_alerts(health: DataFrame, as_of_ts: str, floor: float = 90, day: str | None = None) -> DataFrame:
    """SQ5: products whose score fell below the floor; the enterprise row is not a product."""
    low = health.where((F.col("dq_score") < floor) & (F.col("data_product_name") != "ENTERPRISE"))
    if day is not None:
        low = low.where(F.col("score_date") == day_literal(day))
    text = F.concat(
        F.lit("DQ score "), F.col("dq_score").cast("string"), F.lit(" is below the "), F.lit(f"{floor:.1f}"),
        F.lit(" threshold on "), F.col("score_date").cast("string"),
    )
    return alert_rows(low, "DQ", F.lit("HIGH"), F.concat(F.lit("DQ score drop on "), F.col("data_product_name")), text, F.col("table_id"), as_of_ts)


def catalog_merge(catalog: DataFrame, scan: DataFrame, as_of_ts: str) -> DataFrame:
    """SQ6: row counts and sizes from a scan; unknown tables enter with default ownership."""
    defaults = {
        "table_type": F.lit("TABLE"), "owning_team": F.lit("UNASSIGNED"), "data_owner": F.lit("UNASSIGNED"), "classification": F.lit("INTERNAL"),
        "criticality": F.lit("T3"), "is_certified": F.lit(False), "version": F.lit("v1.0.0"), "created_at": ts_literal(as_of_ts),
    }
    return upsert(catalog, scan, ["table_id"], ["row_count", "size_bytes"], stamp={"updated_at": ts_literal(as_of_ts)}, defaults=defaults)
