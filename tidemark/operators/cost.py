"""Cost telemetry and job performance reports (Q089-Q095, T1-T7).

The reports read job telemetry kept as ordinary tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, half_up, percent, ratio, ts_literal, units_between
from tidemark.operators.grouping import hourly_slots


def gb(value: str, digits: int = 2) -> Column:
    return half_up(F.coalesce(F.col(value), F.lit(0)) / 1e9, digits)


def tb(value: str | Column, digits: int = 3) -> Column:
    return half_up((F.coalesce(F.col(value), F.lit(0)) if isinstance(value, str) else value) / 1e12, digits)


def cost_per_tb(cost: DataFrame, min_cost: float = 100) -> DataFrame:
    """Q089: cost per terabyte of each user above a cost floor."""
    sums = cost.groupBy("user_email").agg(F.sum("cost_usd").alias("c"), F.sum("bytes_processed").alias("b"))
    return sums.where(F.col("c") > min_cost).select(
        "user_email", half_up("c", 2).alias("cost_usd"), tb("b").alias("tb_processed"), ratio(F.col("c"), F.col("b") / 1e12).alias("cost_per_tb")
    )


def full_scans(cost: DataFrame, min_bytes: float = 10e9, n: int = 25) -> DataFrame:
    """Q090: the jobs that read most, above a size floor."""
    big = cost.where(F.col("bytes_processed") > int(min_bytes))
    return big.orderBy(F.col("bytes_processed").desc(), "job_id").limit(n).select(
        "job_id", "user_email", gb("bytes_processed").alias("gb_processed"), half_up("cost_usd", 2).alias("cost_usd"), "table_reference"
    )


def cache_hit_users(cost: DataFrame, min_jobs: int = 20, n: int = 15) -> DataFrame:
    """Q091: the users with the lowest cache-hit share."""
    sums = cost.groupBy("user_email").agg(
        F.count("*").alias("jobs"),
        percent(count_where(F.col("cache_hit")), F.count("*"), 1).alias("cache_hit_pct"),
        F.sum("bytes_billed").alias("b"),
    )
    return sums.where(F.col("jobs") > min_jobs).orderBy("cache_hit_pct", "user_email").limit(n).select(
        "user_email", "cache_hit_pct", tb("b").alias("tb_billed")
    )


def redundant_queries(cost: DataFrame, min_runs: int = 5, n: int = 20) -> DataFrame:
    """Q092: query texts run again and again."""
    sums = cost.groupBy("query_text").agg(F.count("*").alias("executions"), F.sum("cost_usd").alias("c"))
    return sums.where(F.col("executions") >= min_runs).orderBy(F.col("executions").desc(), "query_text").limit(n).select(
        "query_text", "executions", half_up("c", 2).alias("cost_usd")
    )


def slot_hourly(usage: DataFrame) -> DataFrame:
    """Q093: peak and mean slots per hour in thousands."""
    return hourly_slots(usage, 1000.0, 2)


def cost_by_label(cost: DataFrame) -> DataFrame:
    """Q094: cost by the cost centre and team in the job labels."""
    label = F.from_json("query_labels", "cost_center STRING, team STRING")
    sums = cost.groupBy("query_labels").agg(F.sum("cost_usd").alias("c")).withColumn("l", label)
    per_team = sums.groupBy(F.col("l.cost_center").alias("cost_center"), F.col("l.team").alias("team")).agg(F.sum("c").alias("c"))
    return per_team.select(
        "cost_center", "team", half_up("c", 2).alias("cost_usd"), ratio("c", F.sum("c").over(Window.partitionBy())).alias("pct_of_total")
    )


def unpruned_scans(cost: DataFrame, table: str, min_bytes: float = 200e9, n: int = 10) -> DataFrame:
    """Q095: large scans of one table."""
    hit = F.col("table_reference").like(f"%{table}%") & (F.col("bytes_processed") > int(min_bytes))
    return cost.where(hit).orderBy(F.col("bytes_processed").desc(), "job_id").limit(n).select(
        "job_id", gb("bytes_processed").alias("gb_processed")
    )


def _done(jobs: DataFrame, kind: str | None = None) -> DataFrame:
    done = jobs.where(F.col("state") == "DONE")
    return done if kind is None else done.where(F.col("job_type") == kind)


def top_slot_jobs(jobs: DataFrame, n: int = 25) -> DataFrame:
    """Finished queries by slot time."""
    return _done(jobs, "QUERY").orderBy(F.col("total_slot_ms").desc(), "job_id").limit(n).select(
        "job_id", "user_email", "job_type", half_up(F.col("total_slot_ms") / 60000, 1).alias("slot_minutes"),
        gb("bytes_processed").alias("gb_processed"), tb("bytes_billed").alias("tb_billed"), "query_text",
    )


def top_scan_jobs(jobs: DataFrame, n: int = 25) -> DataFrame:
    """Finished jobs by bytes read."""
    return _done(jobs).orderBy(F.col("bytes_processed").desc(), "job_id").limit(n).select(
        "job_id", "user_email", gb("bytes_processed").alias("gb_processed"), tb("bytes_billed").alias("tb_billed"), "query_text"
    )


def cache_efficiency(jobs: DataFrame, min_jobs: int = 10) -> DataFrame:
    """Cache-hit share of each user with enough finished queries."""
    return _done(jobs, "QUERY").groupBy("user_email").agg(
        percent(count_where(F.col("cache_hit")), F.count("*"), 1).alias("cache_hit_pct"), F.count("*").alias("jobs")
    ).where(F.col("jobs") > min_jobs)


def refresh_staleness(refreshes: DataFrame, as_of_ts: str) -> DataFrame:
    """T5: minutes since each table was last refreshed."""
    return refreshes.select(
        "table_name", "last_refresh_time", units_between("MINUTE", "last_refresh_time", ts_literal(as_of_ts)).alias("minutes_since_refresh"), "total_rows"
    )


def table_sizes(catalog: DataFrame, datasets: list[str]) -> DataFrame:
    """Size and rows of the tables of some layers."""
    return catalog.where(F.col("dataset_id").isin(*datasets)).select(
        "dataset_id", "table_name", gb("size_bytes").alias("size_gb"), "row_count"
    )


def scan_budget_gate(jobs: DataFrame, budget_tb: float = 5.0) -> DataFrame:
    """BLOCK when the summed bytes exceed the budget, else ALLOW."""
    total = F.coalesce(F.sum("bytes_processed"), F.lit(0)) / 1e12
    return jobs.agg(half_up(total, 6).alias("estimated_tb"), F.when(total > budget_tb, "BLOCK").otherwise("ALLOW").alias("ci_decision"))
