"""Freshness, drift, alert and platform health reports (Q067-Q077)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    count_where,
    half_up,
    mean_of,
    percent,
    ratio,
    trunc_ts,
    ts_literal,
    units_between,
)
from tidemark.operators.segments import last_success
from tidemark.operators.windows import top_n, trailing_mean


def freshness_report(catalog: DataFrame, runs: DataFrame, as_of_ts: str, criticality: str = "T1") -> DataFrame:
    """Q067: hours since the last good load of each critical table and its state."""
    minutes = units_between("MINUTE", "last_ok", ts_literal(as_of_ts))
    critical = catalog.where(F.col("criticality") == criticality)
    return critical.join(last_success(runs), critical.table_id == F.col("target_table"), "left").select(
        "table_id",
        "sla_hours",
        "data_owner",
        F.col("last_ok").alias("last_success"),
        half_up(minutes.cast("double") / 60, 2).alias("hours_since_load"),
        F.when(F.col("last_ok").isNull(), "NEVER_LOADED")
        .when(minutes > F.col("sla_hours") * 60, "BREACHED")
        .otherwise("OK")
        .alias("freshness_status"),
    )


def pipeline_success(runs: DataFrame, since: Column | None = None) -> DataFrame:
    """Q068: run count, success rate, mean score and mean duration per job."""
    src = runs if since is None else runs.where(F.col("run_date") >= since)
    ok = count_where(F.col("status") == "SUCCESS")
    return src.groupBy("pipeline_name").agg(
        F.count("*").alias("runs"),
        ok.alias("successes"),
        percent(ok, F.count("*")).alias("success_rate"),
        mean_of("dq_score", 2).alias("avg_dq_score"),
        mean_of(units_between("MINUTE", "run_started_at", "run_finished_at"), 1).alias("avg_duration_min"),
    )


def volume_drift(runs: DataFrame, rows: int = 28, since: Column | None = None) -> DataFrame:
    """Q069: rows written against the mean of the preceding ``rows`` good runs."""
    good = runs.where(F.col("status") == "SUCCESS").select("target_table", "run_date", "run_id", "rows_written")
    base = trailing_mean(good, "target_table", ["run_date", "run_id"], "rows_written", rows, "prior")
    if since is not None:
        base = base.where(F.col("run_date") >= since)
    n, prior = F.col("rows_written"), F.col("prior")
    flag = (
        F.when(prior.isNull() | (n == 0), "WARN")
        .when(n < 0.5 * prior, "DROP_ALERT")
        .when(n > 2.0 * prior, "SURGE_ALERT")
        .otherwise("NORMAL")
    )
    return base.select(
        "target_table", "run_date", "run_id", "rows_written", half_up(prior, 0).alias("trailing_avg"),
        ratio(n, prior, 3).alias("volume_ratio"), flag.alias("drift_flag"),
    )


def late_arrivals(txns: DataFrame, more_than: int = 3) -> DataFrame:
    """Q070: days whose newest load came more than ``more_than`` days later."""
    loaded = F.to_date("etl_loaded_at")
    return (
        txns.groupBy("txn_date")
        .agg(F.max(loaded).alias("latest_load_date"), F.max(F.datediff(loaded, F.col("txn_date"))).alias("max_late_days"))
        .where(F.col("max_late_days") > more_than)
    )


def dq_trend(health: DataFrame, rows: int = 7) -> DataFrame:
    """Q071: score change against the score ``rows`` days of record earlier. One row per product and day."""
    w = Window.partitionBy("data_product_name").orderBy("score_date")
    return health.select(
        "score_date", "data_product_name", "dq_score", (F.col("dq_score") - F.lag("dq_score", rows).over(w)).alias("dq_change")
    )


def dq_failures(results: DataFrame) -> DataFrame:
    """Q072: failed checks and affected rows by dimension and severity."""
    return results.where(F.col("status") == "FAIL").groupBy("dimension", "severity").agg(
        F.count("*").alias("failed_checks"),
        F.sum("rows_failed").alias("rows_impacted"),
        ratio(F.sum("rows_failed"), F.sum("rows_checked")).alias("failure_rate"),
    )


def schema_drift(physical: DataFrame, registered: DataFrame) -> DataFrame:
    """Q073: columns present in the source and missing from the catalog."""
    return physical.join(registered, ["table_id", "column_name"], "left_anti").select("table_id", "column_name", "data_type")


def alert_queue(alerts: DataFrame, as_of_ts: str, samples: int = 5) -> DataFrame:
    """Q074: unresolved alerts by type, severity and state, their mean age and newest subjects."""
    keys = ["alert_type", "severity", "status"]
    waiting = alerts.where(F.col("status").isin("OPEN", "ACKNOWLEDGED"))
    counts = waiting.groupBy(*keys).agg(
        F.count("*").alias("open_alerts"), mean_of(units_between("HOUR", "triggered_at", ts_literal(as_of_ts)), 1).alias("avg_age_hours")
    )
    newest = top_n(waiting, keys, [F.col("triggered_at").desc(), F.col("alert_id").desc()], samples)
    ordered = F.sort_array(F.collect_list(F.struct("rn", "subject")))
    texts = newest.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["subject"]), " | ").alias("samples"))
    return counts.join(texts, keys)


def mttr(alerts: DataFrame) -> DataFrame:
    """Q075: mean hours to resolution by alert type."""
    solved = alerts.where((F.col("status") == "RESOLVED") & F.col("resolved_at").isNotNull())
    return solved.groupBy("alert_type").agg(
        mean_of(units_between("HOUR", "triggered_at", "resolved_at"), 1).alias("avg_mttr_hours"), F.count("*").alias("resolved_count")
    )


def dq_run_punctuality(results: DataFrame, cutoff_minutes: int = 45) -> DataFrame:
    """Q076: share of check runs started within the cutoff after midnight."""
    late = units_between("MINUTE", trunc_ts("DAY", "run_timestamp"), "run_timestamp")
    on_time = count_where(late <= cutoff_minutes)
    return results.groupBy("run_date").agg(
        F.count("*").alias("runs"), on_time.alias("on_time_runs"), percent(on_time, F.count("*"), 1).alias("on_time_pct")
    )


def health_index(runs: DataFrame, health: DataFrame, as_of_ts: str, product: str, weights=(0.35, 0.35, 0.30)) -> DataFrame:
    """Q077: weighted blend of run success, quality score and freshness per day."""
    fresh = units_between("HOUR", F.max("run_finished_at"), ts_literal(as_of_ts)) <= 24
    daily = runs.groupBy("run_date").agg(
        F.try_divide(100 * count_where(F.col("status") == "SUCCESS").cast("double"), F.count("*").cast("double")).alias("p"),
        F.when(fresh, 100.0).otherwise(0.0).alias("f"),
    )
    scores = health.where(F.col("data_product_name") == product).groupBy(F.col("score_date").alias("run_date")).agg(
        F.try_divide(F.sum("dq_score").cast("double"), F.count("dq_score").cast("double")).alias("d")
    )
    wp, wd, wf = weights
    return daily.join(scores, "run_date", "left").select(
        F.col("run_date").alias("metric_date"),
        half_up("p", 2).alias("run_score"),
        half_up("d", 2).alias("dq_score"),
        half_up("f", 2).alias("freshness_score"),
        half_up(wp * F.col("p") + wd * F.col("d") + wf * F.col("f"), 2).alias("health_index"),
    )
