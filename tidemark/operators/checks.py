"""Stand-alone data-quality patterns (Q096-Q105)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, counts_as_gmv, day_literal, half_up, percent, ratio
from tidemark.operators.windows import window_mean


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q096: NULL share of each column, all columns in one pass."""
    return df.agg(*[percent(count_where(F.col(c).isNull()), F.count("*"), 4).alias(f"{c}_null_pct") for c in columns])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q097: keys seen more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("dup_count")).where("dup_count > 1")


# The allowed transaction types.
TXN_TYPES = ("DEPOSIT", "WITHDRAWAL", "PAYMENT", "TRANSFER", "FEE", "REFUND", "CHARGEBACK")


def validity(txns: DataFrame, types: Sequence[str] = TXN_TYPES) -> DataFrame:
    """Q098: rows outside the type domain, with malformed currency or an unexplained negative amount."""
    return txns.agg(
        count_where(~F.col("txn_type").isin(*types)).alias("invalid_txn_types"),
        count_where(F.length("currency_code") != 3).alias("invalid_currencies"),
        count_where((F.col("amount_usd") < 0) & ~F.col("txn_type").isin("REFUND", "CHARGEBACK")).alias("negative_non_refund"),
    )


def orphan_counts(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts per key without a dimension row. Facts are counted per key first, so a hot key is one row in the join."""
    per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count("*").alias("n"))
    return per_key.join(dim.select(F.col(dim_key).alias("_k")), "_k", "left_anti").withColumnRenamed("_k", fact_key)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str) -> DataFrame:
    """Q099: number of facts without a dimension row."""
    return orphan_counts(fact, dim, fact_key, dim_key).agg(
        F.lit(name).alias("fk_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
    )


def staleness(df: DataFrame, day: str, as_of: str, limit: int = 1) -> DataFrame:
    """Q100: newest date, its age in days and a flag."""
    newest = F.max(day)
    age = F.datediff(day_literal(as_of), newest)
    return df.agg(newest.alias("newest_day"), age.alias("days_stale"), F.when(age > limit, "STALE").otherwise("OK").alias("state"))


def volume_delta(df: DataFrame, day: str, newest: int | None = 10) -> DataFrame:
    """Q101: rows per day against the day before, newest days first."""
    daily = df.groupBy(day).agg(F.count("*").alias("row_count"))
    out = daily.withColumn("prior_day", F.lag("row_count").over(Window.orderBy(day))).withColumn(
        "pct_change", ratio(F.col("row_count") - F.col("prior_day"), "prior_day")
    )
    return out if newest is None else out.orderBy(F.col(day).desc()).limit(newest)


def zscore_outliers(df: DataFrame, value: str, keep: Sequence[str], sigmas: float = 5) -> DataFrame:
    """Q102: rows above mean + sigmas * standard deviation (upper side)."""
    x = F.col(value).cast("double")
    stats = df.agg(F.struct(half_up(F.avg(x), 6).alias("mean"), half_up(F.stddev_samp(x), 6).alias("sd")).alias("s"))
    marked = df.select(*keep, value).withColumn("s", stats.scalar())
    return marked.where(F.col(value) > F.col("s.mean") + sigmas * F.col("s.sd")).select(
        *keep, value, half_up("s.mean", 4).alias("mean_value"), ratio(F.abs(F.col(value) - F.col("s.mean")), "s.sd", 2).alias("z_score")
    )


def fact_vs_kpi(txns: DataFrame, kpis: DataFrame) -> DataFrame:
    """Q103: certified total of the facts beside the total of the KPI table."""
    fact = txns.where(counts_as_gmv()).agg(F.coalesce(F.sum("amount_usd"), F.lit(0)).alias("fact_total"))
    kpi = kpis.agg(F.coalesce(F.sum("gmv_usd"), F.lit(0)).alias("v"))
    return fact.select("fact_total", kpi.scalar().alias("kpi_total"))


def null_spike(df: DataFrame, day: str, column: str, rows: int = 14, factor: float = 2.0) -> DataFrame:
    """Q104: daily NULL share against the mean of the preceding ``rows`` days."""
    missing = count_where(F.col(column).isNull())
    daily = df.groupBy(day).agg(percent(missing, F.count("*"), 4).alias("null_rate"))
    trailing = window_mean("null_rate", Window.orderBy(day).rowsBetween(-rows, -1), 4)
    spike = (F.col("null_rate") > factor * F.col("trailing_avg")) & (F.col("trailing_avg") > 0)
    return daily.withColumn("trailing_avg", trailing).withColumn("flag", F.when(spike, "NULL_SPIKE").otherwise("OK"))


def late_rows(df: DataFrame, loaded: str, day: str, cutoff_hours: int = 12) -> DataFrame:
    """Q105: rows loaded later than the cutoff after their date."""
    limit = F.col(day).cast("timestamp_ntz") + F.expr(f"INTERVAL {int(cutoff_hours)} HOURS")
    return df.agg(count_where(F.col(loaded) > limit).alias("late_rows"), F.count("*").alias("total_rows"))
