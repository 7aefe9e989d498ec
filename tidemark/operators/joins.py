"""Star, as-of, anti, range and full joins and the upsert (Q055-Q066).

No broadcast is forced: Spark broadcasts a dimension only while its measured
size is below ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join is a
sort-merge join, which adaptive execution splits on hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, day_literal, is_posted, units_between
from tidemark.operators.windows import gmv_by


def star_join(txns: DataFrame, customers: DataFrame, products: DataFrame, regions: DataFrame, units: DataFrame) -> DataFrame:
    """Q055: posted facts with four dimensions, current versions only."""
    return (
        txns.where(is_posted())
        .drop("region_name", "bu_name")
        .join(customers.where("is_current").select("customer_key", "customer_segment"), "customer_key")
        .join(products.where("is_current").select("product_key", "product_category"), "product_key")
        .join(regions.select("region_key", "region_name"), "region_key")
        .join(units.select("bu_code"), "bu_code")
        .select("txn_id", "txn_no", "customer_segment", "product_category", "region_name", "bu_code", "amount_usd")
    )


# Sensitivity classes that need a rule.
SENSITIVE = ("PII", "PCI", "PHI", "RESTRICTED")


def dq_coverage_gap(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Q056: sensitive columns without an active rule."""
    covered = rules.where("is_active").select("table_id", "column_name")
    return (
        columns.where(F.col("sensitivity").isin(*SENSITIVE))
        .join(covered, ["table_id", "column_name"], "left_anti")
        .select("table_id", "column_name", "sensitivity")
    )


def asof_scd2_join(fact: DataFrame, dim: DataFrame, key: str, at: str, take: Mapping[str, str]) -> DataFrame:
    """Q057: the dimension version valid at the event time.

    Half-open interval, an empty end is open. ``take`` maps dimension columns to
    output names.
    """
    versions = dim.select(key, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *[F.col(c).alias(n) for c, n in take.items()])
    valid = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    other = versions.withColumnRenamed(key, "_key")
    return fact.join(other, (F.col(key) == F.col("_key")) & valid).drop("_key", "_from", "_to")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], only_if: Column | None = None,
    stamp: Mapping[str, Column] | None = None, defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The table after a merge: matched rows take ``update`` columns, unmatched source rows are added.

    ``only_if`` may compare ``t.<col>`` and ``s.<col>``; a matched row failing it
    stays as it was. ``stamp`` columns are set on every written row. The result
    goes to a new path or into swapped partitions, never over the files being read.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = t.join(s, on, "full_outer")
    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    write = matched if only_if is None else matched & F.coalesce(only_if, F.lit(False))
    added = F.col("_in_t").isNull()
    stamp, defaults = stamp or {}, defaults or {}
    out = []
    for name in target.columns:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}") if name in source.columns else None
        if name in stamp:
            value = F.when(write | added, stamp[name]).otherwise(old)
        elif name in keys:
            value = F.coalesce(old, new)
        elif new is not None and name in update:
            value = F.when(write | added, new).otherwise(old)
        elif new is not None:
            value = F.when(added, new).otherwise(old)
        else:
            value = F.when(added, defaults.get(name, F.lit(None))).otherwise(old)
        out.append(value.alias(name))
    return joined.select(*out)


def upsert_glossary(target: DataFrame, source: DataFrame) -> DataFrame:
    """Q058: certified terms into an export table; an existing term changes only for a newer version."""
    certified = source.where(F.col("status") == "CERTIFIED").select(*target.columns)
    return upsert(target, certified, ["term_name"], ["definition", "version"], F.col("t.version") < F.col("s.version"))


def employee_manager(employees: DataFrame) -> DataFrame:
    """Q059: active employees beside their manager, if any."""
    boss = employees.select(
        F.col("employee_key").alias("manager_employee_key"), F.col("full_name").alias("manager"), F.col("department").alias("manager_department")
    )
    active = employees.where(F.col("employment_status") == "ACTIVE")
    return active.join(boss, "manager_employee_key", "left").select(
        F.col("full_name").alias("employee"), "department", "manager", "manager_department"
    )


def rapid_repeat(df: DataFrame, same: Sequence[str], when: str, ident: str, minutes: int = 5) -> DataFrame:
    """Q060: rows that repeat an earlier row equal in ``same`` within ``minutes``: how many there are and the nearest.

    One row per repeat, never a row per pair. Each row stands in its own and the
    next time bucket, so a window sees a bounded stretch of time of one key.
    """
    width = minutes * 60
    at = F.unix_micros(F.col(when).cast("timestamp_ltz"))
    bucket = F.floor(F.unix_seconds(F.col(when).cast("timestamp_ltz")) / width)
    base = df.select(*same, F.col(when).alias("_when"), F.col(ident).alias("_id"), at.alias("_at"), bucket.alias("_own"))
    spread = base.withColumn("_b", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    before = Window.partitionBy(*same, "_b").orderBy("_at").rangeBetween(-width * 1_000_000, -1)
    nearest = F.max(F.struct("_when", "_id")).over(before)
    found = spread.select(*same, "_when", "_id", "_own", "_b", F.count("*").over(before).alias("repeats"), nearest.alias("_near"))
    return found.where((F.col("_b") == F.col("_own")) & (F.col("repeats") > 0)).select(
        *same, F.col("_near._id").alias("nearest_id"), F.col("_id").alias(ident), "repeats", units_between("MINUTE", "_near._when", "_when").alias("gap_minutes")
    )


def rapid_pairs(df: DataFrame, keys: DataFrame, same: Sequence[str], when: str, ident: str, minutes: int = 5) -> DataFrame:
    """Q060: the pairs themselves, for the named ``keys`` only; their number grows with the square of a burst."""
    width = minutes * 60
    bucket = F.floor(F.unix_seconds(F.col(when).cast("timestamp_ltz")) / width)
    base = df.join(keys.select(*same).distinct(), list(same), "left_semi").select(*same, F.col(when), F.col(ident), bucket.alias("_b"))
    first = base.select(*same, F.col(when).alias("_t1"), F.col(ident).alias("first_id"), F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b"))
    second = base.select(*same, F.col(when).alias("_t2"), F.col(ident).alias("second_id"), "_b")
    close = (F.col("_t1") < F.col("_t2")) & (F.col("_t2") <= F.col("_t1") + F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return first.join(second, [*same, "_b"]).where(close).select(
        *same, "first_id", "second_id", units_between("MINUTE", "_t1", "_t2").alias("gap_minutes")
    )


def unowned_tables(catalog: DataFrame, runs: DataFrame, criticality: str = "T1") -> DataFrame:
    """Q061: critical tables no job writes to."""
    critical = catalog.where(F.col("criticality") == criticality)
    return critical.join(runs, critical.table_id == runs.target_table, "left_anti").select("table_id")


def reconcile(left: DataFrame, right: DataFrame, tolerance: float = 0.01, since: Column | None = None) -> DataFrame:
    """Q062: daily totals of two systems side by side with their variance."""
    if since is not None:
        left, right = left.where(F.col("txn_date") >= since), right.where(F.col("txn_date") >= since)
    a = left.groupBy("txn_date").agg(F.sum("amount_usd").alias("erp_amount"))
    b = right.groupBy("txn_date").agg(F.sum("amount_usd").alias("oms_amount"))
    gap = F.coalesce("erp_amount", F.lit(0)) - F.coalesce("oms_amount", F.lit(0))
    return a.join(b, "txn_date", "full_outer").select(
        "txn_date", "erp_amount", "oms_amount", gap.alias("variance"), (F.abs(gap) > tolerance).alias("mismatched")
    )


def active_by_tier(customers: DataFrame, txns: DataFrame, as_of: str, quota: int = 1000) -> DataFrame:
    """Q063: customers with a posted transaction this month, by tier, and a notional quota."""
    month = F.trunc(day_literal(as_of), "MM")
    buyers = txns.where(is_posted() & (F.col("txn_date") >= month))
    active = customers.where("is_current").join(buyers, "customer_key", "left_semi").select("tier", "customer_key").distinct()
    return active.groupBy("tier").agg(F.count("*").alias("customers")).withColumn("notional_quota", F.col("customers") * quota)


def gap_fill(units: DataFrame, txns: DataFrame, first: str, last: str) -> DataFrame:
    """Q064: a row per unit and calendar day, zero where nothing was sold.

    The days are exploded inside the unit dimension: units x days rows, both bounded.
    """
    days = F.sequence(day_literal(first), day_literal(last), F.expr("INTERVAL 1 DAY"))
    spine = units.select("bu_code", F.explode(days).alias("txn_date"))
    sold = gmv_by(txns.where(F.col("txn_date").between(day_literal(first), day_literal(last))), "txn_date", "bu_code", out="g")
    return spine.join(sold, ["txn_date", "bu_code"], "left").select("txn_date", "bu_code", F.coalesce("g", F.lit(0)).alias("gmv_usd"))


def current_version_guard(dim: DataFrame, key: str = "product_id") -> DataFrame:
    """Q065: ids whose number of current versions is not one."""
    return (
        dim.groupBy(key)
        .agg(count_where(F.col("is_current")).alias("current_versions"), F.count("*").alias("total_versions"))
        .where("current_versions <> 1")
    )


def split_explode(df: DataFrame, ident: str, text: str, out: str = "tag", separator: str = ",") -> DataFrame:
    """Q066: a separated list column as rows."""
    pattern = "\\Q" + separator + "\\E"
    return df.where(F.col(text).isNotNull()).select(ident, F.explode(F.split(text, pattern)).alias(out))


