"""The data-quality run: checks, results, scores, alerts and the publish gate.

All row-level rules of a table are folded into one aggregation, so a table is
scanned once for them however many there are. Uniqueness, integrity, volume,
accuracy and consistency need their own grouping and read only their columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, half_up, ts_literal, units_between
from tidemark.quality.rules import Rule, load_rules
from tidemark.session import cut_lineage, run_dir

# Severity weights; a severity not listed weighs 0.5.
SEVERITY_WEIGHTS = {"ERROR": 1.0, "WARNING": 0.5, "INFO": 0.1}
OTHER_WEIGHT = 0.5
SCORE_FLOOR = 90.0

RESULT_SCHEMA = (
    "rule_id string, table_id string, column_name string, dimension string, severity string, max_rate double, rows_checked long, rows_failed long"
)
ROW_DIMENSIONS = {"COMPLETENESS", "VALIDITY", "TIMELINESS", "RATIO", "FRESHNESS"}


# -- row-level checks: a pair (rows checked, rows failed) of aggregates ----------
def _scope(rule: Rule) -> Column:
    text = rule.params.get("filter")
    return F.expr(text) if text else F.lit(True)


def failing(rule: Rule) -> Column:
    """The rows that break a row-level rule. A condition that is NULL counts as passed."""
    if rule.dimension == "COMPLETENESS":
        return F.col(rule.column).isNull()
    if rule.dimension in ("VALIDITY", "RATIO"):
        bad = ~F.expr(rule.params["condition"])
        return F.coalesce(bad, F.lit(False))
    if rule.dimension == "TIMELINESS":
        hours = int(rule.params.get("cutoff_hours", 12))
        limit = F.col(rule.params["date"]).cast("timestamp_ntz") + F.expr(f"INTERVAL {hours} HOURS")
        return F.coalesce(F.col(rule.column) > limit, F.lit(False))
    raise ValueError(f"{rule.dimension} is not a row-level dimension")


def _row_counts(rule: Rule) -> tuple[Column, Column]:
    if rule.dimension == "FRESHNESS":
        as_of = ts_literal(rule.params["as_of"]) if rule.params.get("as_of") else F.current_timestamp()
        age = units_between("HOUR", F.max(rule.params["timestamp"]), as_of)
        stale = F.coalesce(age > int(rule.params["hours"]), F.lit(True))
        return F.lit(1).cast("long"), F.when(stale, 1).otherwise(0).cast("long")
    scope = _scope(rule)
    return count_where(scope), count_where(scope & failing(rule))


# -- checks with their own grouping ----------------------------------------------
def _uniqueness(df: DataFrame, rule: Rule) -> DataFrame:
    """Surplus copies among rows with a key; per-key counts are combined before the shuffle."""
    per_key = df.where(_scope(rule) & F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_failed"))


def _integrity(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Facts whose key has no row in the dimension; an empty key is a failure too.

    Facts are counted per key and joined with the distinct dimension keys, so
    neither a hot key nor several versions of a member multiply rows.
    """
    key = rule.params["dim_key"]
    per_key = df.where(_scope(rule)).groupBy(F.col(rule.column).alias("_k")).agg(F.count("*").alias("n"))
    members = tables[rule.params["dim"]].where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.lit(True).alias("_hit")).distinct()
    lost = F.when(F.col("_hit").isNull(), F.col("n")).otherwise(0)
    return per_key.join(members, "_k", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"), F.coalesce(F.sum(lost), F.lit(0)).alias("rows_failed")
    )


def _volume(df: DataFrame, rule: Rule) -> DataFrame:
    """Is the newest day below ratio x the mean of the preceding days of record?"""
    day, rows = rule.params["date"], int(rule.params.get("rows", 28))
    daily = df.where(_scope(rule)).groupBy(F.col(day).alias("d")).agg(F.count("*").alias("n"))
    newest = F.row_number().over(Window.orderBy(F.col("d").desc()))
    mean = F.avg("n").over(Window.orderBy("d").rowsBetween(-rows, -1))
    low = F.coalesce(F.col("n") < float(rule.params["ratio"]) * F.col("mean"), F.lit(False))
    last = daily.select("n", mean.alias("mean"), newest.alias("pos")).where("pos = 1")
    return last.agg(F.count("*").alias("rows_checked"), count_where(low).alias("rows_failed"))


def _accuracy(df: DataFrame, rule: Rule) -> DataFrame:
    """Values above mean + sigma * standard deviation."""
    x = F.col(rule.column).cast("double")
    src = df.where(_scope(rule))
    stats = src.agg(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).alias("st"))
    marked = src.select(x.alias("x")).withColumn("st", stats.scalar())
    high = F.coalesce(F.col("x") > F.col("st.m") + float(rule.params.get("sigma", 5)) * F.col("st.s"), F.lit(False))
    return marked.agg(F.count("*").alias("rows_checked"), count_where(high).alias("rows_failed"))


def _consistency(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Grouped totals of two tables that differ by more than the tolerance, or exist on one side only."""
    p = rule.params
    by, other = p["by"], tables[p["other"]]
    a = df.where(_scope(rule)).groupBy(by).agg(F.sum(rule.column).alias("a"))
    b = other.groupBy(F.col(p.get("other_by", by)).alias(by)).agg(F.sum(p["other_column"]).alias("b"))
    gap = F.abs(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0)))
    off = (gap > float(p.get("tolerance", 0.01))) | F.col("a").isNull() | F.col("b").isNull()
    return a.join(b, by, "full_outer").agg(F.count("*").alias("rows_checked"), count_where(off).alias("rows_failed"))


def _schema(df: DataFrame, rule: Rule, spark: SparkSession) -> DataFrame:
    """Columns that differ between the table and its registered column list."""
    expected, actual = set(rule.params["columns"]), set(df.columns)
    return spark.createDataFrame([(len(expected | actual), len(expected ^ actual))], "rows_checked long, rows_failed long")


def _own_plan(rule: Rule, tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    df = tables[rule.table]
    if rule.dimension == "UNIQUENESS":
        return _uniqueness(df, rule)
    if rule.dimension == "INTEGRITY":
        return _integrity(df, rule, tables)
    if rule.dimension == "VOLUME":
        return _volume(df, rule)
    if rule.dimension == "ACCURACY":
        return _accuracy(df, rule)
    if rule.dimension == "CONSISTENCY":
        return _consistency(df, rule, tables)
    if rule.dimension == "SCHEMA":
        return _schema(df, rule, spark)
    raise ValueError(f"unknown dimension {rule.dimension}")


def _labels(rule: Rule) -> list[Column]:
    return [
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.table).alias("table_id"), F.lit(rule.column).cast("string").alias("column_name"),
        F.lit(rule.dimension).alias("dimension"), F.lit(rule.severity).alias("severity"), F.lit(float(rule.max_rate)).alias("max_rate"),
    ]


def _one_pass(df: DataFrame, rules: list[Rule]) -> DataFrame:
    pairs = [_row_counts(rule) for rule in rules]
    measured = df.agg(*[c.alias(f"c{i}") for i, (c, _) in enumerate(pairs)], *[f.alias(f"f{i}") for i, (_, f) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(*_labels(rule), F.col(f"c{i}").alias("rows_checked"), F.col(f"f{i}").alias("rows_failed"))
            for i, rule in enumerate(rules)
        ]
    )
    return measured.select(F.inline(rows))


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """One result row per rule, stored in the shared folder.

    FAIL when the failure rate is above ``max_rate``; no rows checked is rate 1.
    A rule that cannot be planned (missing table or column, unknown dimension) or
    fails while it runs (a bad cast in one row) is an ERROR row and stops no other.
    """
    singles: list[list[Rule]] = []
    broken: list[Rule] = []
    row_rules: dict[str, list[Rule]] = {}
    for rule in rules:
        try:
            _planned([rule], tables, spark)  # analysed, not run
        except (PySparkException, KeyError, ValueError, TypeError):
            broken.append(rule)
        else:
            if rule.dimension in ROW_DIMENSIONS:
                row_rules.setdefault(rule.table, []).append(rule)
            else:
                singles.append([rule])
    # Row-level rules first: one that fails on its rows does not waste the shuffles of the others.
    stored: dict[str, DataFrame] = {}
    done = _run_apart(list(row_rules.values()), tables, spark, broken, rules, stored) + _run_apart(singles, tables, spark, broken, rules, stored)
    if broken:
        rows = [(b.rule_id, b.table, b.column, b.dimension, b.severity, float(b.max_rate), 0, -1) for b in broken]
        done.append(spark.createDataFrame(rows, RESULT_SCHEMA))
    if not done:
        return _judged(spark.createDataFrame([], RESULT_SCHEMA))
    return _judged(reduce(DataFrame.unionByName, done))


def run_rule_table(spark: SparkSession, tables: Mapping[str, DataFrame], rules: DataFrame) -> DataFrame:
    """A run over the active rules of a rules table, table by table."""
    parts = [run_checks(spark, tables, group) for group in load_rules(rules)]
    return reduce(DataFrame.unionByName, parts) if parts else run_checks(spark, tables, [])


def _planned(rules: list[Rule], tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    if rules[0].dimension in ROW_DIMENSIONS:
        return _one_pass(tables[rules[0].table], rules)
    return _own_plan(rules[0], tables, spark).select(*_labels(rules[0]), "rows_checked", "rows_failed")


def _run_apart(
    groups: list[list[Rule]], tables: Mapping[str, DataFrame], spark: SparkSession, broken: list[Rule], rules: list[Rule], stored: dict[str, DataFrame]
) -> list[DataFrame]:
    """Results of groups of rules. All run as one job; if it fails the halves run apart, down to the single rule at fault.

    A table whose rules have to be run apart is stored first, in ``stored``, so
    that neither they nor later rules make its rows anew.
    """
    if not groups:
        return []
    try:
        return [cut_lineage(reduce(DataFrame.unionByName, [_planned(g, tables if g[0].dimension == "SCHEMA" else {**tables, **stored}, spark) for g in groups]))]
    except (PySparkException, Py4JJavaError):
        if len(groups) == 1 and len(groups[0]) == 1:
            broken.append(groups[0][0])
            return []
    if len(groups) == 1:
        _store(groups[0][0].table, tables, spark, rules, stored)
        groups = [[rule] for rule in groups[0]]
    half = len(groups) // 2
    return _run_apart(groups[:half], tables, spark, broken, rules, stored) + _run_apart(groups[half:], tables, spark, broken, rules, stored)


def _store(name: str, tables: Mapping[str, DataFrame], spark: SparkSession, rules: list[Rule], stored: dict[str, DataFrame]) -> None:
    """A table as files in the shared folder, as far as rules mention its columns. One that cannot be stored is made anew by each rule."""
    df = tables[name]
    text = " ".join(str(v) for rule in rules for v in (rule.column, *rule.params.values())).lower()
    if "_metadata" in text or "input_file" in text:
        return
    mentioned = [c for c in df.columns if c.lower() in text] or df.columns[:1]
    path = run_dir(spark, "checked")
    try:
        (df if "*)" in text.replace(" ", "") else df.select(*[F.col(f"`{c}`") for c in mentioned])).write.parquet(path)
    except (PySparkException, Py4JJavaError):
        return
    stored[name] = spark.read.parquet(path)


def _judged(results: DataFrame) -> DataFrame:
    error = F.col("rows_failed") < 0
    rate = F.when(F.col("rows_checked") > 0, F.col("rows_failed") / F.col("rows_checked")).otherwise(1.0)
    return results.withColumn("observed_value", F.when(error, -1).otherwise(half_up(rate, 6)).cast("decimal(12,6)")).withColumn(
        "status", F.when(error, "ERROR").when(rate > F.col("max_rate"), "FAIL").otherwise("PASS")
    )


def failing_rows(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows in the rule's scope that make it fail."""
    src, p = df.where(_scope(rule)), rule.params
    if rule.dimension == "UNIQUENESS":
        surplus = src.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("_copies")).where("_copies > 1")
        return src.join(surplus.select(rule.column), rule.column, "left_semi")
    if rule.dimension == "INTEGRITY":
        members = tables[p["dim"]].select(F.col(p["dim_key"]).alias("_k"))
        return src.join(members, src[rule.column] == F.col("_k"), "left_anti")
    if rule.dimension == "FRESHNESS":
        newest = df.agg(F.max(p["timestamp"]))
        _, stale = _row_counts(rule)
        return df.where((F.col(p["timestamp"]) == newest.scalar()) & (df.agg(stale).scalar() > 0))
    if rule.dimension == "VOLUME":
        newest = src.agg(F.max(p["date"]))
        return src.where((F.col(p["date"]) == newest.scalar()) & (_volume(df, rule).select("rows_failed").scalar() > 0))
    if rule.dimension == "ACCURACY":
        x = F.col(rule.column).cast("double")
        limit = src.agg(F.avg(x) + float(p.get("sigma", 5)) * F.stddev_samp(x))
        return src.where(x > limit.scalar())
    if rule.dimension == "CONSISTENCY":
        by, other = p["by"], tables[p["other"]]
        a = src.groupBy(by).agg(F.sum(rule.column).alias("_a"))
        b = other.groupBy(F.col(p.get("other_by", by)).alias(by)).agg(F.sum(p["other_column"]).alias("_b"))
        off = a.join(b, by, "left").where(F.col("_b").isNull() | F.col("_a").isNull() | (F.abs(F.col("_a") - F.col("_b")) > float(p.get("tolerance", 0.01))))
        return src.join(off.select(by), by, "left_semi")
    return src.where(failing(rule))


def sample_failures(df: DataFrame, rule: Rule, order: list[str], n: int = 5, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Up to n rows that break this very rule, as JSON. ``tables`` holds what integrity and consistency compare with."""
    bad = failing_rows(df, rule, tables).select(*df.columns)
    return bad.orderBy(*order).limit(n).select(F.lit(rule.rule_id).alias("rule_id"), F.to_json(F.struct(*df.columns)).alias("failing_row"))


def stamped(results: DataFrame, run_id: str, as_of_ts: str) -> DataFrame:
    """Result rows ready for the append-only table partitioned by run_date."""
    at = ts_literal(as_of_ts)
    return results.withColumn("run_id", F.lit(run_id)).withColumn("run_timestamp", at).withColumn("run_date", F.to_date(at))


def weight_of(severity: Column) -> Column:
    expr = None
    for name, weight in SEVERITY_WEIGHTS.items():
        expr = F.when(severity == name, weight) if expr is None else expr.when(severity == name, weight)
    return expr.otherwise(OTHER_WEIGHT)


def _score(digits: int = 2) -> Column:
    w = weight_of(F.col("severity"))
    return half_up(100 * (1 - F.try_divide(F.sum(w * F.col("observed_value").cast("double")), F.sum(w))), digits)


def dimension_scores(results: DataFrame) -> DataFrame:
    ran = results.where(F.col("rows_checked") > 0)
    return ran.groupBy("table_id", "dimension").agg(_score().alias("dimension_score"))


def score_tables(results: DataFrame, floor: float = SCORE_FLOOR) -> DataFrame:
    """Weighted score per table with a score per dimension; rules that did not run are left out."""
    ran = results.where(F.col("rows_checked") > 0)
    per_dimension = dimension_scores(results).groupBy("table_id").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("dimension", F.col("dimension_score").cast("decimal(6,2)")))))).alias("by_dimension")
    )
    totals = ran.groupBy("table_id").agg(
        _score().alias("dq_score"),
        F.count("*").alias("checks_run"),
        count_where(F.col("status") == "PASS").alias("checks_passed"),
        count_where(F.col("status") == "FAIL").alias("checks_failed"),
        F.max("rows_checked").alias("table_rows"),
    )
    return totals.join(per_dimension, "table_id").withColumn("anomaly_flag", F.col("dq_score") < floor)


def enterprise_score(scores: DataFrame, certified: DataFrame | None = None) -> DataFrame:
    """Mean of the scores of certified tables weighted by table rows; ``certified(table_id)``, all tables when not given."""
    rows = F.col("table_rows").cast("double")
    counted = scores if certified is None else scores.join(certified.select("table_id").distinct(), "table_id", "left_semi")
    return counted.agg(half_up(F.try_divide(F.sum(F.col("dq_score").cast("double") * rows), F.sum(rows)), 2).alias("enterprise_dq_score"))


def health_rows(scores: DataFrame, products: DataFrame | None, as_of_ts: str, certified: DataFrame | None = None) -> DataFrame:
    """One daily row per table under its product name and one ENTERPRISE row."""
    named = scores if products is None else scores.join(products, "table_id", "left")
    product = F.col("table_id") if products is None else F.coalesce("data_product_name", "table_id")
    at = ts_literal(as_of_ts)
    tables = named.select(
        F.to_date(at).alias("score_date"), product.alias("data_product_name"), "table_id", "dq_score",
        (100 - F.col("dq_score")).alias("weighted_errors"), "checks_run", "checks_passed", "checks_failed", "by_dimension", "anomaly_flag",
    )
    whole = scores.agg(F.sum("checks_run").alias("checks_run"), F.sum("checks_passed").alias("checks_passed"), F.sum("checks_failed").alias("checks_failed"))
    total = whole.withColumn("dq_score", enterprise_score(scores, certified).scalar()).select(
        F.to_date(at).alias("score_date"), F.lit("ENTERPRISE").alias("data_product_name"), F.lit("ENTERPRISE").alias("table_id"), "dq_score",
        (100 - F.col("dq_score")).alias("weighted_errors"), "checks_run", "checks_passed", "checks_failed",
        F.lit(None).cast("string").alias("by_dimension"), (F.col("dq_score") < SCORE_FLOOR).alias("anomaly_flag"),
    )
    return tables.unionByName(total)


def alert_breaches(scores: DataFrame, as_of_ts: str, floor: float = SCORE_FLOOR) -> DataFrame:
    """A HIGH alert per table below the floor."""
    from tidemark.operators.alerts import alert_rows

    low = scores.where("anomaly_flag")
    subject = F.concat(F.lit("DQ score "), F.col("dq_score").cast("decimal(6,2)").cast("string"), F.lit(" on "), F.col("table_id"))
    message = F.concat(F.lit(f"Score below floor {floor}. Dimensions: "), F.col("by_dimension"))
    return alert_rows(low, "DQ", F.lit("HIGH"), subject, message, F.col("table_id"), as_of_ts)


def promotion_gate(results: DataFrame) -> DataFrame:
    """Per table, BLOCK when an ERROR rule failed or could not run."""
    blocking = (F.col("severity") == "ERROR") & F.col("status").isin("FAIL", "ERROR")
    return results.groupBy("table_id").agg(count_where(blocking).alias("blocking_rules")).withColumn(
        "decision", F.when(F.col("blocking_rules") > 0, "BLOCK").otherwise("PUBLISH")
    )


def may_publish(results: DataFrame, table: str) -> bool:
    return promotion_gate(results.where(F.col("table_id") == table)).where(F.col("decision") == "BLOCK").isEmpty()
