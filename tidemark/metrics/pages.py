"""Computations behind the application pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, counts_as_revenue, day_literal, half_up, is_posted, mean_of, percent, ratio, sum_where
from tidemark.operators.windows import top_n

# Fixed values of the upload check.
KEY_COLUMNS = ("txn_id", "id", "case_id")
UPLOAD_STATES = ("POSTED", "PENDING", "FAILED", "SUCCESS", "CLOSED", "OPEN")
OUTLIER_LIMIT = 50_000
FIRST_ISSUES = 60


def _issue(cond: Column, severity: str, category: str, column: str | None, message: Column) -> Column:
    entry = F.struct(
        F.lit(severity).alias("severity"), F.lit(category).alias("category"), F.lit(column).cast("string").alias("column_name"), message.alias("message")
    )
    return F.when(F.coalesce(cond, F.lit(False)), entry)


def validate_rows(rows: DataFrame, known: Sequence[str], required: Sequence[str], row_no: str = "row_no") -> DataFrame:
    """A4: every issue of an upload whose cells are text, one row per issue.

    Schema issues carry row 1. Cell checks are one array per row, exploded; key
    duplicates come from per-key counts, so a repeated key is one row until its
    copies are marked.
    """
    cells = [c for c in rows.columns if c != row_no]
    spark = rows.sparkSession
    unknown = [(1, "error", "SCHEMA", c, f'Unknown column "{c}".') for c in cells if c.lower() not in {k.lower() for k in known}]
    layout = "row_no long, severity string, category string, column_name string, message string"
    schema_issues = spark.createDataFrame(unknown, layout)

    def blank(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c), F.lit(""))) == ""

    checks = [_issue(blank(c), "error", "MISSING_VALUE", c, F.lit(f"Missing required value in {c}.")) for c in cells if c in required]
    amount = next((c for c in cells if c.lower() in ("amount_usd", "amount")), None)
    if amount:
        value = F.expr(f"try_cast(`{amount}` AS DOUBLE)")
        texts = F.array(*[F.col(c) for c in cells])
        signed = F.array_contains(texts, "REFUND") | F.array_contains(texts, "CHARGEBACK")
        checks.append(_issue((value < 0) & ~F.coalesce(signed, F.lit(False)), "error", "BUSINESS_RULE", amount, F.lit("Negative amount without REFUND/CHARGEBACK type.")))
        if "status" in cells:
            state = F.upper("status")
            bad = (state != "") & ~state.isin(*UPLOAD_STATES)
            checks.append(_issue(bad, "error", "BUSINESS_RULE", "status", F.concat(F.lit("Invalid status "), state)))
    for c in cells:
        if c.lower() in ("amount_usd", "amount", "list_price"):
            far = F.abs(F.expr(f"try_cast(`{c}` AS DOUBLE)")) > OUTLIER_LIMIT
            checks.append(_issue(far, "warning", "OUTLIER", c, F.concat(F.lit("Suspicious value "), F.col(c))))
    found = [schema_issues]
    if checks:
        listed = rows.select(F.col(row_no).alias("row_no"), F.explode(F.array_compact(F.array(*checks))).alias("i"))
        found.append(listed.select("row_no", "i.*"))
    key = next((c for c in cells if c.lower() in KEY_COLUMNS), None)
    if key:
        repeated = rows.groupBy(key).agg(F.min(row_no).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
        copies = rows.select(F.col(row_no).alias("row_no"), key).join(repeated, key).where(F.col("row_no") > F.col("_first"))
        text = F.concat(F.lit("Duplicate key "), F.col(key), F.lit(" (also row "), F.col("_first").cast("string"), F.lit(")."))
        found.append(copies.select("row_no", F.lit("warning").alias("severity"), F.lit("DUPLICATE").alias("category"), F.lit(None).cast("string").alias("column_name"), text.alias("message")))
    return reduce(DataFrame.unionByName, found)


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("category", "severity").agg(F.count("*").alias("issues"))


def first_issues(issues: DataFrame, n: int = FIRST_ISSUES) -> DataFrame:
    return issues.orderBy("row_no", "category", "column_name", "message").limit(n)


def match_score(text: Column, query: str) -> Column:
    """100 equal, 80 prefix, 60 contained, else 45 x the share of query words found."""
    low, q = F.lower(text), query.strip().lower()
    words = q.split()
    hits = reduce(lambda a, b: a + b, [low.contains(w).cast("int") for w in words])
    score = F.when(low == q, 100.0).when(low.startswith(q), 80.0).when(low.contains(q), 60.0).otherwise(hits / len(words) * 45)
    return F.coalesce(score, F.lit(0.0))


def catalog_search(entries: DataFrame, query: str, n: int = 40) -> DataFrame:
    """A5: the n best entries. ``entries`` has kind, title, fields (texts) and weight."""
    if not query.strip():
        return entries.select("kind", "title", F.lit(0.0).alias("score")).limit(0)
    best = F.array_max(F.transform("fields", lambda f: match_score(f, query))) * F.col("weight")
    scored = entries.select("kind", "title", half_up(best, 4).alias("score")).where("score > 0")
    return scored.orderBy(F.col("score").desc(), "kind", "title").limit(n)


def cost_insights(cost: DataFrame, as_of: str) -> DataFrame:
    """30-day total and mean, the mean of the 23 days before the last 7, and the last week's overrun."""
    today = day_literal(as_of)
    age = F.datediff(today, F.col("job_date"))
    window = cost.where(age.between(0, 29))
    total, week = F.sum("cost_usd"), sum_where("cost_usd", age < 7)
    base = sum_where("cost_usd", age >= 7).cast("double") / 23
    return window.agg(
        half_up(total, 2).alias("total_30d"), half_up(total.cast("double") / 30, 2).alias("avg_daily"),
        half_up(base, 2).alias("baseline"), half_up(week.cast("double") - base * 7, 2).alias("overrun"),
    )


def cost_breakdown(cost: DataFrame) -> DataFrame:
    """Cost by user, dataset and team under one layout, from one pre-aggregation."""
    fine = cost.groupBy("user_email", "dataset_id", "query_labels").agg(F.sum("cost_usd").alias("c"))
    labelled = fine.withColumn("team", F.from_json("query_labels", "team STRING")["team"])
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("label")) for k, c in (("user", "user_email"), ("dataset", "dataset_id"), ("team", "team"))])
    return labelled.select(F.explode(kinds).alias("k"), "c").groupBy("k.kind", "k.label").agg(half_up(F.sum("c"), 2).alias("cost_usd"))


def run_status(runs: DataFrame, last: int = 7) -> DataFrame:
    """State, success share and history of each job's newest runs."""
    newest = top_n(runs, ["pipeline_name"], [F.col("run_started_at").desc(), F.col("run_id").desc()], last)
    failed = F.max((F.col("status") == "FAILED").cast("int")) == 1
    history = F.sort_array(F.collect_list(F.struct(F.col("rn"), F.col("status"), F.col("rows_written"))), asc=False)
    recent = newest.groupBy("pipeline_name").agg(
        F.when(failed, "DEGRADED").otherwise("HEALTHY").alias("job_state"),
        percent(count_where(F.col("status") == "SUCCESS"), F.count("*"), 0).alias("success_rate"),
        history.alias("history"),
    )
    return recent.join(runs.groupBy("pipeline_name").agg(F.count("*").alias("runs")), "pipeline_name")


def _page_rows(txns: DataFrame, as_of: str, days: int | None, bu: str | None, region: str | None) -> DataFrame:
    if days is not None:
        txns = txns.where(F.col("txn_date").between(F.date_sub(day_literal(as_of), days - 1), day_literal(as_of)))
    if bu is not None:
        txns = txns.where(F.col("bu_code") == bu)
    return txns if region is None else txns.where(F.col("region_name") == region)


def executive_kpis(txns: DataFrame, products: DataFrame, events: DataFrame, cases: DataFrame, health: DataFrame, cost: DataFrame, as_of: str, events_as_of: str, days: int | None) -> DataFrame:
    """The executive page in one row. Net is revenue less refunds and chargebacks; a terabyte is 1024 gigabytes."""
    rows = _page_rows(txns, as_of, days, None, None)
    revenue = counts_as_revenue()
    money = rows.agg(
        sum_where("amount_usd", revenue).alias("gmv"),
        F.abs(sum_where("amount_usd", F.col("txn_type") == "REFUND")).alias("refunds"),
        F.abs(sum_where("amount_usd", F.col("txn_type") == "CHARGEBACK")).alias("cb"),
        F.count_distinct(F.when(is_posted(), F.col("customer_key"))).alias("active_customers"),
        count_where(is_posted()).alias("posted"),
    )
    profit = rows.where(revenue).groupBy("product_key").agg(F.sum("amount_usd").alias("s")).join(products.where("is_current"), "product_key").agg(
        F.coalesce(F.sum((F.col("s") * F.col("margin_pct")).cast("decimal(38,6)")), F.lit(0)).alias("p")
    )
    week = events.where(F.col("event_date").between(F.date_sub(day_literal(events_as_of), 6), day_literal(events_as_of)))
    errors = week.agg(percent(count_where(F.col("status") == "FAILURE"), F.count("*")))
    in_days = (lambda c: F.lit(True)) if days is None else (lambda c: F.col(c) > F.date_sub(day_literal(as_of), days))
    sla = cases.where(in_days("opened_date")).agg(percent(count_where(F.col("resolved_at") <= F.col("sla_due_at")), F.count("*")))
    latest = health.where(F.col("score_date") == health.agg(F.max("score_date")).scalar()).agg(mean_of("dq_score", 2))
    spend = cost.where(in_days("job_date")).agg(ratio(F.sum("cost_usd"), F.sum("bytes_processed") / (1024 * 1e9), 4))
    return money.select(
        F.col("gmv"), (F.col("gmv") - F.col("refunds") - F.col("cb")).alias("net"), percent(profit.scalar(), "gmv").alias("margin_pct"),
        "active_customers", ratio("gmv", "posted", 2).alias("aov"), errors.scalar().alias("error_rate_pct"), sla.scalar().alias("sla_pct"),
        latest.scalar().alias("dq_score"), spend.scalar().alias("cost_per_tb"),
    )


def bu_breakdown(txns: DataFrame, products: DataFrame, as_of: str, days: int | None = 60, bu: str | None = None, region: str | None = None) -> DataFrame:
    """Revenue, orders, customers, order value, margin and share of each business unit."""
    rows = _page_rows(txns, as_of, days, bu, region)
    fine = rows.groupBy("bu_code", "customer_key", "product_key").agg(
        sum_where("amount_usd", counts_as_revenue()).alias("s"), count_where(counts_as_revenue()).alias("n"), count_where(is_posted()).alias("posted")
    )
    margins = products.where("is_current").select("product_key", "margin_pct")
    table = fine.join(margins, "product_key", "left").groupBy("bu_code").agg(
        F.sum("s").alias("gmv"), F.sum("n").alias("orders"), F.count_distinct(F.when(F.col("posted") > 0, F.col("customer_key"))).alias("active"),
        ratio(F.sum("s"), F.sum("n"), 2).alias("aov"), percent(F.sum((F.col("s") * F.col("margin_pct")).cast("decimal(38,6)")), F.sum("s")).alias("margin_pct"),
    )
    return table.withColumn("share_pct", percent("gmv", F.sum("gmv").over(Window.partitionBy()), 1))


def revenue_mix(txns: DataFrame, products: DataFrame, as_of: str, days: int | None = 60) -> DataFrame:
    """Revenue by category, channel and region under one layout, from one pre-aggregation."""
    rows = _page_rows(txns, as_of, days, None, None).where(counts_as_revenue())
    fine = rows.groupBy("product_key", "channel_code", "region_name").agg(F.sum("amount_usd").alias("s"))
    named = fine.join(products.where("is_current").select("product_key", "product_category"), "product_key", "left")
    mixes = F.array(*[F.struct(F.lit(k).alias("mix"), F.col(c).alias("label")) for k, c in (("category", "product_category"), ("channel", "channel_code"), ("region", "region_name"))])
    return named.select(F.explode(mixes).alias("m"), "s").groupBy("m.mix", "m.label").agg(F.sum("s").alias("gmv"))


def quality_summary(health: DataFrame) -> DataFrame:
    """A10: the latest day's mean score and failed-check rate."""
    latest = health.where(F.col("score_date") == health.agg(F.max("score_date")).scalar())
    return latest.agg(
        mean_of("dq_score", 2).alias("enterprise_score"), F.sum("checks_run").alias("checks_run"), F.sum("checks_failed").alias("checks_failed"),
        percent(F.sum("checks_failed"), F.sum("checks_run")).alias("failed_check_pct"),
    )


def cost_page(cost: DataFrame, watched_user: str, since: str) -> DataFrame:
    """Total, cost per terabyte, cache share and the watched user's cost since a day."""
    watched = (F.col("user_email") == watched_user) & (F.col("job_date") >= day_literal(since))
    return cost.agg(
        half_up(F.sum("cost_usd"), 2).alias("total_cost"), ratio(F.sum("cost_usd"), F.sum("bytes_processed") / (1024 * 1e9), 4).alias("cost_per_tb"),
        percent(count_where(F.col("cache_hit")), F.count("*")).alias("cache_rate"), half_up(sum_where("cost_usd", watched), 2).alias("runaway_cost"),
    )


def sheet_gmv(overview: DataFrame) -> DataFrame:
    """GMV by day and business unit."""
    return overview.groupBy("metric_date", "bu_name").agg(F.sum("gmv_usd").alias("gmv_usd"))


def sheet_days(overview: DataFrame) -> DataFrame:
    """Customers, mean quality and cost per day.

    Quality and cost are values of the day, repeated on every row of V2, so each is taken once.
    """
    return overview.groupBy("metric_date").agg(
        F.sum("active_customers").alias("active_customers"), F.max("dq_score").alias("dq_score"), F.max("cost_usd").alias("cost_usd")
    )
