"""Incident playbook queries (S01-S22) as short parameterised functions.

They reuse the operators; a date range left out means all days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    bucketed,
    count_where,
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
from tidemark.operators.windows import gmv_by, window_mean

ADJUSTMENTS = ("REFUND", "CHARGEBACK")


def between(day: str, first: str | None, last: str | None) -> Column:
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(day) >= day_literal(first))
    return cond if last is None else cond & (F.col(day) <= day_literal(last))


def definition_gap(txns: DataFrame, digital: Sequence[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """Both GMV definitions of each unit from one scan: all posted, and certified on digital channels."""
    rows = txns.where(is_posted() & between("txn_date", first, last))
    narrow = ~F.col("is_reversal") & F.col("channel_code").isin(*digital)
    return rows.groupBy("bu_code").agg(F.sum("amount_usd").alias("finance_gmv"), sum_where("amount_usd", narrow).alias("retail_gmv"))


def adjustment_bridge(txns: DataFrame, digital: Sequence[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """What separates the two: refunds, chargebacks and other channels, counted and summed."""
    rows = txns.where(is_posted() & between("txn_date", first, last))
    adjusted, elsewhere = F.col("txn_type").isin(*ADJUSTMENTS), ~F.col("channel_code").isin(*digital)
    return rows.groupBy("bu_code").agg(
        count_where(adjusted).alias("adjustments"), sum_where("amount_usd", adjusted).alias("adjusted_amount"),
        count_where(elsewhere).alias("other_channel_txns"), sum_where("amount_usd", elsewhere).alias("other_channel_amount"),
    )


def drop_by_dimension(txns: DataFrame, regions: DataFrame, n: int = 10, first: str | None = None, last: str | None = None) -> DataFrame:
    """The unit x region x channel cells with the most GMV and their share."""
    cells = gmv_by(txns.where(between("txn_date", first, last)), "bu_code", "region_key", "channel_code", out="gmv")
    shares = cells.withColumn("share_pct", percent("gmv", F.sum("gmv").over(Window.partitionBy())))
    return shares.join(regions, "region_key").orderBy(F.col("gmv").desc(), "bu_code", "region_name", "channel_code").limit(n).select(
        "bu_code", "region_name", "channel_code", "gmv", "share_pct"
    )


def volume_or_value(txns: DataFrame) -> DataFrame:
    """Transactions, customers and mean amount per day: fewer sales or smaller ones?"""
    return txns.groupBy("txn_date").agg(
        F.count("*").alias("txn_count"), F.count_distinct("customer_key").alias("customers"), mean_of("amount_usd", 2).alias("avg_txn")
    )


def run_log(runs: DataFrame, names: Sequence[str] = (), tables: Sequence[str] = (), status: str | None = None, first: str | None = None, last: str | None = None, newest: int | None = None) -> DataFrame:
    """Runs by name, table, state and day, optionally only the newest n."""
    rows = runs.where(between("run_date", first, last))
    if names:
        rows = rows.where(F.col("pipeline_name").isin(*names))
    if tables:
        rows = rows.where(F.col("target_table").isin(*tables))
    if status is not None:
        rows = rows.where(F.col("status") == status)
    if newest is not None:
        rows = rows.orderBy(F.col("run_started_at").desc(), F.col("run_id").desc()).limit(newest)
    return rows.select("run_id", "pipeline_name", "target_table", "run_started_at", "run_finished_at", "status", "rows_written", "error_message")


def key_health(rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, empty keys and distinct keys, optionally per batch. Keys are combined before the count."""
    per_key = rows.groupBy(*by, key).agg(F.count("*").alias("n"))
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("staged_rows"), F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0)).alias("null_keys"), F.count(key).alias("distinct_keys")
    )


def spend_by_user(cost: DataFrame, n: int = 10, first: str | None = None, last: str | None = None) -> DataFrame:
    """The users who cost most."""
    sums = cost.where(between("job_date", first, last)).groupBy("user_email").agg(
        F.sum("cost_usd").alias("c"), half_up(F.sum("bytes_processed") / 1e12, 3).alias("tb_processed"), F.count("*").alias("queries")
    )
    return sums.orderBy(F.col("c").desc(), "user_email").limit(n).select("user_email", half_up("c", 2).alias("cost_usd"), "tb_processed", "queries")


def jobs_of_user(cost: DataFrame, user: str, n: int = 10) -> DataFrame:
    """A user's most expensive jobs."""
    mine = cost.where(F.col("user_email") == user).orderBy(F.col("cost_usd").desc(), "job_id").limit(n)
    return mine.select("job_id", half_up(F.col("bytes_processed") / 1e9, 2).alias("gb"), half_up("cost_usd", 2).alias("cost"), "table_reference", "query_labels")


def cache_share(cost: DataFrame, by: str = "user_email") -> DataFrame:
    """Cached and all jobs."""
    hit = count_where(F.col("cache_hit"))
    return cost.groupBy(by).agg(hit.alias("cached"), F.count("*").alias("total"), percent(hit, F.count("*"), 1).alias("cache_pct"))


def repeated_keys(txns: DataFrame) -> DataFrame:
    """Transaction ids seen more than once on a day."""
    return txns.groupBy("txn_id", "txn_date").agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def inflated_amount(txns: DataFrame) -> DataFrame:
    """Rows and amount behind repeated ids, from per-id sums instead of a join back."""
    per_key = txns.groupBy("txn_id", "txn_date").agg(F.count("*").alias("n"), F.sum("amount_usd").alias("s")).where("n > 1")
    return per_key.groupBy("txn_date").agg(F.sum("n").alias("dup_txns"), F.sum("s").alias("inflated_amount"))


def duplicate_batches(txns: DataFrame) -> DataFrame:
    """Load batches that wrote repeated ids."""
    return txns.join(repeated_keys(txns), ["txn_id", "txn_date"], "left_semi").groupBy("etl_batch_id").agg(F.count("*").alias("row_count"))


def segment_counts(customers: DataFrame) -> DataFrame:
    """Current customers by segment."""
    return customers.where("is_current").groupBy("customer_segment").agg(F.count("*").alias("n"))


def edges_into(edges: DataFrame, pattern: str) -> DataFrame:
    """Lineage edges into tables of a name pattern."""
    return edges.where(F.col("target_table").like(pattern)).select("source_table", "source_column", "target_table", "target_column")


def catalog_lookup(catalog: DataFrame, pattern: str) -> DataFrame:
    """Rows and bytes of tables of a name pattern."""
    return catalog.where(F.col("table_name").like(pattern)).select("table_name", "row_count", "size_bytes")


def attainment(cases: DataFrame) -> DataFrame:
    """Closed or resolved in time, by priority."""
    met = count_where(F.col("status").isin("CLOSED", "RESOLVED") & (F.col("resolved_at") <= F.col("sla_due_at")))
    return cases.groupBy("priority").agg(F.count("*").alias("total"), met.alias("met_sla"), percent(met, F.count("*"), 1).alias("attainment_pct"))


def open_age(cases: DataFrame, as_of_ts: str, buckets: Sequence[tuple[int, str]] = ((1, "0-1d"), (3, "1-3d")), rest: str = "3+d") -> DataFrame:
    """Open cases per age."""
    age = units_between("DAY", "opened_at", ts_literal(as_of_ts))
    label = bucketed("opened_at", [(age < top, name) for top, name in buckets], rest)
    return cases.where(F.col("status").isin("OPEN", "IN_PROGRESS")).groupBy(label.alias("age_bucket")).agg(F.count("*").alias("open_cases"))


def board_number(cases: DataFrame) -> DataFrame:
    """The board's narrower formula, which leaves resolved cases out. Kept for the comparison only."""
    return cases.agg(percent(count_where((F.col("status") == "CLOSED") & (F.col("resolved_at") <= F.col("sla_due_at"))), F.count("*"), 1).alias("board_number"))


def late_by_day(txns: DataFrame, days: int = 3) -> DataFrame:
    """Days with rows loaded more than ``days`` days late."""
    late = F.datediff(F.to_date("etl_loaded_at"), F.col("txn_date"))
    return txns.groupBy("txn_date").agg(
        F.max(F.to_date("etl_loaded_at")).alias("last_load"), F.max(late).alias("max_late_days"), count_where(late > days).alias("late_rows")
    ).where("late_rows > 0")


def late_by_source(txns: DataFrame, days: int = 3) -> DataFrame:
    """Late rows and their amount by source and type."""
    late = F.datediff(F.to_date("etl_loaded_at"), F.col("txn_date")) > days
    return txns.where(late).groupBy("source_system", "txn_type").agg(F.count("*").alias("n"), F.sum("amount_usd").alias("amt"))


def as_of_split(txns: DataFrame, frozen_after_days: int) -> DataFrame:
    """Rows a report frozen some days after the business day would hold, and those arriving later."""
    seen = F.to_date("etl_loaded_at") <= F.date_add("txn_date", frozen_after_days)
    return txns.groupBy("txn_date").agg(count_where(seen).alias("rows_in_report"), count_where(~seen).alias("rows_after_report"))


def cases_by_day(cases: DataFrame) -> DataFrame:
    """Cases per day and type."""
    return cases.groupBy("opened_date", "case_type").agg(F.count("*").alias("cases"))


def event_bursts(events: DataFrame, more_than: int = 500) -> DataFrame:
    """Day, type and source with more events than the limit."""
    return events.groupBy("event_date", "event_type", "source_system").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def affected_customers(cases: DataFrame, case_type: str = "BILLING") -> DataFrame:
    """Customers with cases per day and the share of one type."""
    return cases.groupBy("opened_date").agg(
        F.count_distinct("customer_key").alias("affected_customers"), percent(count_where(F.col("case_type") == case_type), F.count("*"), 1).alias("type_share")
    )


def product_sales(txns: DataFrame, products: DataFrame, product_id: str | None = None) -> DataFrame:
    """Daily posted sales and units of products."""
    current = products.where("is_current")
    if product_id is not None:
        current = current.where(F.col("product_id") == product_id)
    sales = txns.where(is_posted()).groupBy("txn_date", "product_key").agg(F.sum("amount_usd").alias("sales"), F.count("*").alias("units"))
    return sales.join(current.select("product_key", "product_id"), "product_key").select("txn_date", "product_id", "sales", "units")


def receipts_by_warehouse(receipts: DataFrame) -> DataFrame:
    """Units and empty receipts by day and warehouse."""
    return receipts.groupBy("received_date", "warehouse_code").agg(F.sum("quantity").alias("receipts"), count_where(F.col("quantity") == 0).alias("zero_receipts"))


def last_receipts(receipts: DataFrame, as_of: str) -> DataFrame:
    """Mean receipt and days since the last one by product and warehouse."""
    last = F.max("received_date")
    return receipts.groupBy("product_key", "warehouse_code").agg(
        mean_of("quantity", 2).alias("avg_receipt"), last.alias("last_receipt"), F.datediff(day_literal(as_of), last).alias("days_since_last_receipt")
    )


def query_cost_of(cost: DataFrame) -> DataFrame:
    """Cost, terabytes, mean seconds and runs of each query."""
    return cost.groupBy("query_id").agg(
        half_up(F.sum("cost_usd"), 2).alias("cost"), half_up(F.sum("bytes_processed") / 1e12, 2).alias("tb"),
        half_up(F.try_divide(F.sum("total_slot_ms").cast("double"), F.count("*").cast("double")) / 1000, 1).alias("avg_sec"), F.count("*").alias("runs"),
    )


def jobs_of_query(cost: DataFrame, query_id: str) -> DataFrame:
    """The jobs of one query."""
    return cost.where(F.col("query_id") == query_id).select(
        "job_id", half_up(F.col("bytes_processed") / 1e9, 2).alias("gb"), half_up("cost_usd", 2).alias("cost"), "table_reference"
    )


def null_share_by_load(customers: DataFrame, column: str = "email", rows: int = 14) -> DataFrame:
    """NULL share per load day against the preceding loads."""
    daily = customers.groupBy(F.to_date("etl_loaded_at").alias("load_date")).agg(percent(count_where(F.col(column).isNull()), F.count("*")).alias("null_pct"))
    return daily.withColumn("baseline", window_mean("null_pct", Window.orderBy("load_date").rowsBetween(-rows, -1), 4))


def null_hot_spots(customers: DataFrame, column: str = "email", n: int = 10) -> DataFrame:
    """Segments and countries with most empty values."""
    missing = count_where(F.col(column).isNull())
    spots = customers.where("is_current").groupBy("customer_segment", "country_code").agg(missing.alias("null_values"), F.count("*").alias("n"))
    return spots.where("null_values > 0").orderBy(F.col("null_values").desc(), "customer_segment", "country_code").limit(n)


def event_volume(events: DataFrame, rows: int = 28) -> DataFrame:
    """Daily events against the mean of the preceding days."""
    daily = events.groupBy("event_date").agg(F.count("*").alias("events"))
    w = Window.orderBy("event_date").rowsBetween(-rows, -1)
    return daily.select("event_date", "events", window_mean("events", w, 4).alias("baseline"), ratio(F.col("events"), F.avg("events").over(w), 3).alias("volume_ratio"))


def events_by_source(events: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events per source."""
    return events.where(between("event_date", first, last)).groupBy("source_system").agg(F.count("*").alias("events"))


def margin_below(products: DataFrame, limit: float = 0.0) -> DataFrame:
    """Current products selling below a margin."""
    return products.where(F.col("is_current") & (F.col("margin_pct") < limit)).select("product_id", "product_category", "list_price", "margin_pct")


def current_version_misuse(txns: DataFrame, products: DataFrame) -> DataFrame:
    """The margin the current version gives against the margin valid at sale time, per category."""
    versions = products.select("product_key", "product_category", "margin_pct", "valid_from", "valid_to", "is_current")
    sold = txns.where(is_posted()).groupBy("product_key", "txn_timestamp").agg(F.sum("amount_usd").alias("s"))
    valid = (F.col("txn_timestamp") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("txn_timestamp") < F.col("valid_to")))
    money = (F.col("s") * F.col("margin_pct")).cast("decimal(38,6)")
    paired = sold.join(versions, "product_key").groupBy("product_category").agg(
        half_up(F.coalesce(F.sum(F.when(F.col("is_current"), money)), F.lit(0)), 2).alias("margin_used"),
        half_up(F.coalesce(F.sum(F.when(valid, money)), F.lit(0)), 2).alias("margin_then"),
    )
    return paired


def failing_rules(results: DataFrame, n: int = 15) -> DataFrame:
    """The rules failing most."""
    counts = results.where(F.col("status") == "FAIL").groupBy("rule_id", "table_id").agg(F.count("*").alias("failures"))
    return counts.orderBy(F.col("failures").desc(), "rule_id", "table_id").limit(n)


def rule_history(results: DataFrame, rule_id: str) -> DataFrame:
    """The results of one rule."""
    return results.where(F.col("rule_id") == rule_id).select("run_id", "run_date", "observed_value", "expected_value", "rows_checked", "rows_failed")


def ack_rate(alerts: DataFrame) -> DataFrame:
    """Acknowledged share of the alerts by type."""
    acked = count_where(F.col("acknowledged_at").isNotNull())
    return alerts.groupBy("alert_type").agg(F.count("*").alias("alerts"), acked.alias("acked"), percent(acked, F.count("*"), 0).alias("ack_pct"))


def view_counts(activity: DataFrame, app: str, pattern: str) -> DataFrame:
    """Last view and views of dashboards of a name pattern."""
    rows = activity.where((F.col("app_name") == app) & F.col("resource_name").like(pattern))
    return rows.groupBy("resource_name").agg(F.max("activity_date").alias("last_viewed"), count_where(F.col("activity_type") == "DASHBOARD_VIEW").alias("views"))


def extract_gap(certified: DataFrame, extract: DataFrame, day: str, certified_value: str, extract_value: str) -> DataFrame:
    """Certified total per day beside what an extract holds."""
    a = certified.groupBy(day).agg(F.sum(certified_value).alias("certified"))
    b = extract.groupBy(day).agg(F.sum(extract_value).alias("extract_total"))
    return b.join(a, day, "left").select(day, "certified", "extract_total", (F.coalesce("certified", F.lit(0)) - F.col("extract_total")).alias("gap"))


def weekly_usage(activity: DataFrame) -> DataFrame:
    """Weekly users, queries and views."""
    kind = F.col("activity_type")
    return activity.groupBy(week_monday("activity_date").alias("week_start")).agg(
        F.count_distinct("employee_key").alias("active_users"), count_where(kind == "QUERY").alias("queries"), count_where(kind == "DASHBOARD_VIEW").alias("views")
    )


def usage_by_department(activity: DataFrame, employees: DataFrame) -> DataFrame:
    """Users and queries per department; activity is combined per person before the join."""
    per_person = activity.groupBy("employee_key").agg(count_where(F.col("activity_type") == "QUERY").alias("q"))
    return per_person.join(employees.select("employee_key", "department"), "employee_key").groupBy("department").agg(
        F.count("*").alias("users"), F.sum("q").alias("queries")
    )


def chargeback_rate(txns: DataFrame) -> DataFrame:
    """Chargebacks per sale and day. A sale is a payment; POSTED is a status, not a type."""
    cb, sales = count_where(F.col("txn_type") == "CHARGEBACK"), count_where((F.col("txn_type") == "PAYMENT") & is_posted())
    return txns.groupBy("txn_date").agg(cb.alias("chargebacks"), sales.alias("sales"), percent(cb, sales).alias("chargeback_rate"))


def chargeback_cells(txns: DataFrame, products: DataFrame, regions: DataFrame, more_than: int = 50, n: int | None = 10) -> DataFrame:
    """Category x region x channel with most chargebacks."""
    cb = txns.where(F.col("txn_type") == "CHARGEBACK").groupBy("product_key", "region_key", "channel_code").agg(F.count("*").alias("k"), F.sum("amount_usd").alias("s"))
    named = cb.join(products.where("is_current").select("product_key", "product_category"), "product_key").join(regions, "region_key")
    cells = named.groupBy("product_category", "region_name", "channel_code").agg(F.sum("k").alias("cbs"), F.sum("s").alias("cb_amount")).where(F.col("cbs") > more_than)
    return cells if n is None else cells.orderBy(F.col("cbs").desc(), "product_category", "region_name", "channel_code").limit(n)


def events_of_type(events: DataFrame, event_type: str) -> DataFrame:
    """Daily events of one type."""
    return events.where(F.col("event_type") == event_type).groupBy("event_date", "event_type").agg(F.count("*").alias("n"))


def implied_rate(txns: DataFrame, amount: str = "amount") -> DataFrame:
    """Converted over local amount by currency."""
    return txns.where(is_posted()).groupBy("currency_code").agg(
        F.count("*").alias("txns"), F.sum(amount).alias("local_amount"), F.sum("amount_usd").alias("usd_amount"), ratio(F.sum("amount_usd"), F.sum(amount), 6).alias("implied_rate")
    )


def rate_spread(txns: DataFrame) -> DataFrame:
    """Lowest, highest and number of rates per day and currency."""
    return txns.groupBy("txn_date", "currency_code").agg(
        F.min("fx_rate").alias("min_rate"), F.max("fx_rate").alias("max_rate"), F.count_distinct("fx_rate").alias("distinct_rates")
    )


def corrected_total(txns: DataFrame, currency: str, rate: str, amount: str = "amount") -> DataFrame:
    """Reported and corrected total of one currency."""
    right = F.sum(amount) * F.lit(rate).cast("decimal(8,4)")
    return txns.where((F.col("currency_code") == currency) & is_posted()).agg(
        F.sum("amount_usd").alias("reported_usd"), half_up(right, 2).alias("corrected_usd"), half_up(right - F.sum("amount_usd"), 2).alias("gap")
    )


def orphan_amount(txns: DataFrame, customers: DataFrame, key: str = "customer_key") -> DataFrame:
    """Facts without a customer and their amount."""
    per_key = txns.groupBy(key).agg(F.count("*").alias("n"), F.sum("amount_usd").alias("s"))
    return per_key.join(customers.select(F.col("customer_key").alias(key)), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_txns"), F.coalesce(F.sum("s"), F.lit(0)).alias("orphan_amount")
    )


def orphans_by_day(txns: DataFrame, customers: DataFrame, key: str = "customer_key") -> DataFrame:
    """Facts without a customer per day, zero where there is none."""
    known = customers.select(F.col("customer_key").alias(key), F.lit(1).alias("_hit")).distinct()
    per_key = txns.groupBy("txn_date", key).agg(F.count("*").alias("n"))
    lost = F.when(F.col("_hit").isNull(), F.col("n")).otherwise(0)
    return per_key.join(known, key, "left").groupBy("txn_date").agg(F.sum(lost).alias("orphans"))
