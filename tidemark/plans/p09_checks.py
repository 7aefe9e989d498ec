"""Data-quality pattern queries Q096-Q105."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import checks as K
from tidemark.operators.windows import gmv_by
from tidemark.plans.p01_windows import GMV
from tidemark.plans.registry import ORDERS_AS_OF, div, pct, query, r


@query(
    "q096_completeness",
    f"SELECT {pct('count(*) - count(customer_ref)', 'count(*)', 4)} AS customer_ref_null_pct, {pct('count(*) - count(txn_timestamp)', 'count(*)', 4)} AS txn_timestamp_null_pct FROM txn_gaps",
)
def _(t):
    return K.completeness(t.txn_gaps, ["customer_ref", "txn_timestamp"])


@query("q097_duplicates", "SELECT txn_id, count(*) AS dup_count FROM txn_core GROUP BY txn_id HAVING count(*) > 1")
def _(t):
    return K.duplicates(t.txn_core, ["txn_id"])


@query(
    "q098_validity",
    """SELECT count(*) FILTER (txn_type = 'CHARGEBACK') AS invalid_txn_types, count(*) FILTER (length(currency_code) <> 3) AS invalid_currencies,
       count(*) FILTER (amount_usd < 0 AND txn_type NOT IN ('REFUND', 'CHARGEBACK')) AS negative_non_refund FROM transactions""",
)
def _(t):
    return K.validity(t.transactions, ["PAYMENT", "REFUND"])


@query(
    "q099_orphans",
    "SELECT 'active_customer' AS fk_name, count(*) AS orphan_rows FROM txn_core t WHERE NOT EXISTS (FROM dim_customer c WHERE c.is_active AND c.customer_key = t.customer_key)",
)
def _(t):
    return K.orphans(t.txn_core, t.dim_customer.where("is_active"), "customer_key", "customer_key", "active_customer")


@query(
    "q100_staleness",
    f"""SELECT max(txn_date) AS newest_day, date_diff('day', max(txn_date), DATE '{ORDERS_AS_OF}' + 3)::INT AS days_stale,
        if(date_diff('day', max(txn_date), DATE '{ORDERS_AS_OF}' + 3) > 1, 'STALE', 'OK') AS state FROM txn_core""",
)
def _(t):
    return K.staleness(t.txn_core, "txn_date", "2001-08-04")


@query(
    "q101_volume_delta",
    f"""WITH d AS (SELECT txn_date, count(*) AS row_count FROM txn_core GROUP BY txn_date), l AS (SELECT *, lag(row_count) OVER (ORDER BY txn_date) AS prior_day FROM d)
        SELECT *, {div('row_count - prior_day', 'prior_day')} AS pct_change FROM l ORDER BY txn_date DESC LIMIT 10""",
)
def _(t):
    return K.volume_delta(t.txn_core, "txn_date")


@query(
    "q102_zscore_outliers",
    f"""WITH s AS (SELECT round(CAST(avg(amount_usd::DOUBLE) AS DECIMAL(28,8)), 6) AS m, round(CAST(stddev_samp(amount_usd::DOUBLE) AS DECIMAL(28,8)), 6) AS sd FROM txn_core)
        SELECT txn_no, amount_usd::DOUBLE AS amount_usd, {r('m', 4)} AS mean_value, {div('abs(amount_usd - m)', 'sd', 2)} AS z_score FROM txn_core, s WHERE amount_usd > m + 1.5 * sd""",
)
def _(t):
    return K.zscore_outliers(t.txn_core, "amount_usd", ["txn_no"], 1.5)


@query(
    "q103_fact_vs_kpi",
    f"""SELECT (SELECT sum(amount_usd) FROM txn_core WHERE {GMV})::DOUBLE AS fact_total,
        (SELECT sum(amount_usd) FROM transactions WHERE {GMV} AND txn_date < DATE '{ORDERS_AS_OF}')::DOUBLE AS kpi_total""",
)
def _(t):
    kpis = gmv_by(t.transactions.where(F.col("txn_date") < ORDERS_AS_OF), "txn_date", "bu_code")
    return K.fact_vs_kpi(t.txn_core, kpis)


@query(
    "q104_null_spike",
    f"""WITH d AS (SELECT txn_date, round(CAST(100 * (count(*) - count(customer_ref))::DOUBLE / count(*) AS DECIMAL(28,8)), 4) AS n FROM txn_gaps GROUP BY txn_date),
        b AS (SELECT txn_date, n, round(CAST((sum(n) OVER w)::DOUBLE / nullif(count(n) OVER w, 0) AS DECIMAL(28,8)), 4) AS a FROM d WINDOW w AS (ORDER BY txn_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
        SELECT txn_date, n::DOUBLE AS null_rate, a::DOUBLE AS trailing_avg, if(n > 2 * a AND a > 0, 'NULL_SPIKE', 'OK') AS flag FROM b""",
)
def _(t):
    return K.null_spike(t.txn_gaps, "txn_date", "customer_ref")


@query("q105_late_rows", "SELECT count(*) FILTER (etl_loaded_at > txn_date::TIMESTAMP + INTERVAL 12 HOUR) AS late_rows, count(*) AS total_rows FROM txn_core")
def _(t):
    return K.late_rows(t.txn_core, "etl_loaded_at", "txn_date", 12)
