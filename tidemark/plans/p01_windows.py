"""Window queries Q001-Q018."""

from __future__ import annotations

from tidemark.functions import is_posted
from tidemark.operators import windows as W
from tidemark.plans.registry import div, query, r

GMV = "status = 'POSTED' AND NOT is_reversal"
DAILY = f"daily AS (SELECT txn_date, sum(amount_usd) AS g FROM txn_core WHERE {GMV} GROUP BY txn_date)"


@query(
    "q001_dedup_latest",
    """SELECT txn_id, txn_date, amount_usd::DOUBLE AS amount_usd, etl_loaded_at FROM (
         SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY etl_loaded_at DESC, amount_usd DESC, product_key DESC) AS pos FROM txn_core)
       WHERE pos = 1""",
)
def _(t):
    latest = W.dedup_latest(t.txn_core, ["txn_id"], "etl_loaded_at", ["amount_usd", "product_key"])
    return latest.select("txn_id", "txn_date", "amount_usd", "etl_loaded_at")


@query(
    "q002_first_event_per_key",
    """SELECT customer_key, arg_min(txn_no, {'a': txn_timestamp, 'b': txn_no}) AS txn_no, min(txn_date) AS txn_date
       FROM txn_core WHERE status = 'POSTED' GROUP BY customer_key""",
)
def _(t):
    return W.first_event_per_key(t.txn_core.where(is_posted()), "customer_key", "txn_timestamp", "txn_no", ["txn_no", "txn_date"])


@query(
    "q003_rank_metric",
    f"""WITH day_region AS (SELECT txn_date, region_key, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL)
        SELECT txn_date, region_key, g::DOUBLE AS gmv_usd, (rank() OVER w)::INT AS rank_standard, (dense_rank() OVER w)::INT AS rank_dense
        FROM day_region WINDOW w AS (PARTITION BY txn_date ORDER BY g DESC)""",
)
def _(t):
    return W.rank_metric(W.gmv_by(t.transactions, "txn_date", "region_key"), "txn_date", "gmv_usd")


def _delta_oracle(lag: int) -> str:
    return f"""WITH {DAILY}, shifted AS (SELECT txn_date, g, lag(g, {lag}) OVER (ORDER BY txn_date) AS p FROM daily)
        SELECT txn_date, g::DOUBLE AS gmv_usd, p::DOUBLE AS prior, (g - p)::DOUBLE AS change, {div('g - p', 'p')} AS pct_change FROM shifted"""


@query("q004_period_delta", _delta_oracle(1))
def _(t):
    return W.period_delta(W.gmv_by(t.txn_core, "txn_date"), "txn_date", "gmv_usd", 1)


@query("q005_period_delta_weekly", _delta_oracle(7))
def _(t):
    return W.period_delta(W.gmv_by(t.txn_core, "txn_date"), "txn_date", "gmv_usd", 7)


@query(
    "q006_run_interval",
    """WITH finished AS (SELECT pipeline_name, run_id, run_finished_at,
           lead(run_finished_at) OVER (PARTITION BY pipeline_name ORDER BY run_finished_at, run_id) AS nxt
         FROM pipeline_runs WHERE run_finished_at IS NOT NULL)
       SELECT pipeline_name, run_id, run_finished_at, nxt AS next_finished, date_sub('minute', run_finished_at, nxt) AS gap_minutes FROM finished""",
)
def _(t):
    return W.run_interval(t.pipeline_runs)


@query(
    "q006_run_interval_newest",
    """WITH finished AS (SELECT pipeline_name, run_id, run_finished_at,
           lead(run_finished_at) OVER (PARTITION BY pipeline_name ORDER BY run_finished_at, run_id) AS nxt,
           row_number() OVER (PARTITION BY pipeline_name ORDER BY run_finished_at DESC, run_id DESC) AS pos
         FROM pipeline_runs WHERE run_finished_at IS NOT NULL)
       SELECT pipeline_name, run_id, run_finished_at, nxt AS next_finished, date_sub('minute', run_finished_at, nxt) AS gap_minutes
       FROM finished WHERE pos <= 20""",
)
def _(t):
    return W.run_interval(t.pipeline_runs, newest=20)


@query(
    "q007_decile_by_value",
    f"""WITH ltv AS (SELECT customer_key, sum(amount_usd) AS v FROM txn_core WHERE {GMV} GROUP BY customer_key)
        SELECT customer_key, v::DOUBLE AS lifetime_value, (ntile(10) OVER (ORDER BY v DESC, customer_key))::INT AS ltv_decile FROM ltv""",
)
def _(t):
    return W.decile_by_value(t.txn_core)


@query(
    "q008_session_first_last",
    """SELECT DISTINCT session_id,
         first_value(event_type) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS first_event,
         first_value(event_type) OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) AS last_event,
         count(*) OVER (PARTITION BY session_id) AS events_in_session
       FROM ops_events""",
)
def _(t):
    return W.session_first_last(t.ops_events)


@query(
    "q009_running_total",
    f"WITH {DAILY} SELECT txn_date, g::DOUBLE AS gmv_usd, (sum(g) OVER (ORDER BY txn_date ROWS UNBOUNDED PRECEDING))::DOUBLE AS running_gmv FROM daily",
)
def _(t):
    return W.running_total(W.gmv_by(t.txn_core, "txn_date"), "txn_date", "gmv_usd", "running_gmv")


@query(
    "q010_moving_average",
    f"""WITH {DAILY} SELECT txn_date, g::DOUBLE AS gmv_usd,
        {r("(sum(g) OVER w)::DOUBLE / (count(g) OVER w)", 2)} AS gmv_7_row_avg
        FROM daily WINDOW w AS (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return W.moving_average(W.gmv_by(t.txn_core, "txn_date"), "txn_date", "gmv_usd", 7, "gmv_7_row_avg")


@query(
    "q011_share_of_total",
    f"""WITH x AS (SELECT txn_date, bu_code, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL)
        SELECT txn_date, bu_code, g::DOUBLE AS gmv_usd, {div('g', 'sum(g) OVER (PARTITION BY txn_date)')} AS share_of_day FROM x""",
)
def _(t):
    return W.share_of_total(W.gmv_by(t.transactions, "txn_date", "bu_code"), "txn_date", "gmv_usd", "share_of_day")


@query(
    "q012_rank_and_trend",
    f"""WITH x AS (SELECT txn_date, bu_code, sum(amount_usd) AS g FROM transactions WHERE {GMV} GROUP BY ALL)
        SELECT txn_date, bu_code, g::DOUBLE AS gmv_usd, (rank() OVER (PARTITION BY txn_date ORDER BY g DESC))::INT AS rank_today,
          {r("(sum(g) OVER w)::DOUBLE / (count(g) OVER w)", 2)} AS trailing_avg
        FROM x WINDOW w AS (PARTITION BY bu_code ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return W.rank_and_trend(W.gmv_by(t.transactions, "txn_date", "bu_code"), "txn_date", "bu_code", "gmv_usd")


@query(
    "q013_topn_per_group",
    f"""SELECT txn_date, bu_code, product_key, sum(amount_usd)::DOUBLE AS gmv_usd FROM transactions WHERE {GMV} GROUP BY txn_date, bu_code, product_key
        QUALIFY row_number() OVER (PARTITION BY txn_date, bu_code ORDER BY sum(amount_usd) DESC, product_key) <= 3""",
)
def _(t):
    return W.top_products_per_day(t.transactions)


@query(
    "q014_nth_value_per_day",
    f"""SELECT DISTINCT txn_date, nth_value(txn_id, 2) OVER w AS nth_txn, (nth_value(amount_usd, 2) OVER w)::DOUBLE AS nth_amount FROM txn_core WHERE {GMV}
        WINDOW w AS (PARTITION BY txn_date ORDER BY amount_usd DESC, txn_id, txn_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(t):
    return W.nth_value_per_day(t.txn_core)


@query(
    "q015_percent_position",
    f"""SELECT txn_id, txn_no, amount_usd::DOUBLE AS amount_usd, {r('pr', 4)} AS pct_rank, {r('cd', 4)} AS cum_dist FROM (
          SELECT *, percent_rank() OVER w AS pr, cume_dist() OVER w AS cd FROM txn_core WHERE status = 'POSTED' WINDOW w AS (ORDER BY amount_usd))
        ORDER BY amount_usd DESC, txn_no LIMIT 20""",
)
def _(t):
    return W.percent_position(t.txn_core)


@query(
    "q016_event_funnel",
    f"""WITH d AS (SELECT event_date, count(*) FILTER (event_type = 'SIGNUP') AS entries, count(*) FILTER (event_type = 'PURCHASE') AS orders,
          count(*) FILTER (event_type = 'ERROR') AS failures FROM ops_events GROUP BY event_date)
        SELECT *, {div('orders', 'entries')} AS conversion FROM d""",
)
def _(t):
    return W.event_funnel(t.ops_events, "SIGNUP", "PURCHASE", "ERROR")


@query(
    "q017_reopened_cases",
    """WITH x AS (SELECT case_number, customer_key, resolved_at,
           lead(opened_at) OVER (PARTITION BY customer_key ORDER BY opened_at, case_number) AS next_opened FROM support_cases)
       SELECT *, date_sub('day', resolved_at, next_opened) AS days_to_next FROM x WHERE date_sub('day', resolved_at, next_opened) BETWEEN 1 AND 7""",
)
def _(t):
    return W.reopened_cases(t.support_cases)


@query(
    "q018_iqr_outliers",
    f"""WITH posted AS (SELECT txn_id, txn_no, amount_usd FROM txn_core WHERE status = 'POSTED'),
        q AS (SELECT quantile_cont(amount_usd::DOUBLE, 0.25) AS q1, quantile_cont(amount_usd::DOUBLE, 0.75) AS q3 FROM posted),
        f AS (SELECT round(CAST(q3 + 0.25 * (q3 - q1) AS DECIMAL(28,8)), 4) AS fence FROM q)
        SELECT txn_id, txn_no, amount_usd::DOUBLE AS amount_usd, {r('fence', 2)} AS upper_fence FROM posted, f WHERE amount_usd > fence""",
)
def _(t):
    return W.iqr_outliers(t.txn_core, 0.25)


