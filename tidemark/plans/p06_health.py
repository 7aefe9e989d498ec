"""Freshness, drift and health queries Q067-Q077."""

from __future__ import annotations

from tidemark.operators import health as H
from tidemark.plans.p02_segments import NOW
from tidemark.plans.registry import avg, div, pct, query, r


@query(
    "q067_freshness_report",
    f"""WITH ok AS (SELECT target_table, max(run_finished_at) AS f FROM pipeline_runs WHERE status = 'SUCCESS' GROUP BY target_table),
        x AS (SELECT table_id, sla_hours, data_owner, f, date_sub('minute', f, TIMESTAMP '{NOW}') AS m FROM table_catalog LEFT JOIN ok ON target_table = table_id WHERE criticality = 'T1')
        SELECT table_id, sla_hours, data_owner, f AS last_success, {r('m / 60.0::DOUBLE', 2)} AS hours_since_load,
          CASE WHEN f IS NULL THEN 'NEVER_LOADED' WHEN m > sla_hours * 60 THEN 'BREACHED' ELSE 'OK' END AS freshness_status FROM x""",
)
def _(t):
    return H.freshness_report(t.table_catalog, t.pipeline_runs, NOW)


@query(
    "q068_run_success",
    f"""SELECT pipeline_name, count(*) AS runs, count(*) FILTER (status = 'SUCCESS') AS successes, {pct("count(*) FILTER (status = 'SUCCESS')", 'count(*)')} AS success_rate,
        {avg('dq_score', 2)} AS avg_dq_score, {avg("date_sub('minute', run_started_at, run_finished_at)", 1)} AS avg_duration_min FROM pipeline_runs GROUP BY pipeline_name""",
)
def _(t):
    return H.pipeline_success(t.pipeline_runs)


@query(
    "q069_volume_drift",
    f"""WITH x AS (SELECT target_table, run_date, run_id, rows_written, (sum(rows_written) OVER w)::DOUBLE / nullif(count(rows_written) OVER w, 0) AS prior
          FROM pipeline_runs WHERE status = 'SUCCESS' WINDOW w AS (PARTITION BY target_table ORDER BY run_date, run_id ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
        SELECT target_table, run_date, run_id, rows_written, {r('prior', 0)} AS trailing_avg, {div('rows_written', 'prior', 3)} AS volume_ratio,
          CASE WHEN prior IS NULL OR rows_written = 0 THEN 'WARN' WHEN rows_written < 0.5 * prior THEN 'DROP_ALERT' WHEN rows_written > 2 * prior THEN 'SURGE_ALERT' ELSE 'NORMAL' END AS drift_flag FROM x""",
)
def _(t):
    return H.volume_drift(t.pipeline_runs)


@query(
    "q070_late_arrivals",
    """SELECT txn_date, max(etl_loaded_at)::DATE AS latest_load_date, max(date_diff('day', txn_date, etl_loaded_at::DATE))::INT AS max_late_days
       FROM txn_core GROUP BY txn_date HAVING max_late_days > 3""",
)
def _(t):
    return H.late_arrivals(t.txn_core)


@query(
    "q071_dq_trend",
    """SELECT score_date, data_product_name, dq_score::DOUBLE AS dq_score, (dq_score - lag(dq_score, 7) OVER (PARTITION BY data_product_name ORDER BY score_date))::DOUBLE AS dq_change FROM dq_health""",
)
def _(t):
    return H.dq_trend(t.dq_health)


@query(
    "q072_dq_failures",
    f"""SELECT dimension, severity, count(*) AS failed_checks, sum(rows_failed)::BIGINT AS rows_impacted, {div('sum(rows_failed)', 'sum(rows_checked)')} AS failure_rate
        FROM dq_results WHERE status = 'FAIL' GROUP BY dimension, severity""",
)
def _(t):
    return H.dq_failures(t.dq_results)


@query("q073_schema_drift", "FROM physical_columns p SELECT table_id, column_name, data_type WHERE (table_id, column_name) NOT IN (SELECT (table_id, column_name) FROM column_catalog)")
def _(t):
    return H.schema_drift(t.physical_columns, t.column_catalog)


@query(
    "q074_alert_queue",
    f"""WITH w AS (SELECT *, row_number() OVER (PARTITION BY alert_type, severity, status ORDER BY triggered_at DESC, alert_id DESC) AS pos FROM alerts WHERE status IN ('OPEN', 'ACKNOWLEDGED'))
        SELECT alert_type, severity, status, count(*) AS open_alerts, {avg(f"date_sub('hour', triggered_at, TIMESTAMP '{NOW}')", 1)} AS avg_age_hours,
          string_agg(subject, ' | ' ORDER BY pos) FILTER (pos <= 5) AS samples FROM w GROUP BY ALL""",
)
def _(t):
    return H.alert_queue(t.alerts, NOW)


@query(
    "q075_mttr",
    f"""SELECT alert_type, {avg("date_sub('hour', triggered_at, resolved_at)", 1)} AS avg_mttr_hours, count(*) AS resolved_count
        FROM alerts WHERE status = 'RESOLVED' AND resolved_at IS NOT NULL GROUP BY alert_type""",
)
def _(t):
    return H.mttr(t.alerts)


@query(
    "q076_dq_run_punctuality",
    f"""WITH x AS (SELECT run_date, date_sub('minute', date_trunc('day', run_timestamp), run_timestamp) <= 45 AS good FROM dq_results)
        SELECT run_date, count(*) AS runs, count(*) FILTER (good) AS on_time_runs, {pct('count(*) FILTER (good)', 'count(*)', 1)} AS on_time_pct FROM x GROUP BY run_date""",
)
def _(t):
    return H.dq_run_punctuality(t.dq_results)


@query(
    "q077_health_index",
    f"""WITH d AS (SELECT run_date, 100 * (count(*) FILTER (status = 'SUCCESS'))::DOUBLE / count(*) AS p,
          CASE WHEN date_sub('hour', max(run_finished_at), TIMESTAMP '{NOW}') <= 24 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS f FROM pipeline_runs GROUP BY run_date),
        s AS (SELECT score_date, sum(dq_score)::DOUBLE / count(dq_score) AS q FROM dq_health WHERE data_product_name = 'product 1' GROUP BY score_date)
        SELECT run_date AS metric_date, {r('p', 2)} AS run_score, {r('q', 2)} AS dq_score, {r('f', 2)} AS freshness_score,
          {r('0.35::DOUBLE * p + 0.35::DOUBLE * q + 0.3::DOUBLE * f', 2)} AS health_index FROM d LEFT JOIN s ON score_date = run_date""",
)
def _(t):
    return H.health_index(t.pipeline_runs, t.dq_health, NOW, "product 1")
