"""Rules as data."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One check of one table.

    ``max_rate`` is the tolerated failure rate. Limits that are not rates (hours,
    sigmas, ratios) live in ``params``, so a freshness limit of 24 hours is never
    read as a rate.
    """

    rule_id: str
    dimension: str
    table: str
    column: str | None = None
    severity: str = "ERROR"
    max_rate: float = 0.0
    params: dict[str, Any] = field(default_factory=dict)


# The application's rule types and the dimension that carries each out.
RULE_TYPES = {
    "UNIQUE": "UNIQUENESS",
    "NOT_NULL": "COMPLETENESS",
    "FRESHNESS": "FRESHNESS",
    "THRESHOLD": "COMPLETENESS",
    "VOLUME": "VOLUME",
    "APPROVAL_RATE": "RATIO",
    "SCHEMA": "SCHEMA",
    "DUPLICATE_RATIO": "UNIQUENESS",
}


RULE_TABLE = (
    "rule_id string, dimension string, table_id string, column_name string, severity string, max_rate double, params map<string,string>, is_active boolean"
)


def active_rules(rules: DataFrame) -> DataFrame:
    """The rules that take part in a run."""
    return rules.where(F.col("is_active"))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as rows of the rules table."""
    text = lambda params: {k: str(v) for k, v in params.items() if v is not None}
    rows = [(r.rule_id, r.dimension, r.table, r.column, r.severity, float(r.max_rate), text(r.params), True) for r in rules]
    return spark.createDataFrame(rows, RULE_TABLE)


def load_rules(rules: DataFrame) -> Iterator[list[Rule]]:
    """Active rules as objects that drive plan building, one list a table; only one table's rules are held at once."""
    columns = ["rule_id", "dimension", "table_id", "column_name", "severity", "max_rate", "params"]
    rows = active_rules(rules).select(*columns).orderBy("table_id", "rule_id").toLocalIterator()
    for _, group in groupby(rows, key=lambda x: x.table_id):
        yield [
            Rule(x.rule_id, RULE_TYPES.get(x.dimension, x.dimension), x.table_id, x.column_name, x.severity, float(x.max_rate or 0), dict(x.params or {}))
            for x in group
        ]


def seed_rules(
    transactions: str = "transactions", cases: str = "support_cases", customers: str = "dim_customer",
    events: str = "ops_events", runs: str = "pipeline_runs", catalog: str = "table_catalog", as_of_ts: str | None = None,
) -> list[Rule]:
    """The standard rules of the certified tables."""
    types = "txn_type IN ('DEPOSIT', 'WITHDRAWAL', 'PAYMENT', 'TRANSFER', 'FEE', 'REFUND', 'CHARGEBACK')"
    sign = "amount_usd >= 0 OR txn_type IN ('REFUND', 'CHARGEBACK')"
    to_customer = {"dim": customers, "dim_key": "customer_key"}
    return [
        Rule("TXN-1", "UNIQUENESS", transactions, "txn_id"),
        Rule("TXN-2", "COMPLETENESS", transactions, "customer_key", max_rate=0.001),
        Rule("TXN-3", "VALIDITY", transactions, "txn_type", max_rate=0.001, params={"condition": types}),
        Rule("TXN-4", "VALIDITY", transactions, "amount_usd", max_rate=0.002, params={"condition": sign}),
        Rule("TXN-5", "INTEGRITY", transactions, "customer_key", params=to_customer),
        Rule("TXN-6", "VOLUME", transactions, None, "WARNING", params={"date": "txn_date", "ratio": 0.5}),
        Rule("TXN-7", "FRESHNESS", transactions, None, params={"timestamp": "etl_loaded_at", "hours": 24, "as_of": as_of_ts}),
        Rule("TXN-8", "TIMELINESS", transactions, "etl_loaded_at", "WARNING", 0.02, {"date": "txn_date", "cutoff_hours": 12}),
        Rule("CASE-1", "UNIQUENESS", cases, "case_number"),
        Rule("CASE-2", "VALIDITY", cases, "priority", max_rate=0.001, params={"condition": "priority IN ('P1', 'P2', 'P3', 'P4')"}),
        Rule("CASE-3", "INTEGRITY", cases, "customer_key", max_rate=0.001, params=to_customer),
        Rule("DIM-1", "UNIQUENESS", customers, "customer_key"),
        Rule("DIM-2", "UNIQUENESS", customers, "customer_id", params={"filter": "is_current"}),
        Rule("DIM-3", "COMPLETENESS", customers, "email", "WARNING", 0.05),
        Rule("OPS-1", "UNIQUENESS", events, "event_id"),
        Rule("OPS-2", "VALIDITY", events, "source_system", "WARNING", 0.01, {"condition": "source_system IN ('GATEWAY', 'APP', 'BATCH')"}),
        Rule("OPS-3", "VALIDITY", events, "latency_ms", "WARNING", 0.005, {"condition": "latency_ms < 3600000"}),
        Rule("RUN-1", "VALIDITY", runs, "status", params={"condition": "status IN ('SUCCESS', 'FAILED')"}),
        Rule("RUN-2", "INTEGRITY", runs, "target_table", params={"dim": catalog, "dim_key": "table_id"}),
    ]
