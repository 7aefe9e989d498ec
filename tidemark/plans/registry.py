"""Registered queries: each binds one operator to the given tables and to a comparison SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.fixtures import FIXTURES, Tables, oracle_ctes

# Reporting dates of the given tables.
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, build, _with_fixtures(oracle) if oracle else None)
        return build

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain_types(REGISTRY[name].build(Tables(spark, folder)))


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand back the same type."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _with_fixtures(body: str) -> str:
    body = body.strip()
    used = [name for name in FIXTURES if re.search(rf"\b{name}\b", body)]
    ctes = ",\n".join(oracle_ctes(used))
    if body[:5].upper() == "WITH ":
        rest = body[5:]
        return f"WITH RECURSIVE {ctes + ',' if ctes else ''}\n{rest}"
    return f"WITH RECURSIVE {ctes}\n{body}" if ctes else body


def r(expr: str, digits: int) -> str:
    """Half-up rounding on a fixed-point value, as the operators round."""
    return f"round(CAST({expr} AS DECIMAL(28,8)), {digits})::DOUBLE"


def pct(num: str, den: str, digits: int = 2) -> str:
    return r(f"100 * ({num})::DOUBLE / nullif(({den})::DOUBLE, 0)", digits)


def div(num: str, den: str, digits: int = 4) -> str:
    return r(f"({num})::DOUBLE / nullif(({den})::DOUBLE, 0)", digits)


def avg(value: str, digits: int = 2) -> str:
    return r(f"sum({value})::DOUBLE / nullif(count({value}), 0)", digits)
