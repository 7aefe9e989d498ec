"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(28,8)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(value: str | Column, digits: int) -> Column:
    """Round half up on a fixed-point value.

    The value is fixed to eight decimals first, so a result such as 12345.675
    does not depend on how a double happens to store it.
    """
    return F.round(col(value).cast(WIDE), digits)


def ratio(num: str | Column, den: str | Column, digits: int = 4) -> Column:
    """num / den, NULL when the denominator is zero or NULL."""
    return half_up(F.try_divide(col(num).cast("double"), col(den).cast("double")), digits)


def percent(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return half_up(F.try_divide(100 * col(num).cast("double"), col(den).cast("double")), digits)


def mean_of(value: str | Column, digits: int = 2) -> Column:
    """Aggregate mean from an exact sum, so partial sums may arrive in any order."""
    value = col(value)
    return half_up(F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double")), digits)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(value: str | Column, cond: Column) -> Column:
    """Sum of ``value`` over matching rows, zero when none match."""
    return F.coalesce(F.sum(F.when(cond, col(value))), F.lit(0).cast("decimal(28,2)"))


def share(value: str | Column, window, digits: int = 4) -> Column:
    return ratio(value, F.sum(col(value)).over(window), digits)


# -- certified definitions ---------------------------------------------------
def is_posted() -> Column:
    return F.col("status") == "POSTED"


def counts_as_gmv() -> Column:
    """GMV: posted and not a reversal."""
    return is_posted() & ~F.col("is_reversal")


def counts_as_revenue() -> Column:
    """The site variant of GMV: posted, positive, neither refund nor chargeback."""
    return is_posted() & (F.col("amount_usd") > 0) & ~F.col("txn_type").isin("REFUND", "CHARGEBACK")


# -- time --------------------------------------------------------------------
def day_literal(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def ts_literal(value: str | dt.datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc_ts(unit: str, value: str | Column) -> Column:
    return F.date_trunc(unit, col(value)).cast("timestamp_ntz")


def week_monday(value: str | Column) -> Column:
    return F.date_trunc("WEEK", col(value)).cast("date")


def units_between(unit: str, start: str | Column, end: str | Column) -> Column:
    """Whole units from start to end (negative when end is earlier)."""
    return F.timestamp_diff(unit, col(start), col(end))


def within_days(value: str | Column, as_of: Column, days: int | None) -> Column:
    """value in [as_of - days, as_of]; days=None keeps everything up to as_of."""
    upper = col(value) <= as_of
    return upper if days is None else upper & (col(value) >= F.date_sub(as_of, days))


def bucketed(value: str | Column, steps: list[tuple[Column, str]], otherwise: str) -> Column:
    expr = None
    for cond, label in steps:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)
