"""The date dimension with its February fiscal year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_bounds(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def build_dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of a one-row frame."""
    d = F.col("date_key")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    sunday_based = F.dayofweek(d) - 1
    month_end = d == F.last_day(d)
    shifted = F.add_months(d, -1)
    fiscal_quarter = F.quarter(shifted)
    return days.select(
        "date_key",
        d.alias("date_iso"),
        sunday_based.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.floor((F.dayofyear(d) + 6 - sunday_based) / 7).cast("int").alias("week_of_year"),
        F.date_sub(d, sunday_based).alias("week_start_date"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        sunday_based.isin(0, 6).alias("is_weekend"),
        month_end.alias("is_month_end"),
        (month_end & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
        (month_end & (F.month(d) == 12)).alias("is_year_end"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        F.year(shifted).alias("fiscal_year"),
        fiscal_quarter.alias("fiscal_quarter"),
        F.concat(F.lit("FY"), F.year(shifted).cast("string"), F.lit("-P"), F.lpad(fiscal_quarter.cast("string"), 2, "0")).alias("fiscal_period"),
    )
