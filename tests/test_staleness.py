"""Reads of a pre-aggregate within an age limit: fresh, old and partly refreshed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.loads import partitions as P


def per_day(base):
    return base.groupBy(F.col("day").alias("metric_date")).agg(F.count("*").alias("n"))


def rows(df):
    return sorted((str(r.metric_date), r.n) for r in df.select("metric_date", "n").collect())


def test_reads_within_the_limit(spark, tmp_path):
    data = [("2024-01-01", "2024-01-01 08:00:00"), ("2024-01-31", "2024-01-31 08:00:00"), ("2024-01-01", "2024-02-02 08:00:00"), ("2024-02-01", "2024-02-02 08:00:00")]
    base = spark.createDataFrame(data, "day string, loaded string").select(F.col("day").cast("date").alias("day"), F.col("loaded").cast("timestamp").alias("loaded"))
    path = f"{tmp_path}/t"
    early = base.where("loaded < timestamp'2024-02-01 00:00:00'")
    P.write_by_month(per_day(early), path, "metric_date")
    P.record_build(spark, path, "2024-02-01 00:00:00", "2024-01-31 08:00:00")

    def read(at):
        return P.read_within(base, "day", "loaded", per_day, path, "metric_date", at, 60)

    assert rows(read("2024-02-01 01:00:00")) == rows(per_day(early))
    assert rows(read("2024-02-01 01:01:01")) == rows(per_day(base))
    # Refreshed for the new loads: fresh again, and old again without anything new.
    P.refresh_days(base, "day", base.where("loaded > timestamp'2024-02-01 00:00:00'"), per_day, path, "metric_date")
    P.record_build(spark, path, "2024-02-03 00:00:00", "2024-02-02 08:00:00")
    assert rows(read("2024-02-03 00:30:00")) == rows(read("2024-02-09 00:00:00")) == rows(per_day(base))
