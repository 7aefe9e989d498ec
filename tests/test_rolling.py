"""Rolling customer counts from stored state: exact bitmaps, sketches with a stated error."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.metrics import views as V


def txns(spark, rows):
    """Rows ``k`` from 0: customer k mod ``rows`` // 2, forty days, one unit."""
    return spark.range(rows).select(
        F.date_sub(F.lit("2024-03-31").cast("date"), (F.col("id") % 40).cast("int")).alias("txn_date"), F.lit("U").alias("bu_code"),
        (F.col("id") % (rows // 2 + 1)).alias("customer_key"), F.lit("POSTED").alias("status"), F.lit(False).alias("is_reversal"),
    )


def exact(df, days):
    last = F.lit("2024-03-31").cast("date")
    return df.where(F.col("txn_date") > F.date_sub(last, days)).agg(F.count_distinct("customer_key")).first()[0]


def test_bitmaps_are_exact_and_add_up(spark, tmp_path):
    df = txns(spark, 200_000)
    V.customer_bitmaps(df.where("customer_key % 3 = 0")).write.parquet(f"{tmp_path}/a")
    stored = V.add_bitmaps(spark.read.parquet(f"{tmp_path}/a"), V.customer_bitmaps(df.where("customer_key % 3 <> 0 or txn_date > '2024-03-20'")))
    stored.write.parquet(f"{tmp_path}/b")
    report = V.rolling_customers(spark.read.parquet(f"{tmp_path}/b"), "2024-03-31")
    assert {r.window_days: r.active_customers for r in report.collect()} == {d: exact(df, d) for d in V.ROLLING_DAYS}
    assert V.rolling_customers(stored.where("false"), "2024-03-31").collect() == []


def test_sketches_of_a_million_customers_stay_within_three_percent(spark):
    df = txns(spark, 2_000_000)
    got = {r.window_days: r.active_customers for r in V.rolling_customers_about(V.customer_sketches(df), "2024-03-31").collect()}
    for d, n in got.items():
        want = exact(df, d)
        assert abs(n - want) <= 0.03 * want
    assert set(got) == set(V.ROLLING_DAYS)
