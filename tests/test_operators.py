"""Operators on small hand-made and skewed frames: ties, NULLs, empty input, hot keys, cycles."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import percent, ratio
from tidemark.operators import checks, documents, hierarchy, joins, ranking, windows
from tidemark.operators.business import signed_amount

RELAXED = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def skewed(spark, n=3000, seed=3):
    """A third of all rows belong to key 0; times spread over months; values repeat."""
    rng = random.Random(seed)
    start = dt.datetime(2023, 1, 1)
    data = [
        (i, 0 if i % 3 == 0 else rng.randrange(40), start + dt.timedelta(minutes=rng.randrange(300_000)), rng.choice([None, 1, 1, 1, 5, 9, 12]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long")


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()][:2] == [None, None]
    assert float(df.select(percent("a", "b").alias("p")).collect()[2].p) == 33.33


@pytest.mark.parametrize("tiles", [1, 4, 10, 5000])
def test_ntile_equals_window_on_heavy_ties(spark, tiles):
    df = skewed(spark).where("v IS NOT NULL").select("id", "v")
    got = ranking.ntile_by_value(df, "v", "id", tiles, "t")
    want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(F.col("v").desc(), "id")))
    assert rows(got.select("id", "t")) == rows(want.select("id", "t"))


def test_positions_of_an_empty_frame(spark):
    assert ranking.global_positions(skewed(spark).where("id < 0"), "v", "id").count() == 0


@RELAXED
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]))
def test_percentiles_equal_numpy(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = ranking.exact_percentiles(df, "x", [("p", p)]).first().p
    assert got == pytest.approx(float(np.quantile(values, p)))


@pytest.mark.parametrize("make", ["hash(id) / 7.0", "cast(id % 3 as double)", "cast(if(id % 3 = 0, 5, hash(id)) as double)", "cast(null as double)"])
def test_bracketed_percentiles_equal_spark(spark, make):
    probs = [("a", 0.0), ("b", 0.25), ("c", 0.26), ("d", 0.5), ("e", 0.99), ("f", 1.0)]
    df = spark.range(30_000).selectExpr(f"{make} AS x")
    want = df.agg(*[F.percentile("x", p).alias(n) for n, p in probs]).first()
    got = ranking.bracketed_percentiles(df, "x", probs).first()
    assert list(got) == (pytest.approx(list(want)) if want.a is not None else [None] * 6)


def test_bracketed_percentiles_of_few_rows(spark):
    df = spark.createDataFrame([(v,) for v in (3, 1, 2, 10)], "x long")
    assert ranking.bracketed_percentiles(df, "x", [("p", 0.5), ("q", 0.9)]).first() == pytest.approx((2.5, 7.9))


def test_percentiles_per_group_with_a_hot_group(spark):
    df = skewed(spark).where("v IS NOT NULL")
    got = {r.k: r.m for r in ranking.exact_percentiles(df, "v", [("m", 0.5)], by=["k"]).collect()}
    want = {r.k: float(r.m) for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got == want


def test_next_in_key_equals_lead_on_a_hot_key(spark):
    df = skewed(spark)
    got = windows.next_in_key(df, "k", "ts", "id", "nxt").select("id", "nxt")
    want = df.select("id", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "id")).alias("nxt"))
    assert {r.id: r.nxt for r in got.collect()} == {r.id: r.nxt for r in want.collect()}


@pytest.mark.parametrize("n", [1, 3, 28])
def test_trailing_mean_equals_window_on_a_hot_key(spark, n):
    df = skewed(spark, 900)
    got = windows.trailing_mean(df, "k", ["ts", "id"], "v", n, "m").select("id", F.round("m", 6).alias("m"))
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(-n, -1)
    want = df.select("id", F.round(F.avg("v").over(w), 6).alias("m"))
    assert {r.id: r.m for r in got.collect()} == {r.id: r.m for r in want.collect()}


def test_dedup_keeps_the_newest(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5), ("a", 2, 30)], "k string, ts int, v int")
    assert rows(windows.dedup_latest(df, ["k"], "ts", ["v"])) == [("a", 2, 30), ("b", 1, 5)]


def test_nth_value_is_null_on_short_days(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a", "9.00"), (2, "2024-01-01", "b", "7.00"), (3, "2024-01-02", "c", "5.00")], "txn_no long, d string, txn_id string, a string"
    ).select("txn_no", "txn_id", F.to_date("d").alias("txn_date"), F.col("a").cast("decimal(18,2)").alias("amount_usd"), F.lit("POSTED").alias("status"), F.lit(False).alias("is_reversal"))
    got = {str(r.txn_date): r.nth_txn for r in windows.nth_value_per_day(df).collect()}
    assert got == {"2024-01-01": "b", "2024-01-02": None}


def test_refunds_count_against_revenue_whatever_their_sign(spark):
    df = spark.createDataFrame([("REFUND", 5), ("REFUND", -5), ("PAYMENT", 7)], "txn_type string, amount_usd int")
    assert [r[0] for r in df.select(signed_amount()).collect()] == [-5, -5, 7]


def test_rapid_repeat_equals_brute_force(spark):
    df = skewed(spark, 400).withColumn("ts", F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz") + F.make_interval(mins=(F.col("id") % 50).cast("int")))
    rows_in = df.where("v IS NOT NULL")
    got = {(r.first_id, r.second_id) for r in joins.rapid_pairs(rows_in, rows_in, ["k", "v"], "ts", "id", 5).collect()}
    data = rows_in.collect()
    want = {(a.id, b.id) for a in data for b in data if (a.k, a.v) == (b.k, b.v) and a.ts < b.ts <= a.ts + dt.timedelta(minutes=5)}
    assert got == want and want
    at = {r.id: r.ts for r in data}
    counted = {r.id: (r.repeats, at[r.nearest_id]) for r in joins.rapid_repeat(rows_in, ["k", "v"], "ts", "id", 5).collect()}
    assert counted == {b: (sum(x[1] == b for x in want), max(at[a] for a, x in want if x == b)) for b in {x for _, x in want}}


def test_asof_interval_is_half_open(spark):
    fact = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 2, 1)), (1, dt.datetime(2023, 1, 1))], "k int, at timestamp_ntz")
    dim = spark.createDataFrame(
        [(1, "old", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)), (1, "new", dt.datetime(2024, 2, 1), None)],
        "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    got = rows(joins.asof_scd2_join(fact, dim, "k", "at", {"name": "version"}).select("at", "version"))
    assert [x[1] for x in got] == ["old", "new"]


def test_upsert_updates_inserts_and_keeps(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, version int, text string")
    new = spark.createDataFrame([("a", 2, "X"), ("b", 4, "Y"), ("c", 1, "Z")], "k string, version int, text string")
    got = joins.upsert(old, new, ["k"], ["version", "text"], F.col("t.version") < F.col("s.version"))
    assert rows(got) == [("a", 2, "X"), ("b", 5, "y"), ("c", 1, "Z")]
    again = joins.upsert(got, new, ["k"], ["version", "text"], F.col("t.version") < F.col("s.version"))
    assert rows(again) == rows(got)


def test_report_counts_skip_branches_of_inactive_heads(spark):
    people = spark.createDataFrame(
        [(1, None, "ACTIVE"), (2, 1, "ACTIVE"), (3, 1, "LEAVE"), (4, 2, "LEAVE"), (5, 3, "ACTIVE"), (6, 5, "ACTIVE")],
        "employee_key long, manager_employee_key long, employment_status string",
    )
    assert rows(hierarchy.report_counts(people)) == [(1, 2), (3, 2), (5, 1)]
    assert dict(rows(hierarchy.report_counts(people, active_only=False)))[1] == 5


def test_bom_adds_up_over_paths(spark):
    bom = spark.createDataFrame([(2, 1, 2), (3, 1, 3), (4, 2, 5), (4, 3, 7)], "component_product_key long, parent_product_key long, quantity_per_unit long")
    assert {r[0]: int(r[1]) for r in hierarchy.bom_explosion(bom, 1).collect()} == {2: 2, 3: 3, 4: 31}


def edges(spark, pairs):
    return spark.createDataFrame([(a, "c", b, "c") for a, b in pairs], "source_table string, source_column string, target_table string, target_column string")


def test_lineage_walks(spark):
    graph = edges(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")])
    assert {r[0]: r[2] for r in hierarchy.downstream(graph, "a", "c").collect()} == {"b": 0, "c": 1, "d": 2}
    assert {r[0]: r[2] for r in hierarchy.reachable(graph, "a", "c").collect()} == {"b": 0, "c": 0, "d": 1}
    assert hierarchy.downstream(graph, "zz", "c").count() == 0


def test_cycles(spark):
    loop = edges(spark, [("a", "b"), ("b", "a"), ("b", "c")])
    assert {r[0]: r[2] for r in hierarchy.reachable(loop, "a", "c").collect()} == {"b": 0, "a": 1, "c": 1}
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.downstream(loop, "a", "c")


def test_a_wide_target_is_one_row(spark):
    pairs = [(f"s{i}", "t") for i in range(200)]
    graph = edges(spark, pairs + pairs[:50]).withColumn("transformation", F.lit("direct"))
    (row,) = documents.incoming_edges(graph).collect()
    assert len(row.incoming_edges) == 200 and sum(e.times for e in row.incoming_edges) == 250


def test_a_chain_of_150_levels(spark):
    people = spark.range(151).selectExpr("id AS employee_key", "concat('e', id) AS full_name", "nullif(id, 0) - 1 AS manager_employee_key")
    chain = hierarchy.manager_chain(people, spark.range(150, 151).toDF("employee_key"))
    assert chain.agg(F.max("depth")).first()[0] == 150
    looped = people.selectExpr("employee_key", "full_name", "coalesce(manager_employee_key, 150) AS manager_employee_key")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.manager_chain(looped)


def test_json_that_does_not_parse_gives_nulls(spark):
    df = spark.createDataFrame([(1, '{"order_id":"o","attempts":"x"}'), (2, "not json"), (3, None)], "event_id long, payload string")
    got = rows(documents.json_scalars(df).select("event_id", "order_id", "retry_attempts"))
    assert got == [(1, "o", None), (2, None, None), (3, None, None)]


def test_split_takes_separators_literally(spark):
    df = spark.createDataFrame([(1, "a.b.c"), (2, None)], "id int, t string")
    assert rows(joins.split_explode(df, "id", "t", separator=".")) == [(1, "a"), (1, "b"), (1, "c")]


def test_checks_on_an_empty_frame(spark):
    empty = spark.createDataFrame([], "txn_date date, customer_key long")
    assert checks.completeness(empty, ["customer_key"]).first()[0] is None
    assert checks.staleness(empty, "txn_date", "2024-01-01").first().state == "OK"
    assert checks.duplicates(empty, ["customer_key"]).count() == 0


def test_orphans_count_hot_keys_once_per_fact(spark):
    facts = spark.createDataFrame([(9,)] * 50 + [(1,)] * 3, "k long")
    dim = spark.createDataFrame([(1,), (1,)], "key long")
    assert checks.orphans(facts, dim, "k", "key", "dim").first().orphan_rows == 50


def test_a_bill_is_read_a_few_times_however_deep_it_is(spark, monkeypatch):
    cut, rows = hierarchy.cut_counted, []

    def counted(df):
        kept, n = cut(df)
        rows.append(n)
        return kept, n

    monkeypatch.setattr(hierarchy, "cut_counted", counted)
    parts = [(i, (i - 1) // 2, 1 + i % 3) for i in range(1, 255)]
    bom = spark.createDataFrame(parts, "component_product_key long, parent_product_key long, quantity_per_unit int")
    got = {r.component_product_key: int(r.total_qty) for r in hierarchy.bom_explosion(bom, 0).collect()}
    want = {0: 1}
    for part, parent, quantity in parts:
        want[part] = want[parent] * quantity
    assert got == {k: v for k, v in want.items() if k}
    assert sum(rows) < 4 * len(parts)


def test_a_cycle_beside_the_root_raises(spark):
    links = [(1, 0, 1), (2, 1, 1), (7, 9, 1), (8, 7, 1), (9, 8, 1), (2, 9, 1), (None, 0, 1)]
    bom = spark.createDataFrame(links, "component_product_key long, parent_product_key long, quantity_per_unit int")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.bom_explosion(bom, 0)
    assert hierarchy.bom_explosion(bom.where("parent_product_key < 7"), 0).where("component_product_key = 2").first().total_qty == 1


def test_few_views_in_one_file_are_taken_apart_by_several_tasks(spark):
    from tidemark.catalog import lineage

    views = spark.range(200, numPartitions=1).select(F.concat(F.lit("v"), "id").alias("target_table"), F.concat(F.lit("SELECT s.a"), "id", F.lit(" AS b FROM s")).alias("view_sql"))
    assert lineage.lineage_edges(views.union(views.select("target_table", F.lit(None)))).count() == 200
    assert lineage.lineage_edges(views).select(F.spark_partition_id().alias("p")).distinct().count() > 1
