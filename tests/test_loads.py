"""Dimension loads, partition rewrites and the upload check."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.loads import partitions as P
from tidemark.loads import scd
from tidemark.loads.dim_date import build_dim_date
from tidemark.metrics import pages
from tidemark.session import run_dir
from tidemark.sources import files

RELAXED = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
ATTRS = ["name", "tier"]
LAYOUT = "id string, name string, tier string"


def start(spark, members):
    source = spark.createDataFrame([(i + 1, *m) for i, m in enumerate(members)], f"sk long, {LAYOUT}")
    return scd.initial_dimension(source, "id", "sk", ATTRS, "2024-01-01 00:00:00")


def load(dim, spark, batch, at):
    return scd.scd2_load(dim, spark.createDataFrame(batch, LAYOUT), "id", "sk", ATTRS, at)


@RELAXED
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["x", "y", None]), min_size=1),
    st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from(["x", "y", "z", None]), min_size=1),
)
def test_scd2_properties(spark, before, batch):
    dim = start(spark, [(k, v, "T") for k, v in before.items()])
    changes = [(k, v, "T") for k, v in batch.items()]
    once = load(dim, spark, changes, "2024-02-01 00:00:00")
    again = load(once, spark, changes, "2024-03-01 00:00:00")
    a, b = [sorted(tuple(r) for r in d.collect()) for d in (once.drop("record_hash"), again.drop("record_hash"))]
    assert a == b
    data = once.collect()
    current = [r for r in data if r.is_current]
    assert len(current) == len({r.id for r in current}) == len(set(before) | set(batch))
    assert len({r.sk for r in data}) == len(data)
    for member in {r.id for r in data}:
        versions = sorted((r for r in data if r.id == member), key=lambda r: r.valid_from)
        for old, new in zip(versions, versions[1:]):
            assert old.valid_to == new.valid_from
        assert versions[-1].valid_to is None
    for r in current:
        if r.id in batch:
            assert r.name == batch[r.id]


def test_null_attributes_are_a_change(spark):
    dim = start(spark, [("a", None, "T"), ("b", "x", None)])
    out = load(dim, spark, [("a", "now set", "T"), ("b", "x", None)], "2024-02-01 00:00:00")
    assert out.where("id = 'a'").count() == 2 and out.where("id = 'b'").count() == 1


def test_row_numbers_are_dense(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id2"))
    got = scd.number_rows(df, "id2", "n", F.lit(100)).agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(got) == (101, 5100, 5000)


def test_fiscal_calendar(spark):
    bounds = spark.createDataFrame([("2026-01-30", "2027-02-02")], "a string, b string").select(F.to_date("a").alias("first_day"), F.to_date("b").alias("last_day"))
    days = {str(r.date_key): r for r in build_dim_date(bounds).collect()}
    assert days["2026-01-31"].fiscal_period == "FY2025-P04"
    assert days["2026-02-01"].fiscal_period == "FY2026-P01"
    assert days["2027-01-31"].fiscal_year == 2026 and days["2027-02-01"].fiscal_year == 2027
    assert days["2026-02-01"].day_of_week == 0 and days["2026-02-01"].is_weekend and not days["2026-02-06"].is_weekend
    assert days["2026-12-31"].is_year_end and days["2026-02-28"].is_month_end


def daily(spark, pairs):
    return spark.createDataFrame(pairs, "d string, v long").select(F.to_date("d").alias("d"), "v")


def test_window_is_replaced_and_the_rest_stays(spark):
    path = run_dir(spark, "t")
    P.write_by_month(daily(spark, [("2024-01-05", 1), ("2024-01-20", 2), ("2024-02-03", 3), ("2024-03-01", 4)]), path, "d")
    P.replace_window(daily(spark, [("2024-01-25", 20), ("2024-02-04", 30), ("2024-04-01", 99)]), path, "d", "2024-01-15", "2024-02-10")
    got = sorted((str(r.d), r.v) for r in P.read_table(spark, path).collect())
    assert got == [("2024-01-05", 1), ("2024-01-25", 20), ("2024-02-04", 30), ("2024-03-01", 4)]


def test_emptied_partitions_go(spark):
    path = run_dir(spark, "t")
    P.write_by_month(daily(spark, [("2024-01-05", 1), ("2024-02-03", 3), ("2024-04-01", 4)]), path, "d")
    P.replace_window(daily(spark, [("2024-01-06", 9)]), path, "d", "2024-01-01", "2024-02-28")
    assert sorted(r.v for r in P.read_table(spark, path).collect()) == [4, 9]
    days = run_dir(spark, "t")
    P.write_table(daily(spark, [("2024-01-01", -2), ("2024-01-02", 2), ("2024-01-03", 3)]), days, "d")
    P.reprocess_partitions(spark, days, "d", "2024-01-01", "2024-01-02", lambda df: df.where("v > 0"))
    assert sorted(r.v for r in P.read_table(spark, days).collect()) == [2, 3]
    total = lambda df: df.groupBy("d").agg(F.sum("v").alias("v"))
    base = daily(spark, [("2024-01-05", 1)])
    P.refresh_days(base, "d", daily(spark, [("2024-04-01", 4)]), total, path, "d")
    assert sorted(r.v for r in P.read_table(spark, path).collect()) == [9]


def test_newest_change_of_a_key_counts(spark):
    dim = start(spark, [("a", "x", "T")])
    batch = spark.createDataFrame([("a", "old", "T", 1), ("a", "new", "T", 2), ("a", "new", "T", 2), (None, "n", "T", 1)], LAYOUT + ", at int")
    out = scd.scd2_load(dim, batch, "id", "sk", ATTRS, "2024-02-01 00:00:00", order="at").collect()
    assert [r.name for r in out if r.is_current] == ["new"] and len(out) == 2


def test_hashes_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("c", None)], "name string, tier string")
    assert df.select(scd.record_hash(ATTRS)).distinct().count() == 5
    on = spark.createDataFrame([(None,), (True,), (False,)], "is_active boolean").select(scd.record_hash(["is_active"], {"is_active": True}))
    assert on.distinct().count() == 2


def test_reprocess_touches_only_the_window(spark):
    path = run_dir(spark, "t")
    P.write_table(daily(spark, [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)]), path, "d", ["v"])
    P.reprocess_partitions(spark, path, "d", "2024-01-02", "2024-01-02", lambda df: df.withColumn("v", F.col("v") * 10))
    assert sorted(r.v for r in P.read_table(spark, path).collect()) == [1, 3, 20]


def test_csv_source_numbers_lines_and_finds_every_issue(spark, tmp_path):
    lines = ["txn_id,amount_usd,txn_type,status,extra"]
    lines += ["a,10,PAYMENT,posted,1", "a,-5,PAYMENT,posted,2", ",-5,REFUND,nope,3", "b,99999,PAYMENT,posted,4", "b,x,PAYMENT,,5", "a,1,PAYMENT,posted,6"]
    (tmp_path / "up.csv").write_text("\n".join(lines))
    columns = ["txn_id", "amount_usd", "txn_type", "status", "extra"]
    rows = files.with_line_numbers(files.read_csv(spark, str(tmp_path / "up.csv"), columns).drop(files.CORRUPT))
    issues = pages.validate_rows(rows, ["txn_id", "amount_usd", "txn_type", "status"], ["txn_id"])
    got = sorted((r.row_no, r.category) for r in issues.collect())
    assert got == [(1, "SCHEMA"), (3, "BUSINESS_RULE"), (3, "DUPLICATE"), (4, "BUSINESS_RULE"), (4, "MISSING_VALUE"), (5, "OUTLIER"), (6, "DUPLICATE"), (7, "DUPLICATE")]
    assert pages.first_issues(issues, 2).count() == 2


def test_search_scores(spark):
    entries = spark.createDataFrame(
        [("t", "one", ["orders"], 1.0), ("t", "two", ["orders daily"], 1.0), ("c", "three", ["my orders"], 0.9), ("t", "four", ["x"], 1.0)],
        "kind string, title string, fields array<string>, weight double",
    )
    got = [(r.title, float(r.score)) for r in pages.catalog_search(entries, "Orders").collect()]
    assert got == [("one", 100.0), ("two", 80.0), ("three", 54.0)]
    assert pages.catalog_search(entries, "  ").count() == 0
