"""The quality run on frames with known defects."""

from __future__ import annotations

import pytest

from tidemark.quality import engine as E
from tidemark.quality.rules import Rule, load_rules

NOW = "2024-01-10 00:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    facts = spark.createDataFrame(
        [(1, "a", 5.0), (2, "a", None), (3, "b", 7.0), (3, "zz", -1.0), (None, None, 2.0)], "id long, k string, v double"
    )
    # Two versions of member "a": an integrity check must not multiply facts by versions.
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "key string, version int")
    return {"facts": facts, "dim": dim, "empty": facts.where("id < 0")}


def run(spark, tables, *rules):
    return {r.rule_id: r for r in E.run_checks(spark, tables, list(rules)).collect()}


def test_counts(spark, tables):
    got = run(
        spark, tables,
        Rule("c", "COMPLETENESS", "facts", "v"),
        Rule("u", "UNIQUENESS", "facts", "id"),
        Rule("v", "VALIDITY", "facts", "v", params={"condition": "v > 0"}),
        Rule("i", "INTEGRITY", "facts", "k", params={"dim": "dim", "dim_key": "key"}),
    )
    assert {k: (r.rows_checked, r.rows_failed) for k, r in got.items()} == {"c": (5, 1), "u": (4, 1), "v": (5, 1), "i": (5, 2)}
    assert all(r.status == "FAIL" for r in got.values())


def test_tolerance_and_no_rows(spark, tables):
    got = run(spark, tables, Rule("ok", "COMPLETENESS", "facts", "v", max_rate=0.2), Rule("none", "COMPLETENESS", "empty", "v", max_rate=0.5))
    assert got["ok"].status == "PASS"
    assert got["none"].status == "FAIL" and float(got["none"].observed_value) == 1.0


def test_a_broken_rule_is_an_error_row_and_stops_nothing(spark, tables):
    got = run(
        spark, tables,
        Rule("bad-column", "COMPLETENESS", "facts", "nope"), Rule("bad-table", "UNIQUENESS", "missing", "id"),
        Rule("bad-dimension", "MAGIC", "facts", "id"), Rule("bad-text", "VALIDITY", "facts", "v", params={"condition": "v >>> ("}),
        Rule("good", "COMPLETENESS", "facts", "v"),
    )
    assert {k for k, r in got.items() if r.status == "ERROR"} == {"bad-column", "bad-table", "bad-dimension", "bad-text"}
    assert got["good"].rows_failed == 1


def test_scores_leave_errors_out_and_raise_alerts(spark, tables):
    results = E.run_checks(
        spark, tables,
        [Rule("a", "COMPLETENESS", "facts", "v"), Rule("b", "VALIDITY", "facts", "v", "INFO", params={"condition": "v > 0"}), Rule("x", "MAGIC", "facts")],
    )
    score = E.score_tables(results).first()
    assert float(score.dq_score) == 80.0 and score.checks_run == 2 and score.anomaly_flag
    assert '"COMPLETENESS":80' in score.by_dimension
    assert E.alert_breaches(E.score_tables(results), NOW).first().severity == "HIGH"
    names = {r.data_product_name for r in E.health_rows(E.score_tables(results), None, NOW).collect()}
    assert names == {"facts", "ENTERPRISE"}


def test_gate(spark, tables):
    bad = E.run_checks(spark, tables, [Rule("a", "COMPLETENESS", "facts", "v")])
    soft = E.run_checks(spark, tables, [Rule("a", "COMPLETENESS", "facts", "v", "WARNING")])
    assert not E.may_publish(bad, "facts") and E.may_publish(soft, "facts")


def test_samples_follow_the_rule(spark, tables):
    rows = E.sample_failures(tables["facts"], Rule("v", "VALIDITY", "facts", "v", params={"condition": "v > 0"}), ["id"]).collect()
    assert len(rows) == 1 and '"v":-1.0' in rows[0].failing_row
    assert E.sample_failures(tables["facts"], Rule("u", "UNIQUENESS", "facts", "id"), ["k"]).count() == 2


def test_freshness_limit_is_hours_not_a_rate(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-08 00:00:00' AS at")
    params = {"timestamp": "at", "hours": 24, "as_of": NOW}
    got = run(spark, {"t": df}, Rule("old", "FRESHNESS", "t", params=params), Rule("fine", "FRESHNESS", "t", params={**params, "hours": 72}))
    assert got["old"].status == "FAIL" and got["fine"].status == "PASS"


def test_rule_table_keeps_active_rules_only(spark):
    table = spark.createDataFrame(
        [("a", "UNIQUE", "t", "id", "ERROR", 0.0, {"filter": "id > 0"}, True), ("b", "NOT_NULL", "t", "id", "ERROR", 0.0, None, False)],
        "rule_id string, dimension string, table_id string, column_name string, severity string, max_rate double, params map<string,string>, is_active boolean",
    )
    assert list(load_rules(table)) == [[Rule("a", "UNIQUENESS", "t", "id", params={"filter": "id > 0"})]]


def test_row_rules_of_a_table_share_one_scan(spark, tables):
    rules = [Rule(str(i), "VALIDITY", "facts", "v", params={"condition": f"v > {i}"}) for i in range(8)]
    plan = E._planned(rules, tables, spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_a_rule_that_fails_on_its_rows_stops_no_other(spark):
    df = spark.createDataFrame([("1", 1), ("x", 2)], "c string, v int")
    bad = Rule("bad", "VALIDITY", "t", "c", params={"condition": "CAST(c AS INT) > 0"})
    got = run(spark, {"t": df}, Rule("good", "VALIDITY", "t", "v", params={"condition": "v > 1"}), bad, Rule("keys", "UNIQUENESS", "t", "v"))
    assert {k: r.status for k, r in got.items()} == {"good": "FAIL", "bad": "ERROR", "keys": "PASS"}


def test_samples_keep_to_the_filter(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "b")], "k int, g string")
    rule = Rule("u", "UNIQUENESS", "t", "k", params={"filter": "g = 'b'"})
    assert [r.failing_row for r in E.sample_failures(df, rule, ["k"]).collect()] == ['{"k":1,"g":"b"}'] * 2
    late = Rule("f", "VOLUME", "t", params={"date": "k", "ratio": 0.9})
    assert E.sample_failures(df, late, ["k"]).count() == 1
    high = Rule("a", "ACCURACY", "t", "k", params={"sigma": 1})
    assert E.sample_failures(df, high, ["k"]).count() == 1
    both = Rule("c", "CONSISTENCY", "t", "k", params={"other": "o", "by": "g", "other_column": "k"})
    assert E.sample_failures(df, both, ["k"], tables={"o": df.where("g = 'a'")}).count() == 3


def test_a_table_with_a_bad_rule_is_made_twice_at_most(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    table = spark.range(100, numPartitions=1).mapInArrow(count, "id long")
    condition = lambda text: {"condition": text}
    rules = [
        E.Rule("good", "VALIDITY", "t", "id", params=condition("id > 0")), E.Rule("keys", "UNIQUENESS", "t", "id"),
        E.Rule("bad", "VALIDITY", "t", "id", params=condition("CAST(concat('x', id) AS INT) > 0")), E.Rule("layout", "SCHEMA", "t", params={"columns": ["id", "gone"]}),
    ]
    got = {r.rule_id: (r.rows_checked, r.rows_failed, r.status) for r in E.run_checks(spark, {"t": table}, rules).collect()}
    assert got == {"good": (100, 1, "FAIL"), "keys": (100, 0, "PASS"), "bad": (0, -1, "ERROR"), "layout": (2, 1, "FAIL")}
    # A failed task reports no rows: what is counted is the copy that the other rules read.
    assert made.value == 100
