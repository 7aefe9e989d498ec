"""Merkle audit against a record-by-record comparison."""

from pyspark.sql import functions as F

from tidemark.llm import fixity

SCHEMA = "page_id bigint, url string, html string"


def pages(spark, n=300):
    rows = [(k, f"http://x/{k}", f"<p>{k}</p>" * (k % 9)) for k in range(n)] + [(5, "http://x/5", "<p>5</p>" * 5), (None, None, None), (n, "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_statuses_are_those_of_the_plain_comparison(spark):
    own = fixity.manifest(pages(spark), file_records=64)
    own = spark.createDataFrame(own.collect(), own.schema)
    hurt = fixity.damage(own)
    got = {r.number: r.status for r in fixity.audit(own, hurt, fan_out=4).collect()}
    theirs = {r.number: r for r in hurt.collect()}
    for r in own.collect():
        t = theirs.get(r.number)
        want = "missing" if t is None else "corrupt" if t.digest != r.digest or t.length != r.length else "moved" if t.offset != r.offset else "ok"
        assert got[r.number] == want, r.number
    assert set(got.values()) == {"ok", "missing", "corrupt", "moved"}


def test_equal_replicas_need_the_root_only(spark):
    own = fixity.manifest(pages(spark, 40))
    own = spark.createDataFrame(own.collect(), own.schema)
    one, two = fixity.tree(own, 3, 4), fixity.tree(own, 3, 4)
    assert fixity.differing_records(one, two, 4).count() == 0
    assert one[-1].count() == 1 and one[-1].first().hash == two[-1].first().hash


def test_extra_records_and_offsets(spark):
    own = fixity.manifest(pages(spark, 20), file_records=8)
    own = spark.createDataFrame(own.collect(), own.schema)
    shorter = own.where("number < 18")
    got = {r.number: r.status for r in fixity.audit(shorter, own).collect()}
    assert [got[k] for k in (17, 18, 22)] == ["ok", "extra", "extra"]
    for f in (0, 1):
        rows = own.where(F.col("file_no") == f).orderBy("number").collect()
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]


def test_pages(spark):
    rows = fixity.audit_pages(pages(spark)).collect()
    assert len(rows) == 303 and {r.status for r in rows} == {"ok", "corrupt", "missing", "moved"}
    assert fixity.audit_pages(spark.createDataFrame([], SCHEMA)).collect() == []
