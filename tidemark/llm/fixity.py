"""Merkle fixity audit of WARC archives with replicas.

Pages become WARC records in the order of their ids, a bounded number to an
archive file, each with its byte offset. Records and ordered offset ranges are
hashed into one tree: level 0 hashes each record with its place, every level
above hashes ``FAN_OUT`` neighbours and the byte range they cover. Two replicas
are compared at the root, and only branches that differ are followed down, so
the rows read of a level are the children of the differing nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered
from tidemark.session import run_dir

FAN_OUT = 16
FILE_RECORDS = 1024


def records(pages: DataFrame) -> DataFrame:
    """``record_id, body`` of ``pages(page_id, url, html)``: WARC/1.1 response records; nulls are empty fields."""
    html = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(F.col("page_id").alias("record_id"), F.concat(head, html, F.lit("\r\n\r\n")).alias("body"))


def manifest(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """Place of every record: ``number`` (from 0 by record id, then digest), ``file_no``, ``offset``, ``length``, ``digest``."""
    rows = records(pages).select("record_id", F.octet_length("body").cast("bigint").alias("length"), F.sha2("body", 256).alias("digest"))
    placed = numbered(rows, "record_id", "digest", number="number").drop("population").withColumn("file_no", F.expr(f"number div {file_records}"))
    # A file has a bounded number of records.
    before = Window.partitionBy("file_no").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def damage(original: DataFrame, kinds: dict[int, str] | None = None, modulus: int = 97) -> DataFrame:
    """A replica for drills: of ``number % modulus`` the classes in ``kinds`` are ``flipped``, ``cut`` or ``lost``.

    A cut record moves the later ones of its file; a lost one leaves a hole.
    """
    kinds = kinds or {13: "flipped", 41: "cut", 71: "lost"}
    kind = F.lit(None).cast("string")
    for k, what in kinds.items():
        kind = F.when(F.col("number") % modulus == k, what).otherwise(kind)
    hurt = original.withColumn("kind", kind)
    hurt = hurt.withColumn("digest", F.when(F.col("kind").isin("flipped", "cut"), F.sha2(F.concat("digest", "kind"), 256)).otherwise(F.col("digest")))
    hurt = hurt.withColumn("length", F.when(F.col("kind") == "cut", F.expr("length div 2")).when(F.col("kind") == "lost", 0).otherwise(F.col("length")))
    before = Window.partitionBy("file_no").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    moved = hurt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return moved.where(~F.coalesce(F.col("kind") == "lost", F.lit(False))).drop("kind")


def _leaves(rows: DataFrame) -> DataFrame:
    entry = F.concat_ws(":", "record_id", "file_no", "offset", "length", "digest")
    return rows.select(F.col("number").alias("node"), F.sha2(entry, 256).alias("hash"), F.col("file_no").alias("first_file"), "offset", F.col("file_no").alias("last_file"), (F.col("offset") + F.col("length")).alias("stop"))


def _above(level: DataFrame, fan_out: int) -> DataFrame:
    """Each parent hashes its at most ``fan_out`` children in order, with the range of bytes they cover."""
    child = F.struct("node", "hash", "first_file", "offset", "last_file", "stop")
    groups = level.groupBy(F.expr(f"node div {fan_out}").alias("parent")).agg(F.array_sort(F.collect_list(child)).alias("c"))
    first, last = F.element_at("c", 1), F.element_at("c", -1)
    joined = F.array_join(F.transform("c", lambda x: F.concat_ws(":", (x["node"] % fan_out).cast("string"), x["hash"])), ",")
    text = F.concat_ws("|", first["first_file"], first["offset"], last["last_file"], last["stop"], joined)
    return groups.select(F.col("parent").alias("node"), F.sha2(text, 256).alias("hash"), first["first_file"].alias("first_file"), first["offset"].alias("offset"), last["last_file"].alias("last_file"), last["stop"].alias("stop"))


def tree(rows: DataFrame, height: int, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels 0 (records) to ``height`` (one node), each written in the shared folder."""
    spark = rows.sparkSession
    folder, levels = run_dir(spark, "merkle"), []
    for k in range(height + 1):
        made = _leaves(rows) if k == 0 else _above(levels[-1], fan_out)
        made.write.parquet(f"{folder}/{k}")
        levels.append(spark.read.parquet(f"{folder}/{k}"))
    return levels


def differing_records(one: list[DataFrame], other: list[DataFrame], fan_out: int = FAN_OUT) -> DataFrame:
    """``node`` numbers of the records that differ, found from the root down.

    A node of one tree alone differs. Each level joins the children of the
    differing nodes only, of either tree.
    """
    bad = None
    for a, b in zip(reversed(one), reversed(other)):
        if bad is not None:
            parent = F.expr(f"node div {fan_out}")
            a, b = (t.withColumn("parent", parent).join(bad.withColumnRenamed("node", "parent"), "parent", "left_semi") for t in (a, b))
        same = F.col("x.hash").eqNullSafe(F.col("y.hash"))
        bad = a.alias("x").join(b.alias("y"), F.col("x.node") == F.col("y.node"), "full").where(~same).select(F.coalesce("x.node", "y.node").alias("node"))
    return bad


def audit(original: DataFrame, replica: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """``original`` (a manifest) with the replica's offset, length and ``status`` of every record.

    ``ok``; ``moved`` (same bytes elsewhere in the file), ``corrupt`` (other bytes
    or length), ``missing``, and ``extra`` for records of the replica alone. The
    detail of a record is looked up only under differing branches.
    """
    top = max(x.agg(F.max("number")).first()[0] or 0 for x in (original, replica))
    height = 0
    while fan_out**height <= top:
        height += 1
    bad = differing_records(tree(original, height, fan_out), tree(replica, height, fan_out), fan_out).withColumnRenamed("node", "number")
    theirs = replica.join(bad, "number").select("number", F.lit(True).alias("there"), *[F.col(c).alias(f"replica_{c}") for c in ("record_id", "file_no", "offset", "length", "digest")])
    found = bad.join(theirs, "number", "left").withColumn("differs", F.lit(True))
    rows = original.join(found, "number", "full")
    status = (
        F.when(F.col("digest").isNull(), "extra").when(F.col("differs").isNull(), "ok").when(F.col("there").isNull(), "missing")
        .when(F.col("digest").eqNullSafe(F.col("replica_digest")) & F.col("record_id").eqNullSafe(F.col("replica_record_id")), "moved").otherwise("corrupt")
    )
    mine = lambda c: F.coalesce(F.col(c), F.col(f"replica_{c}")).alias(c)
    kept = F.col("differs").isNull()
    return rows.select(
        mine("record_id"), "number", mine("file_no"), "offset", "length", "digest",
        F.when(kept, F.col("offset")).otherwise(F.col("replica_offset")).alias("replica_offset"),
        F.when(kept, F.col("length")).otherwise(F.col("replica_length")).alias("replica_length"), status.alias("status"),
    )


def audit_pages(pages: DataFrame) -> DataFrame:
    """Audits the pages' archives against a replica with drilled damage; one row a record.

    Null ids come first, repeated pages are records of their own, an empty table has no rows.
    """
    own = manifest(pages)
    folder = run_dir(pages.sparkSession, "manifest")
    own.write.parquet(f"{folder}/own")
    own = pages.sparkSession.read.parquet(f"{folder}/own")
    damage(own).write.parquet(f"{folder}/replica")
    return audit(own, pages.sparkSession.read.parquet(f"{folder}/replica"))
