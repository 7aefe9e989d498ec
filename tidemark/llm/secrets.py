"""Multipart credential linking with DataFrame functions only.

Strong parts (assignments, access keys, long hex runs) are always reported.
Weak parts - identifiers, short or blob-like secrets, endpoints - are reported
only when complementary parts lie near them in the same scope: a strong part of
another role, or a part of each of the two other roles. The parts become rows
and meet in an interval join on cells of the scope's text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# What the strong kinds look like.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

IDENT = r"""(?i:(user|username|login|account|client_?id|access_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
PASS = r"""(?i:(pwd|pass|passphrase|credential|private_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{4,})"""
BLOB = r"[A-Za-z0-9+/]{40,}={0,2}"
ENDPOINT = r"""(?i:https?|ftp|s3|redis|mysql|mongodb|postgresql|postgres)://[^\x20\x09-\x0D"'<>]+|(?i:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?\b"""

#: Kinds in the order in which spans that start together are listed.
KINDS = ["assign", "access", "hex", "ident", "pass", "blob", "endpoint"]
ROLES = {"assign": "secret", "access": "access", "hex": "secret", "ident": "access", "pass": "secret", "blob": "secret", "endpoint": "endpoint"}
STRONG = KINDS[:3]
#: Characters between two parts of one credential at most.
REACH = 200
SPAN = "struct<start:bigint,rank:int,stop:bigint>"


def _spans(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 0) -> Column:
    """Spans of all leftmost matches that do not overlap; those whose value is under ``least`` characters are dropped after matching.

    The pieces between the matches and the matches themselves give the places:
    Java's splitting and extraction find the same matches.
    """
    none = F.array().cast(f"array<{SPAN}>")
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    steps = F.arrays_zip(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"), sizes.alias("size"))
    rank = F.lit(KINDS.index(kind))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        return F.struct((start + x["size"]).alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), rank.alias("rank"), (start + x["size"]).alias("stop")))).alias("found"))

    found = F.aggregate(steps, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found")), step, lambda acc: acc["found"])
    if least:
        long_enough = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), lambda v: F.length(v) >= least)
        found = F.filter(found, lambda _, k: F.get(long_enough, k))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["stop"])), ",")


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """Weak spans with complementary parts, by scope. ``parts`` has scope, start, rank and stop, each once."""
    of = lambda names: reduce(lambda a, b: a | b, [F.col("rank") == KINDS.index(k) for k in names])
    role = reduce(lambda c, k: c.when(F.col("rank") == KINDS.index(k), ROLES[k]), KINDS, F.when(F.lit(False), ""))
    parts = parts.withColumns({"role": role, "strong": of(STRONG)})
    cells = lambda low, high: F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach))).alias("cell")
    near = parts.select("scope", cells(F.col("start"), F.col("stop") - 1), "start", "stop", "role", "strong")
    weak = parts.where(~F.col("strong")).select("scope", cells(F.col("start") - reach, F.col("stop") - 1 + reach), F.col("start").alias("w_start"), F.col("rank").alias("w_rank"), F.col("stop").alias("w_stop"), F.col("role").alias("w_role"))
    # A cell has room for a bounded number of parts, so the join's rows stay in proportion to the parts.
    met = weak.join(near, ["scope", "cell"]).where((F.col("start") < F.col("w_stop") + reach) & (F.col("stop") > F.col("w_start") - reach))
    other = F.col("role") != F.col("w_role")
    overlaps = F.col("strong") & (F.col("start") < F.col("w_stop")) & (F.col("stop") > F.col("w_start"))
    seen = met.groupBy("scope", "w_start", "w_rank", "w_stop").agg(
        F.max(other & F.col("strong")).alias("strong"), F.count_distinct(F.when(other, F.col("role"))).alias("roles"), F.max(overlaps).alias("reported")
    )
    kept = seen.where((F.col("strong") | (F.col("roles") == 2)) & ~F.col("reported"))
    return kept.groupBy("scope").agg(F.collect_list(F.struct(F.col("w_start").alias("start"), F.col("w_rank").alias("rank"), F.col("w_stop").alias("stop"))).alias("linked"))


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", reach: int = REACH) -> DataFrame:
    """One row for each row of ``docs``: its id, ``strong`` and ``linked`` spans as arrays of (start, rank, stop).

    Scopes are texts; rows with equal texts share their links, so copies are
    looked at once. A null text is an empty one and has no spans. Places count
    code points from 0, ends are exclusive. Extra columns play no part.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text"))
    strong = F.array_sort(F.concat(
        _spans(F.col("text"), ASSIGN, "assign", 2, ASSIGN_VALUE),
        # A run that is long enough is found whole by asking for the length at once.
        _spans(F.col("text"), rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}", "access"),
        _spans(F.col("text"), rf"[0-9a-f]{{{HEX_LENGTH},}}", "hex"),
    ))
    weak = F.concat(*[_spans(F.col("text"), p, k) for k, p in (("ident", IDENT), ("pass", PASS), ("blob", BLOB), ("endpoint", ENDPOINT))])
    found = base.select("doc_id", strong.alias("strong"), weak.alias("weak"), F.sha2("text", 256).alias("scope"))
    lone = (F.size("weak") == 0) | (F.size("strong") + F.size("weak") < 2)
    rows = cut_lineage(found.withColumns({"scope": F.when(~lone, F.col("scope")), "weak": F.when(lone, F.array().cast(f"array<{SPAN}>")).otherwise(F.col("weak"))}))
    parts = rows.where(F.col("scope").isNotNull()).select("scope", F.explode(F.concat("strong", "weak")).alias("p")).select("scope", "p.*").distinct()
    linked = _linked(parts, reach)
    return rows.join(linked, "scope", "left").select("doc_id", "strong", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")).alias("linked"))


def report(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the strong spans and all spans as text."""
    count = lambda kind: F.size(F.filter("strong", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")
    return find_secrets(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in STRONG], F.sha2(_written(F.col("strong")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("strong", "linked"))).alias("spans"), F.size("linked").cast("bigint").alias("n_linked"),
    )
