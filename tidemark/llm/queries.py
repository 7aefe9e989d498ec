"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, fixity, jaccard, langid, lm, negatives, packing, phrases, pii, pivots, secrets, sharding, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, oracle: str | None = None):
    def add(build: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(spark.read.parquet(f"{folder}/{table}.parquet"))
        if oracle:
            ORACLES[name] = oracle
        return build

    return add


def _secret_sql() -> str:
    """The scan as joins of match positions; splitting and extraction by RE2 instead of Java."""
    S = secrets
    patterns = [S.ASSIGN, rf"AKIA[A-Z0-9]{{{S.ACCESS_LENGTH - 4},}}", rf"[0-9a-f]{{{S.HEX_LENGTH},}}", S.IDENT, S.PASS, S.BLOB, S.ENDPOINT]
    quoted = [p.replace("'", "''") for p in patterns]
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS m, {f"regexp_extract_all(text, '{p}', 2)" if k == 0 else 'm'} AS v FROM d WHERE regexp_matches(text, '{p}')"
        for k, p in enumerate(quoted)
    )
    names = "[" + ", ".join(f"'{k}'" for k in S.KINDS) + "]"
    roles = "[" + ", ".join(f"'{S.ROLES[k]}'" for k in S.KINDS) + "]"
    text = f"concat({names}[kind + 1], ':', start, ':', stop)"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
      f AS ({found}),
      u AS (SELECT rid, kind, unnest(range(len(m))) AS i, unnest(g[:len(m)]) AS gap, unnest(m) AS hit, unnest(v) AS val FROM f),
      s AS (SELECT rid, kind, val, (sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i))::BIGINT AS stop, stop - length(hit) AS start FROM u),
      p AS (SELECT rid, kind, start, stop, kind < 3 AS strong, {roles}[kind + 1] AS role FROM s WHERE kind <> 0 OR length(val) >= {S.ASSIGN_VALUE}),
      w AS (SELECT w.rid, w.kind, w.start, w.stop FROM p w JOIN p o ON o.rid = w.rid AND o.start < w.stop + {S.REACH} AND o.stop > w.start - {S.REACH} WHERE NOT w.strong GROUP BY ALL
        HAVING (bool_or(o.strong AND o.role <> w.role) OR count(DISTINCT o.role) FILTER (o.role <> w.role) = 2) AND NOT bool_or(o.strong AND o.start < w.stop AND o.stop > w.start)),
      b AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h, string_agg({text}, ',' ORDER BY start, kind) AS t FROM p WHERE strong GROUP BY rid),
      e AS (SELECT rid, string_agg({text}, ',' ORDER BY start, kind) AS t, count(*) FILTER (kind >= 3) AS n FROM (SELECT rid, kind, start, stop FROM p WHERE strong UNION ALL FROM w) GROUP BY rid)
      SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256, coalesce(e.t, '') AS spans, coalesce(n, 0) AS n_linked
      FROM d LEFT JOIN b USING (rid) LEFT JOIN e USING (rid)"""


#: Without the tree: each record beside its damaged replica.
_FIXITY_SQL = f"""WITH r AS (SELECT page_id AS record_id, coalesce(html, '') AS h, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
        'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(h), chr(13), chr(10), chr(13), chr(10), h, chr(13), chr(10), chr(13), chr(10)) AS body FROM pages),
      n AS (SELECT record_id, strlen(body) AS length, sha256(body) AS digest, row_number() OVER (ORDER BY record_id NULLS FIRST, digest) - 1 AS number FROM r),
      m AS (SELECT *, number // {fixity.FILE_RECORDS} AS file_no, CASE number % 97 WHEN 13 THEN 'flipped' WHEN 41 THEN 'cut' WHEN 71 THEN 'lost' END AS kind,
        CASE kind WHEN 'cut' THEN length // 2 WHEN 'lost' THEN 0 ELSE length END AS left_over FROM n),
      o AS (SELECT *, (sum(length) OVER w - length)::BIGINT AS "offset", (sum(left_over) OVER w - left_over)::BIGINT AS moved FROM m WINDOW w AS (PARTITION BY file_no ORDER BY number))
      SELECT record_id, number, file_no, "offset", length, digest, if(kind = 'lost', NULL, moved) AS replica_offset, if(kind = 'lost', NULL, left_over) AS replica_length,
        CASE WHEN kind = 'lost' THEN 'missing' WHEN kind IS NOT NULL THEN 'corrupt' WHEN moved <> "offset" THEN 'moved' ELSE 'ok' END AS status FROM o"""


#: Every n-gram by itself, counted apart for each length.
_PHRASE_SQL = """WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
      w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
      g AS (SELECT lang, j, unnest([ws[i:i + j - 1] for i in range(1, len(ws) - j + 2)]) AS g FROM w, range(1, 6) AS s(j)),
      c AS (SELECT lang, j, g, array_to_string(g, ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
      n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
      d AS (SELECT * FROM c WHERE j > 1 AND NOT EXISTS (SELECT 1 FROM c o WHERE o.lang = c.lang AND o.j > c.j AND 100 * o.f >= 100 * c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
      k AS (SELECT d.lang, d.phrase, d.f AS a, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * d.f * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score, x.j AS k
        FROM d JOIN n ON n.lang = d.lang JOIN c x ON x.lang = d.lang AND x.j < d.j AND x.g = d.g[:x.j] JOIN c y ON y.lang = d.lang AND y.j = d.j - x.j AND y.g = d.g[x.j + 1:]),
      b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b QUALIFY rank <= 2000"""


#: Every anchor beside every row.
_NEGATIVE_SQL = """WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS anchor_id, a.label AS own, o.vec_id, o.label, list_dot_product(a.v, o.v)::BIGINT AS score FROM e a JOIN e o ON o.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
      p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
      SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3"""


#: Every pair of rows with a common shingle, then reachability.
_JACCARD_SQL = """WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
      s AS (SELECT rid, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS g FROM w),
      x AS (SELECT rid, len(g) AS n, unnest(g) AS g FROM s),
      j AS (SELECT a.rid AS a, b.rid AS b FROM x a JOIN x b ON a.g = b.g AND a.rid <> b.rid GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
      r AS (SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, j.b FROM r JOIN j ON r.b = j.a),
      c AS (SELECT a, min(doc_id) AS component_id FROM r JOIN w ON w.rid = r.b GROUP BY a)
      SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN c ON c.a = s.rid"""


@query("op1_secret_scan", "documents", _secret_sql())
def op1(docs: DataFrame) -> DataFrame:
    return secrets.report(docs)


@query("op2_lm_score", "documents")
def op2(docs: DataFrame) -> DataFrame:
    return lm.score_documents(docs)


@query("op3_shard", "documents")
def op3(docs: DataFrame) -> DataFrame:
    return sharding.shard_documents(docs)


@query("op4_language_id", "documents")
def op4(docs: DataFrame) -> DataFrame:
    return langid.identify(docs)


@query("op5_fixity_audit", "pages", _FIXITY_SQL)
def op5(pages: DataFrame) -> DataFrame:
    return fixity.audit_pages(pages)


@query("op6_best_fit_pack", "documents")
def op6(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs)


@query("op7_pseudonyms", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return pii.report(docs)


@query("op8_pivot_search", "embeddings")
def op8(vectors: DataFrame) -> DataFrame:
    return pivots.nearest(vectors)


@query("op9_simhash_dedup", "documents")
def op9(docs: DataFrame) -> DataFrame:
    found = simhash.near_duplicates(docs)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES["op10_decontaminate"] = op10


@query("op11_phrases", "documents", _PHRASE_SQL)
def op11(docs: DataFrame) -> DataFrame:
    return phrases.collocations(docs)


@query("op12_hard_negatives", "embeddings", _NEGATIVE_SQL)
def op12(vectors: DataFrame) -> DataFrame:
    return negatives.hard_negatives(vectors)


@query("op13_jaccard_join", "documents", _JACCARD_SQL)
def op13(docs: DataFrame) -> DataFrame:
    return jaccard.joined(docs)
