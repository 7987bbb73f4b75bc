"""Queries and SQL of the ten operators over the driver's tables. Every query reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm import bpe, decontaminate, exact_dedup, langid, line_dedup, ngram_join, pii, sharding, toxicity, url_filter

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Fixed rules of the URL query.
URL_RULES = [
    url_filter.HostRule("allow", "com", "/"),
    url_filter.HostRule("block", "example.com", "/en/"),
    url_filter.HostRule("allow", "www.example.com", "/en/"),
    url_filter.HostRule("block", "net", "/es/"),
    url_filter.HostRule("block", "net", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """Remainder of crc32 of the doc_id as text; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, fold(3) != 1).withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_ranges", "n_removed", "removed", F.concat_ws(",", F.col("sources").cast("array<string>")).alias("sources"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round("containment", 6))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """The model of the query and the pipeline, learnt from the rows whose remainder by 5 is not 0."""
    return toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold(5) != 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.withColumn("held_out", F.coalesce(fold(5) == 0, F.lit(False))).select("doc_id", "held_out", "score", "predicted")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, spaced=True)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_OP1_SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 75 * (p.n + q.n - i)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x AS a, y AS b FROM both_ways UNION SELECT r.a, e.y FROM reach r JOIN both_ways e ON r.b = e.x),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""

_OP3_SQL = r"""
WITH cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
lines AS (SELECT doc_id, pos, regexp_replace(raw, '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS line FROM cut),
sized AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^ \t-\r]+')) AS words FROM lines WHERE line <> ''),
placed AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM sized),
runs AS (SELECT doc_id, pos, array_to_string(list(line) OVER w, chr(10)) AS run, max(pos) OVER w AS stop, max(s + words) OVER w - s AS size
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)),
firsts AS (SELECT run, min((doc_id, pos)) AS f FROM runs WHERE size >= 50 GROUP BY run HAVING count(*) > 1),
later AS (SELECT doc_id, pos, stop, f[1] AS src FROM runs JOIN firsts USING (run) WHERE (doc_id, pos) <> f),
touching AS (SELECT doc_id, pos, max(stop) OVER (PARTITION BY doc_id ORDER BY pos, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev, stop FROM later),
numbered AS (SELECT *, sum(CASE WHEN coalesce(prev, -2) < pos THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos, stop) AS island FROM touching),
ranges AS (SELECT doc_id, island, min(pos) AS a, max(stop) AS b FROM numbered GROUP BY 1, 2),
text AS (SELECT doc_id, count(*) AS n_ranges, CAST(sum(b - a + 1) AS BIGINT) AS n_removed, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM ranges GROUP BY 1),
src AS (SELECT doc_id, string_agg(CAST(src AS VARCHAR), ',' ORDER BY src) AS sources FROM (SELECT DISTINCT doc_id, src FROM later) GROUP BY 1)
SELECT doc_id, n_ranges, n_removed, removed, sources FROM text JOIN src USING (doc_id)
"""

_OP4_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""

_OP6_SQL = f"""
WITH rows AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes, list_reduce(list_transform(range(1, 16), lambda i:
    lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), i, 1) AS INTEGER)), 4, '0')), lambda a, b: a || b) AS bits FROM documents),
up AS (SELECT doc_id, bytes, bits, CAST(d AS INTEGER) AS depth, substr(bits, 1, d) AS shard FROM rows, range(0, 33) r(d)),
buckets AS (SELECT depth, shard, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs, min(bits) = max(bits) AS one FROM up GROUP BY 1, 2),
leaves AS (SELECT b.* FROM buckets b LEFT JOIN buckets p ON p.depth = b.depth - 1 AND p.shard = substr(b.shard, 1, b.depth - 1)
  WHERE (b.shard_bytes <= {sharding.LIMIT_BYTES} OR b.one) AND (b.depth = 0 OR NOT (p.shard_bytes <= {sharding.LIMIT_BYTES} OR p.one)))
SELECT u.doc_id, u.bytes, u.shard, u.depth, l.shard_bytes, l.shard_docs, l.shard_bytes > {sharding.LIMIT_BYTES} AS oversized
FROM up u JOIN leaves l ON l.depth = u.depth AND l.shard = u.shard
"""

_OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ') || '.'] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ') || '.'] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_common, round(n_common / n_item, 6) AS containment FROM c JOIN n USING (item_id) WHERE n_common >= 0.75 * n_item
"""

_OP10_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (SELECT page_id, max((length(h) + length(p), h || p, v)) AS best FROM parts JOIN rules ON ends_with('.' || host, '.' || h) AND starts_with(path, p) GROUP BY 1),
own AS (SELECT *, '.' || host || path AS c FROM parts)
SELECT page_id, host, path, best[2] AS rule, CASE WHEN best IS NOT NULL THEN best[3] WHEN host = '' AND path = '' THEN 'allow'
  WHEN regexp_matches(c, '(?s)^[^/]*(\.ads\.|\.ads-|\.adserver\.|\.tracker\.|casino|-bets\.|pills\.|adult|spam)[^/]*/.*$') OR regexp_matches(c, '(?s)^[^/]*/.*$') AND regexp_matches(c, '(?s)^[^/]*/wp-login.*$|^[^/]*/cgi-bin/.*$|^[^/]*/cart/.*$|^[^/]*/checkout/.*$')
    OR regexp_matches(c, '(?s)^[^/]*\.(exe|zip)$') THEN 'block' ELSE 'allow' END AS verdict
FROM own LEFT JOIN fits USING (page_id)
"""

QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_language_id, op3_line_dedup, op4_exact_dedup, op5_pii, op6_sharding, op7_decontamination, op8_toxicity, op9_bpe, op10_url_filter)}

ORACLES = {
    "op1_ngram_jaccard_join": _OP1_SQL,
    "op3_line_dedup": _OP3_SQL,
    "op4_exact_dedup": _OP4_SQL,
    "op6_sharding": _OP6_SQL,
    "op7_decontamination": _OP7_SQL,
    "op10_url_filter": _OP10_SQL,
}
