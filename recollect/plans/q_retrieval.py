"""Queries of retrieval: dense, lexical, fused, spread, reranked, and the recall pipeline."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from recollect.functions import entities, gate, temporal
from recollect.operators import filters, lexical, rank
from recollect.plans.base import MARKDOWN, POINTS, markdown, points, query, query_vectors, table, vectors
from recollect.runtime import stage

_KNN = """WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x, label FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id AS point_id, round({score}, 6) + 0.0 AS score FROM q, embeddings e {where}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS INTEGER) AS rank FROM s)
SELECT query_id, point_id, score, rank FROM r WHERE rank <= 10"""
_COSINE = "list_cosine_similarity(q.x, e.embedding::DOUBLE[])"


@query(_KNN.format(score=_COSINE, where=""))
def knn_topk(spark, d):
    return rank.dense_topk(vectors(spark, d), query_vectors(spark, d), 10)


@query(_KNN.format(score="list_dot_product(q.x, e.embedding::DOUBLE[])", where=""))
def knn_dot(spark, d):
    return rank.dense_topk(vectors(spark, d), query_vectors(spark, d), 10, "dot")


@query(_KNN.format(score="-list_distance(q.x, e.embedding::DOUBLE[])", where="WHERE q.query_id <> e.vec_id"))
def knn_euclid(spark, d):
    own = rank.dense_topk(vectors(spark, d), query_vectors(spark, d), 11, "euclid").where("query_id != point_id")
    return own.withColumn("rank", F.row_number().over(rank.Window.partitionBy("query_id").orderBy(F.col("score").desc(), "point_id"))).where("rank <= 10")


_SCOPED = f"""WITH {POINTS}, q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x, label FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id AS point_id, round({_COSINE}, 6) + 0.0 AS score FROM q JOIN embeddings e ON e.label = q.label JOIN points p ON p.point_id = e.vec_id
  WHERE kind IN ('click', 'view') AND value >= 1 AND archived IS NULL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS INTEGER) AS rank FROM s)
SELECT query_id, point_id, score, rank FROM r WHERE rank <= 10"""


@query(_SCOPED)
def knn_scoped_filtered(spark, d):
    """Scoped, filtered, archived rows out: the flagship."""
    allowed = filters.matching(points(spark, d), {"kind": {"in": ["click", "view"]}, "value": {"gte": 1}}).select("point_id")
    return rank.dense_topk(vectors(spark, d).join(allowed, "point_id"), query_vectors(spark, d), 10, same="label")


def _docs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "source", "lang")


def _asked(spark, d):
    return table(spark, d, "benchmark").where("item_id % 50 = 0").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


_FOLD = "translate(lower({0}), 'àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇ', 'aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC')"
_TOK = "regexp_extract_all(" + _FOLD + ", '[\\p{{L}}\\p{{N}}]+')"
_INDEX = f"""tok AS (SELECT doc_id AS chunk_id, source, {_TOK.format("coalesce(text, '')")} AS t FROM documents),
dl AS (SELECT chunk_id, source, len(t) AS dl FROM tok), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
post AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(t) AS term FROM tok) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM post GROUP BY 1)"""
_QT = f"""qt AS (SELECT DISTINCT item_id AS query_id, unnest({_TOK.format("text")}) AS term FROM benchmark WHERE item_id % 50 = 0)"""
_BM25 = """sc AS (SELECT query_id, p.chunk_id, round(-sum(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END
  * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qt JOIN post p USING (term) JOIN df USING (term) JOIN dl ON dl.chunk_id = p.chunk_id, st {0} GROUP BY 1, 2),
lex AS (SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS INTEGER) AS rank FROM sc)"""


def _bm25(spark, d):
    docs, terms = _docs(spark, d), lexical.query_terms(_asked(spark, d))
    return lexical.bm25(lexical.postings(docs, "text", asked=terms), lexical.corpus_stats(docs, "text"), terms)


@query(f"WITH {_INDEX}, {_QT}, {_BM25.format('')} SELECT * FROM lex WHERE rank <= 10")
def bm25_topk(spark, d):
    return lexical.topk(_bm25(spark, d), 10)


@query(f"WITH {_INDEX}, {_QT}, {_BM25.format('')}, f AS (SELECT sc.* FROM sc JOIN dl USING (chunk_id) WHERE source IN ('src1', 'src2')), r AS (SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS INTEGER) AS rank FROM f) SELECT * FROM r WHERE rank <= 5")
def bm25_root_filter(spark, d):
    roots = _docs(spark, d).where(F.col("source").isin("src1", "src2")).select("chunk_id")
    return lexical.topk(_bm25(spark, d).join(roots, "chunk_id", "left_semi"), 5).select("query_id", "chunk_id", "score", "rank")


@query(r"SELECT conv_id, turn FROM conversations WHERE contains(' ' || array_to_string(regexp_extract_all(lower(replace(text, ' ', '_')), '[\p{L}\p{N}]+'), ' ') || ' ', ' of the ')")
def bm25_phrase_underscore(spark, d):
    rows = table(spark, d, "conversations").withColumn("snake", F.replace("text", F.lit(" "), F.lit("_")))
    return lexical.phrase_hits(rows, F.col("snake"), "of_the").select("conv_id", "turn")


@query(f"""WITH {_INDEX}, qtf AS (SELECT item_id AS query_id, term, count(*) AS qtf, max(ql) AS ql FROM (SELECT item_id, len(t) AS ql, unnest(t) AS term FROM (SELECT item_id, {_TOK.format("text")} AS t FROM benchmark WHERE item_id % 50 = 0)) GROUP BY 1, 2),
sc AS (SELECT query_id, p.chunk_id, round(sum(qtf * 2.2 / (qtf + 1.2 * (0.25 + 0.75 * ql / 256.0)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / 256.0)) * ln(1 + (n - df + 0.5) / (df + 0.5))), 6) AS score
  FROM qtf JOIN post p USING (term) JOIN df USING (term) JOIN dl ON dl.chunk_id = p.chunk_id, st GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM sc) SELECT * FROM r WHERE rank <= 10""")
def sparse_idf_topk(spark, d):
    docs = _docs(spark, d)
    scores = lexical.sparse_idf(lexical.postings(docs, "text", asked=lexical.query_terms(_asked(spark, d))), lexical.corpus_stats(docs, "text"), _asked(spark, d))
    return lexical.topk(scores, 10, descending=True)


_HYBRID = f"""WITH {_INDEX}, {_QT}, {_BM25.format('')}, q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 50 = 0),
ds AS (SELECT query_id, vec_id AS chunk_id, round({_COSINE}, 6) + 0.0 AS score FROM q, embeddings e),
dn AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM ds),
arms AS (SELECT query_id, chunk_id, rank FROM dn WHERE rank <= 10 UNION ALL SELECT query_id, chunk_id, rank FROM lex WHERE rank <= 10),
fu AS (SELECT query_id, chunk_id AS point_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM arms GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS INTEGER) AS rank FROM fu)"""


def _hybrid(spark, d, k=10):
    dense = rank.dense_topk(vectors(spark, d), query_vectors(spark, d), 10)
    lex = lexical.topk(_bm25(spark, d), 10).withColumnRenamed("chunk_id", "point_id")
    return rank.fused([dense, lex], k)


@query(_HYBRID + " SELECT query_id, point_id, score, rank FROM r WHERE rank <= 10")
def hybrid_rrf(spark, d):
    return _hybrid(spark, d)


_CASCADE = f"""WITH {POINTS}, q(query_id, query) AS (VALUES (1, 'user 7 click'), (2, 'user 99999 purchase'), (3, 'zebra')),
one AS (SELECT query_id, point_id, 'strict' AS level, CAST(NULL AS VARCHAR) AS reason FROM q JOIN points ON list_has_all(string_split(text, ' '), string_split(query, ' '))),
two AS (SELECT query_id, point_id, 'lexical' AS level, 'strict returned no results' AS reason FROM q JOIN points ON list_has_any(string_split(text, ' '), ['purchase']) AND query LIKE '%purchase%' WHERE query_id NOT IN (SELECT query_id FROM one))
SELECT * FROM one UNION ALL SELECT * FROM two"""


@query(_CASCADE)
def cascade_levels(spark, d):
    pts = points(spark, d).select("point_id", F.split("text", " ").alias("w"))
    asked = spark.createDataFrame([(1, "user 7 click"), (2, "user 99999 purchase"), (3, "zebra")], "query_id int, query string")

    def strict(q):
        return F.broadcast(q).join(pts, F.forall(F.split("query", " "), lambda t: F.array_contains("w", t))).select("query_id", "point_id")

    def loose(q):
        return F.broadcast(q.where(F.contains("query", F.lit("purchase")))).join(pts, F.array_contains("w", F.lit("purchase"))).select("query_id", "point_id")

    return rank.cascade(asked, [("strict", strict), ("lexical", loose)]).select("query_id", "point_id", "level", "reason")


@query(f"WITH {POINTS} SELECT point_id, text FROM points WHERE list_has_all(string_split(text, ' '), ['user', 'view', 'item', '3']) ORDER BY point_id LIMIT 15")
def lexical_all_terms(spark, d):
    return lexical.all_terms(points(spark, d), "VIEW user item 3", F.col("text"), 15).select("point_id", "text")


@query(f"""WITH {_INDEX}, {_QT}, {_BM25.format('')}, q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 50 = 0),
l5 AS (SELECT query_id, chunk_id AS point_id, 'lexical' AS tier, rank FROM lex WHERE rank <= 5),
few AS (SELECT query_id FROM q WHERE (SELECT count(*) FROM l5 WHERE l5.query_id = q.query_id) < 2),
sem AS (SELECT query_id, vec_id AS point_id, row_number() OVER (PARTITION BY query_id ORDER BY round({_COSINE}, 6) DESC, vec_id) AS rank FROM q JOIN few USING (query_id), embeddings e)
SELECT query_id, point_id, tier, CAST(rank AS INTEGER) AS rank FROM l5 UNION ALL
SELECT query_id, point_id, 'semantic', CAST(rank AS INTEGER) FROM sem WHERE rank <= 5 AND (query_id, point_id) NOT IN (SELECT query_id, point_id FROM l5)""")
def md_search_auto(spark, d):
    """Lexical hits; queries with fewer than two are also searched by vector, with what lexical search did not find."""
    lex = stage(lexical.topk(_bm25(spark, d), 5).select("query_id", F.col("chunk_id").alias("point_id"), F.lit("lexical").alias("tier"), "rank"), "lexical-tier")
    asked = query_vectors(spark, d)
    enough = lex.groupBy("query_id").agg(F.count("*").alias("n")).where("n >= 2")
    sem = rank.dense_topk(vectors(spark, d), asked.join(enough, "query_id", "left_anti"), 5).select("query_id", "point_id", F.lit("semantic").alias("tier"), "rank")
    return lex.unionByName(sem.join(lex, ["query_id", "point_id"], "left_anti"))


def _candidates(spark, d):
    """Points as candidates: a query for each session, ranked by value."""
    p = points(spark, d)
    order = rank.Window.partitionBy("query_id").orderBy(F.col("score").desc(), "point_id")
    return p.select(F.col("session_id").alias("query_id"), "point_id", F.col("value").alias("score"), "ts", "text").withColumn("rank", F.row_number().over(order)).where("rank <= 12")


_CAND = f"""{POINTS}, cand AS (SELECT * FROM (SELECT session_id AS query_id, point_id, value AS score, ts, text, row_number() OVER (PARTITION BY session_id ORDER BY value DESC, point_id) AS rank FROM points) WHERE rank <= 12)"""
_W0, _W1 = 1704499200.0, 1705363200.0


@query(f"WITH {_CAND} SELECT query_id, point_id, CAST(rank AS INTEGER) AS rank FROM cand WHERE ts >= {_W0} AND ts < {_W1}")
def temporal_window_halfopen(spark, d):
    inside = temporal.in_window(F.col("ts"), F.lit(_W0), F.lit(_W1))
    return _candidates(spark, d).where(inside).select("query_id", "point_id", "rank")


@query(f"WITH {_CAND} SELECT query_id, point_id FROM cand WHERE ts >= {_W0} AND ts <= {_W1}")
def time_range_inclusive(spark, d):
    return _candidates(spark, d).where(temporal.in_range(F.col("ts"), F.lit(_W0), F.lit(_W1))).select("query_id", "point_id")


_SPREAD = """b AS (SELECT *, CASE WHEN hi > lo THEN least(greatest(CAST(trunc((ts - lo) / (hi - lo) * 6) AS BIGINT), 0), 5) ELSE 0 END AS bucket FROM ({0})),
c AS (SELECT *, row_number() OVER (PARTITION BY query_id, bucket ORDER BY rank) <= 2 AS chosen FROM b)"""


@query(f"WITH {_CAND}, {_SPREAD.format('SELECT *, min(ts) OVER (PARTITION BY query_id) AS lo, max(ts) OVER (PARTITION BY query_id) AS hi FROM cand WHERE ts IS NOT NULL')} SELECT query_id, point_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN chosen THEN bucket ELSE 6 END, rank) AS INTEGER) AS rank FROM c")
def bucket_spread(spark, d):
    rows = _candidates(spark, d).where("ts is not null")
    none = F.lit(None).cast("double")
    return rank.bucket_spread(rows, none, none).select("query_id", "point_id", "rank")


_TWIN = f"""marked AS (SELECT *, coalesce(ts >= {{0}} AND ts < {{1}}, false) AS inside FROM cand), hit AS (SELECT *, count(*) FILTER (inside) OVER (PARTITION BY query_id) AS hits FROM marked),
{_SPREAD.format('SELECT *, {0} AS lo, {1} AS hi FROM hit WHERE inside')},
moved AS (SELECT query_id, point_id, 0 AS part, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN chosen THEN bucket ELSE 6 END, rank) AS r FROM c UNION ALL SELECT query_id, point_id, 1, rank FROM hit WHERE hits > 0 AND ts IS NULL)
SELECT query_id, point_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY part, r) AS INTEGER) AS rank FROM moved UNION ALL SELECT query_id, point_id, CAST(rank AS INTEGER) FROM hit WHERE hits = 0"""


@query(f"WITH {_CAND}, {_TWIN.format(_W0, _W1)}")
def temporal_keep_unknown(spark, d):
    return rank.time_window(_candidates(spark, d), F.lit(_W0), F.lit(_W1)).select("query_id", "point_id", "rank")


@query(f"WITH {_CAND}, {_TWIN.format(1.0, 2.0)}")
def temporal_fallback_empty(spark, d):
    return rank.time_window(_candidates(spark, d), F.lit(1.0), F.lit(2.0)).select("query_id", "point_id", "rank")


_PHRASES = {
    "what did we do yesterday": ("2026-10-18", "2026-10-19"),
    "notes from 2023-05-01": ("2023-05-01", None),
    "March 2023 plans": ("2023-03-01", "2023-04-01"),
    "anything before June 2024": (None, "2024-06-01"),
    "since 2023": ("2023-01-01", None),
    "last summer": ("2025-06-01", "2025-09-01"),
    "last week": ("2026-10-12", "2026-10-19"),
    "this month": ("2026-10-01", "2026-11-01"),
    "in december": ("2025-12-01", "2026-01-01"),
    "march through the code": (None, None),
    "2023 roadmap": ("2023-01-01", "2024-01-01"),
    "last weekend": (None, None),
    "after the migration, in 2023": ("2023-01-01", None),
}
_VALUES = ", ".join(f"('{q}', {'NULL' if a is None else repr(a)}, {'NULL' if b is None else repr(b)})" for q, (a, b) in _PHRASES.items())


@query(f"SELECT q AS query, CAST(epoch(CAST(a AS TIMESTAMP)) AS DOUBLE) AS w0, CAST(epoch(CAST(b AS TIMESTAMP)) AS DOUBLE) AS w1 FROM (VALUES {_VALUES}) t(q, a, b)")
def parse_time_ladder(spark, d):
    of = temporal.window_udf(datetime(2026, 10, 19, 14, 30, tzinfo=UTC))
    rows = spark.createDataFrame([(q,) for q in _PHRASES], "query string").withColumn("w", of("query"))
    return rows.select("query", F.col("w.start").alias("w0"), F.col("w.end").alias("w1"))


_TURNS = ["ok thanks", "Good morning everyone!", "who are you", "this token", "👍", "", "hi", "deploy Friday", "thank you very much", "fix it", "what?", "good", "I use spark", "see ya later"]
_TURN_VALUES = ", ".join(f"('{t}')" for t in _TURNS)
_TOKENS = r"regexp_extract_all(lower(t), '\p{L}+')"
_CLOSER = f"regexp_matches(array_to_string({_TOKENS}, ' '), '{gate.CLOSER_PATTERN}')"
_LEADS = ", ".join(f"'{w}'" for w in gate.QUESTION_LEADS)


@query(f"SELECT t, {_CLOSER} AS skip FROM (VALUES {_TURN_VALUES}) v(t) UNION ALL SELECT text, {_CLOSER.replace('lower(t)', 'lower(text)')} FROM conversations")
def gate_store(spark, d):
    fixed = spark.createDataFrame([(t,) for t in _TURNS], "t string")
    own = table(spark, d, "conversations").select(F.col("text").alias("t"))
    return fixed.unionByName(own).select("t", gate.skip_store(F.col("t")).alias("skip"))


@query(f"SELECT t, {_CLOSER} OR (length(trim(t)) < 12 AND NOT contains(t, '?') AND NOT coalesce({_TOKENS}[1] IN ({_LEADS}), false) AND NOT len(list_filter({_TOKENS}, lambda w: length(w) >= 4)) > 0) AS skip FROM (VALUES {_TURN_VALUES}) v(t)")
def gate_recall(spark, d):
    return spark.createDataFrame([(t,) for t in _TURNS], "t string").select("t", gate.skip_recall(F.col("t")).alias("skip"))


@query(r"SELECT conv_id, turn, array_to_string(regexp_extract_all(lower(text), '\p{L}+'), ' ') AS tokens FROM conversations")
def gate_tokens(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(gate.letter_tokens(F.col("text")), " ").alias("tokens"))


_SETS = """ws AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS w FROM cand)"""


@query(f"""WITH RECURSIVE {_CAND}, {_SETS},
fold AS (SELECT query_id, 1 AS step, [rank] AS kept FROM ws WHERE rank = 1
  UNION ALL SELECT f.query_id, f.step + 1, CASE WHEN EXISTS (SELECT 1 FROM ws k WHERE k.query_id = f.query_id AND list_contains(f.kept, k.rank)
    AND (len(list_intersect(k.w, x.w)) / len(list_distinct(k.w || x.w)) >= 0.72 OR len(list_intersect(k.w, x.w)) / least(len(k.w), len(x.w)) >= 0.86)) THEN f.kept ELSE list_append(f.kept, x.rank) END
  FROM fold f JOIN ws x ON x.query_id = f.query_id AND x.rank = f.step + 1),
done AS (SELECT query_id, unnest(kept) AS rank FROM fold QUALIFY step = max(step) OVER (PARTITION BY query_id))
SELECT query_id, rank, point_id FROM done JOIN (SELECT query_id, CAST(rank AS INTEGER) AS rank, point_id FROM cand) USING (query_id, rank)""")
def dedup_jaccard_greedy(spark, d):
    return rank.without_near_copies(_candidates(spark, d)).select("query_id", "rank", "point_id")


@query(f"""WITH {_CAND}, {_SETS} SELECT a.query_id, a.rank AS r1, b.rank AS r2, round(len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)), 6) AS jaccard FROM ws a JOIN ws b ON a.query_id = b.query_id AND a.rank < b.rank""")
def jaccard_pairs(spark, d):
    from recollect.functions.text import space_words

    w = _candidates(spark, d).select("query_id", "rank", space_words(F.col("text")).alias("w"))
    a, b = w.select("query_id", F.col("rank").alias("r1"), F.col("w").alias("a")), w.select("query_id", F.col("rank").alias("r2"), F.col("w").alias("b"))
    pairs = a.join(b, "query_id").where("r1 < r2")  # lists of at most 12 candidates
    return pairs.select("query_id", "r1", "r2", F.round(F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b")), 6).alias("jaccard"))


@query(f"""WITH {_CAND}, sc AS (SELECT *, len(list_intersect(['click', 'item', '3'], string_split(text, ' '))) / 3 AS o FROM cand)
SELECT query_id, point_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY -o, rank) AS INTEGER) AS rank FROM sc""")
def rerank_overlap(spark, d):
    score = rank.word_overlap(F.lit("click item 3"), F.col("text"))
    return rank.reranked(_candidates(spark, d), score).select("query_id", "point_id", "rank")


@query()
def entity_extract(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", entities.mentions(F.col("text")).alias("found"))
    return rows.select("conv_id", "turn", F.array_join("found", "|").alias("entities"))


@query()
def entity_boost(spark, d):
    rows = _candidates(spark, d)
    return rank.boosted(rows, entities.coverage(entities.mentions(F.lit("`click` and `item 3`")), F.col("text"))).select("query_id", "point_id", "score", "rank")


@query()
def recall_pipeline(spark, d):
    """Gate, hybrid candidates, duplicates out, time window, entities, rerank, top 5."""
    asked = _asked(spark, d).where(~gate.skip_recall(F.col("query")))
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("point_id"), "text")
    times = points(spark, d).select("point_id", "ts")
    cand = _hybrid(spark, d).join(asked, "query_id").join(texts, "point_id").join(times, "point_id", "left")
    cand = rank.without_near_copies(cand)
    cand = rank.time_window(cand, F.lit(_W0), F.lit(_W1))
    cand = rank.boosted(cand, entities.coverage(entities.mentions(F.col("query")), F.col("text")))
    return rank.reranked(cand, rank.word_overlap(F.col("query"), F.col("text")), 5).select("query_id", "point_id", "score", "rank")


@query(f"""WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)
SELECT a.vec_id AS v1, b.vec_id AS v2, round(list_cosine_similarity(a.x, b.x), 6) AS cosine FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id WHERE round(list_cosine_similarity(a.x, b.x), 6) >= 0.35""")
def near_dup_pairs(spark, d):
    """Vectors of one block at or above a similarity."""
    found = rank.pairs_at_least(vectors(spark, d), 0.35, "label")
    return found.select(F.col("query_id").alias("v1"), F.col("point_id").alias("v2"), F.col("score").alias("cosine"))


@query(f"""WITH {MARKDOWN} SELECT doc_id, CASE WHEN strpos(lower(body), 'the') > 0 OR strpos(lower(body), 'de') > 0 THEN 1 ELSE 0 END AS hit, length(body) AS size FROM md""")
def snippet_presence(spark, d):
    from recollect.functions.text import without_frontmatter

    body = F.regexp_replace(without_frontmatter(F.col("content")), r"\A# [^\n]*\n\n## [^\n]*\n\n", "")
    low = F.lower(body)
    hit = (F.contains(low, F.lit("the")) | F.contains(low, F.lit("de"))).cast("int")
    return markdown(spark, d).select("doc_id", hit.alias("hit"), F.length(body).cast("long").alias("size"))


@query("""WITH t AS (SELECT doc_id, text, CASE WHEN strpos(lower(text), 'the') > 0 THEN strpos(lower(text), 'the') ELSE strpos(lower(text), 'de') END - 1 AS p FROM documents),
w AS (SELECT *, greatest(0, p - 66) AS a FROM t), e AS (SELECT *, least(length(text), a + 200) AS b FROM w)
SELECT doc_id, CASE WHEN p >= 0 THEN CASE WHEN a > 0 THEN '…' ELSE '' END || replace(substr(text, a + 1, b - a), chr(10), ' ') || CASE WHEN b < length(text) THEN '…' ELSE '' END
  ELSE replace(substr(text, 1, 200), chr(10), ' ') || CASE WHEN length(text) > 200 THEN '…' ELSE '' END END AS snippet FROM e""")
def snippet(spark, d):
    from recollect.functions.text import snippet as cut

    return table(spark, d, "documents").select("doc_id", cut(F.col("text"), F.lit("the de")).alias("snippet"))


