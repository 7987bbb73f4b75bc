"""Queries of the document index, maintenance jobs, sessions and logs, and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from recollect.functions import text as T
from recollect.operators import docindex, evaluation, lexical, rank, store
from recollect.plans.base import MESSAGES, NOW, POINTS, messages, points, query, table, vectors
from recollect.runtime import scratch, shared_dir
from recollect.sources import readers

_INDEXES: dict[tuple[str, str, str], docindex.LexicalIndex] = {}


def _turn_files(spark, d):
    """Conversation turns as files of one chunk each."""
    m = messages(spark, d)
    path = F.concat_ws("/", F.concat(F.lit("root"), (F.col("session_id") % 3).cast("string")), F.col("session_id").cast("string"), F.concat(F.lit("t"), F.col("msg_id").cast("string")))
    content = F.replace(F.substring("text", 1, 1300), F.lit("#"), F.lit(" "))
    return m.select(path.alias("path"), docindex.root_of(path).alias("root"), content.alias("content"), F.sha2(content, 256).alias("sha"), "session_id", "msg_id", "text").where(T.stripped(content) != "")


_FILES = f"""{MESSAGES}, f AS (SELECT 'root' || (session_id % 3) || '/' || session_id || '/t' || msg_id AS path, 'root' || (session_id % 3) AS root, replace(substr(text, 1, 1300), '#', ' ') AS content, session_id, msg_id, text FROM messages WHERE regexp_matches(replace(substr(text, 1, 1300), '#', ' '), '\\S'))"""
_TOKENS = "regexp_extract_all(lower(strip_accents({0})), '[\\p{{L}}\\p{{N}}]+')"
_INDEX_SQL = f"""{_FILES}, tok AS (SELECT path, root, {_TOKENS.format("path")} AS a, {_TOKENS.format("content")} AS c FROM f), dl AS (SELECT path, root, 2 * len(a) + len(c) AS dl FROM tok),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), post AS (SELECT path, term, count(*) AS tf FROM (SELECT path, unnest(a || a || c) AS term FROM tok) GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
q AS (SELECT DISTINCT session_id * 100 + msg_id AS query_id, unnest({_TOKENS.format("substr(text, 1, 60)")}) AS term FROM messages WHERE session_id % 50 = 0),
sc AS (SELECT query_id, path, root, round(-sum(CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM q JOIN post USING (term) JOIN df USING (term) JOIN dl USING (path), st GROUP BY 1, 2, 3)"""


def _index(spark, d) -> docindex.LexicalIndex:
    """The index over the turns, written once for each session and folder."""
    key = (spark.sparkContext.applicationId, d, shared_dir(spark))
    if key not in _INDEXES:
        own = docindex.LexicalIndex(spark, scratch(spark, "index"))
        own.replace(_turn_files(spark, d))
        _INDEXES[key] = own
    return _INDEXES[key]


def _turn_queries(spark, d):
    return messages(spark, d).where("session_id % 50 = 0").select((F.col("session_id") * 100 + F.col("msg_id")).alias("query_id"), F.substring("text", 1, 60).alias("query"))


@query(f"WITH {_INDEX_SQL}, r AS (SELECT query_id, path, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, path) AS INTEGER) AS rank FROM sc) SELECT * FROM r WHERE rank <= 5")
def index_search(spark, d):
    return _index(spark, d).search(_turn_queries(spark, d), 5).select("query_id", "path", "score", "rank")


@query(f"WITH {_INDEX_SQL}, r AS (SELECT query_id, path, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, path) AS INTEGER) AS rank FROM sc WHERE root = 'root1') SELECT * FROM r WHERE rank <= 5")
def index_search_root(spark, d):
    return _index(spark, d).search(_turn_queries(spark, d), 5, root="root1").select("query_id", "path", "score", "rank")


@query(f"""WITH {_FILES}, tok AS (SELECT path, {_TOKENS.format("path")} AS a, {_TOKENS.format("content")} AS c FROM f), dl AS (SELECT path, 2 * len(a) + len(c) AS dl FROM tok), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
q AS (SELECT DISTINCT session_id * 100 + msg_id AS query_id, {_TOKENS.format("text")}[1:2] AS w FROM messages WHERE session_id % 50 = 0),
u AS (SELECT DISTINCT w FROM q WHERE len(w) = 2), hit AS (SELECT w, path, len(list_filter(range(1, len(c)), lambda i: c[i] = w[1] AND c[i + 1] = w[2])) AS f FROM u, tok), own AS (SELECT * FROM hit WHERE f > 0), df AS (SELECT w, count(*) AS df FROM own GROUP BY 1)
SELECT query_id, path, round(-CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score FROM q JOIN own USING (w) JOIN df USING (w) JOIN dl USING (path), st""")
def index_phrase(spark, d):
    """Two words joined by an underscore are a phrase."""
    words = T.index_tokens(F.col("text"))
    asked = messages(spark, d).where("session_id % 50 = 0").select((F.col("session_id") * 100 + F.col("msg_id")).alias("query_id"), F.array_join(F.slice(words, 1, 2), "_").alias("query")).where(F.contains("query", F.lit("_")))
    return _index(spark, d).search(asked, 1 << 30).select("query_id", "path", "score")


@query(f"""WITH {_FILES}, g AS (SELECT path, root, CASE WHEN session_id % 5 = 0 THEN 'new ' || content ELSE content END AS content FROM f WHERE session_id % 7 <> 0)
SELECT path, root, sha256(content) AS sha, CAST(1 AS BIGINT) AS chunks, CAST(2 * len({_TOKENS.format("path")}) + len({_TOKENS.format("content")}) AS BIGINT) AS tokens FROM g""")
def index_replace_drop(spark, d):
    """Files indexed, some replaced, some dropped, what no version points to compacted away."""
    files = _turn_files(spark, d)
    own = docindex.LexicalIndex(spark, scratch(spark, "index"))
    own.replace(files)
    content = F.concat(F.lit("new "), F.col("content"))
    own.replace(files.where("session_id % 5 = 0").withColumn("content", content).withColumn("sha", F.sha2("content", 256)))
    own.drop(files.where("session_id % 7 = 0").select("path"))
    own.compact()
    return own.files().select("path", "root", "sha", "chunks", "tokens")


@query(f"WITH {_FILES} SELECT count(*) AS files, count(*) AS chunks, round(avg(2 * len({_TOKENS.format('path')}) + len({_TOKENS.format('content')})), 6) AS avgdl FROM f")
def index_stats(spark, d):
    return _index(spark, d).stats().select("files", "chunks", F.round("avgdl", 6).alias("avgdl"))


@query("SELECT * FROM (VALUES ('a', '3'), ('b', '2')) t(k, v)")
def index_meta(spark, d):
    own = docindex.LexicalIndex(spark, scratch(spark, "index"))
    for rows in ([("a", "1"), ("b", "2")], [("a", "3")]):
        own.set_meta(spark.createDataFrame(rows, "k string, v string"))
    return own.meta()


_MODES = """WITH lex(query_id, path, rank) AS (VALUES (1, 'a', 1), (1, 'b', 2), (2, 'a', 1)), sem(query_id, path, rank) AS (VALUES (1, 'c', 1), (2, 'a', 1), (2, 'd', 2), (2, 'd', 3), (3, 'e', 1)),
modes(mode) AS (VALUES ('off'), ('auto'), ('always')), n AS (SELECT query_id, count(*) AS n FROM lex GROUP BY 1)
SELECT mode, query_id::BIGINT AS query_id, path, 'lexical' AS tier, rank FROM modes, lex UNION ALL
SELECT mode, s.query_id::BIGINT, s.path, 'semantic', min(s.rank) FROM modes, sem s LEFT JOIN n USING (query_id) WHERE (mode = 'always' OR (mode = 'auto' AND coalesce(n, 0) < 2)) AND (s.query_id, s.path) NOT IN (SELECT query_id, path FROM lex) GROUP BY 1, 2, 3"""


@query(_MODES)
def md_search_modes(spark, d):
    """The three modes over two fixed tiers: what the second adds, path by path."""
    q = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    lex = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 1)], "query_id long, path string, rank int")
    sem = spark.createDataFrame([(1, "c", 1), (2, "a", 1), (2, "d", 2), (2, "d", 3), (3, "e", 1)], "query_id long, path string, rank int")
    within = lambda rows: lambda asked: rows.join(asked, "query_id", "left_semi")
    out = None
    for mode in docindex.MODES:
        hits, _ = docindex.md_search(q, within(lex), within(sem), mode)
        one = hits.withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out


# --- maintenance

_DECAY = f"""{POINTS}, sc AS (SELECT *, pow(0.5, greatest(({NOW} - ts) / 86400.0, 0) / 5.0) AS score FROM points),
dec AS (SELECT *, CASE WHEN importance >= 0.7 OR coalesce(lower(trim(source)) IN ('cli', 'tui'), false) THEN 'exempt' WHEN ts IS NULL THEN 'no_timestamp' WHEN score < 0.05 THEN 'archive' ELSE 'keep' END AS decision FROM sc)"""


@query(f"WITH {_DECAY} SELECT count(*) AS considered, count(*) FILTER (decision = 'exempt') AS exempt, count(*) FILTER (decision = 'no_timestamp') AS no_timestamp, count(*) FILTER (decision = 'archive') AS below FROM dec")
def decay_counters(spark, d):
    return store.decay_counters(store.decay_plan(points(spark, d), NOW, 5.0))


@query(f"WITH {_DECAY} SELECT point_id, CASE WHEN decision = 'archive' THEN true ELSE archived END AS archived FROM dec")
def decay_apply(spark, d):
    p = points(spark, d)
    return store.flagged(p, store.decay_flags(store.decay_plan(p, NOW, 5.0)), "point_id", "archived").select("point_id", "archived")


@query(f"WITH {POINTS} SELECT point_id, CASE WHEN archived THEN false ELSE archived END AS archived FROM points")
def decay_unarchive(spark, d):
    p = points(spark, d)
    return store.flagged(p, store.unarchived_flags(p), "point_id", "archived").select("point_id", "archived")


@query()
def semantic_dedup(spark, d):
    """Vectors of one label, newest (greatest id) first: later members of a cluster are superseded by its first."""
    v = vectors(spark, d).withColumn("ts", F.col("point_id").cast("double"))
    return store.duplicate_flags(v, "label", 0.35, allow_unbounded=True)


@query(f"WITH {POINTS} SELECT point_id FROM points WHERE point_id % 4 <> 0")
def sparse_missing(spark, d):
    p = points(spark, d)
    done = p.where("point_id % 4 = 0").select("point_id", F.array(F.lit(1)).alias("indices")).unionByName(p.where("point_id % 4 = 1").select("point_id", F.array().cast("array<int>").alias("indices")))
    return store.without_sparse(p, done).select("point_id")


@query("SELECT event_id AS point_id, CAST(NULL AS BIGINT) AS superseded_by, event_type AS kind FROM events")
def schema_widened(spark, d):
    rows = table(spark, d, "events").select(F.col("event_id").alias("point_id"), F.col("event_type").alias("kind"))
    return store.widened(rows, {"superseded_by": "long", "kind": "string"}).select("point_id", "superseded_by", "kind")


@query("""WITH w AS (SELECT event_type AS collection, epoch_us(ts) / 1e6 AS ts, event_id, value < 100 AS ok, 'e' || event_id AS error FROM events QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) = 1)
SELECT collection, max(ts) AS last_write, max(ts) FILTER (ok) AS last_good, count(*) FILTER (NOT ok) AS failures, CASE WHEN NOT arg_max(ok, ts) THEN arg_max(error, ts) END AS error FROM w GROUP BY 1""")
def write_status(spark, d):
    ts = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1e6
    e = table(spark, d, "events").groupBy("event_type", "ts").agg(F.min("event_id").alias("event_id"), F.min_by("value", "event_id").alias("value"))
    return store.newest_status(e.select(F.col("event_type").alias("collection"), ts.alias("ts"), (F.col("value") < 100).alias("ok"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error")))


# --- ranking

@query(f"""WITH {POINTS}, c AS (SELECT session_id AS query_id, point_id, text, row_number() OVER (PARTITION BY session_id ORDER BY value DESC, point_id) AS rank FROM points),
k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY query_id, text ORDER BY rank) = 1) SELECT query_id, point_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS rank FROM k""")
def first_per_text(spark, d):
    order = rank.Window.partitionBy("query_id").orderBy(F.col("value").desc(), "point_id")
    rows = points(spark, d).withColumnRenamed("session_id", "query_id").withColumn("rank", F.row_number().over(order))
    return rank.first_per_text(rows).select("query_id", "point_id", "rank")


@query("""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT query_id, vec_id AS point_id, round(list_cosine_similarity(x, embedding::DOUBLE[]), 6) AS score FROM q, embeddings)
SELECT query_id, point_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 3""")
def hybrid_dense_only(spark, d):
    """The sparse arm fails while it runs; the dense candidates stay."""
    v = vectors(spark, d)
    dense = rank.dense_topk(v, v.where("point_id % 50 = 0").select(F.col("point_id").alias("query_id"), "dense"), 5)

    def broken():
        return dense.withColumn("rank", F.raise_error(F.lit("no sparse part")).cast("int"))

    return rank.hybrid(dense, broken, 3).select("query_id", "point_id", "rank")


@query("SELECT * FROM (VALUES (1, 10, 'second', 'first failed: PySparkRuntimeError', true), (2, 20, 'third', 'first failed: PySparkRuntimeError', true)) t(query_id, point_id, level, reason, degraded)")
def cascade_failures(spark, d):
    """A level that fails when it runs is passed over; what was tried is told."""
    asked = spark.createDataFrame([(1,), (2,), (3,)], "query_id int")
    fails = lambda q: q.select("query_id", F.raise_error(F.lit("down")).cast("int").alias("point_id"))
    some = lambda i, p: lambda q: q.where(F.col("query_id") == i).select("query_id", F.lit(p).alias("point_id"))
    out = rank.cascade(asked, [("first", fails), ("second", some(1, 10)), ("third", some(2, 20))])
    return out.select("query_id", "point_id", "level", F.regexp_replace("reason", r"(?s)(failed: )\w+:.*", "$1PySparkRuntimeError").alias("reason"), "degraded")


@query("SELECT vec_id AS point_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 9) AS c FROM embeddings")
def cosine_pairs(spark, d):
    return vectors(spark, d).select("point_id", F.round(rank.cosine(F.col("dense"), F.reverse("dense")), 9).alias("c"))


# --- measures

_RANKS = "r AS (SELECT item_id, CASE WHEN item_id % 7 <> 0 THEN CAST(item_id % 12 + 1 AS INTEGER) END AS a, CASE WHEN item_id % 5 <> 0 THEN CAST(item_id % 9 + 1 AS INTEGER) END AS b FROM benchmark)"


@query(f"WITH {_RANKS} SELECT k, count(*) FILTER (coalesce(a <= k, false) AND NOT coalesce(b <= k, false)) AS wins, count(*) FILTER (coalesce(b <= k, false) AND NOT coalesce(a <= k, false)) AS losses FROM r, (VALUES (5), (10)) t(k) GROUP BY 1")
def win_loss_at(spark, d):
    i = F.col("item_id")
    rows = table(spark, d, "benchmark").select(F.when(i % 7 != 0, i % 12 + 1).alias("a"), F.when(i % 5 != 0, i % 9 + 1).alias("b"))
    one = lambda k: rows.agg(*[c.alias(n) for c, n in zip(evaluation.win_loss(F.col("a"), F.col("b"), k), ("wins", "losses"), strict=True)]).withColumn("k", F.lit(k))
    return one(5).unionByName(one(10)).select("k", "wins", "losses")


@query("SELECT user_id, list_sort(list(value))[len(list(value)) // 2 + 1] AS p50 FROM events GROUP BY 1")
def crude_median(spark, d):
    lists = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("value")).alias("v"))
    return lists.select("user_id", evaluation.crude_median(F.col("v")).alias("p50"))


@query("""WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY 1) SELECT event_type, v[CAST(greatest(1, ceil(len(v) * 50 / 100.0)) AS INTEGER)] AS p50, v[CAST(greatest(1, ceil(len(v) * 95 / 100.0)) AS INTEGER)] AS p95 FROM s""")
def percentile_by_counts(spark, d):
    return evaluation.nearest_rank_by(table(spark, d, "events"), "event_type", "value", (50, 95))


@query("""WITH t AS (SELECT item_id, CASE WHEN item_id % 7 <> 0 THEN item_id % 12 + 1 END AS t, (item_id % 10) / 10.0::DOUBLE AS st FROM benchmark), x AS (SELECT item_id, CASE WHEN item_id % 5 <> 0 THEN item_id % 9 + 1 END AS x, (item_id % 13) / 13.0::DOUBLE AS sx FROM benchmark WHERE item_id % 3 <> 0)
SELECT item_id AS "case", t IS NOT NULL OR x IS NOT NULL AS decidable, (t IS NOT NULL OR x IS NOT NULL) AND coalesce(t, 11) < coalesce(x, 11) AS beats, CASE WHEN t IS NOT NULL AND x IS NOT NULL THEN round(abs(st - sx), 9) END AS margin FROM t JOIN x USING (item_id)""")
def case_margins(spark, d):
    i = F.col("item_id")
    b = table(spark, d, "benchmark")
    targets = b.select(i.alias("case"), F.when(i % 7 != 0, i % 12 + 1).alias("rank"), ((i % 10) / 10.0).alias("score"))
    distractors = b.where(i % 3 != 0).select(i.alias("case"), F.when(i % 5 != 0, i % 9 + 1).alias("rank"), ((i % 13) / 13.0).alias("score"))
    return evaluation.case_margins(targets, distractors).withColumn("margin", F.round("margin", 9))


@query("SELECT item_id, length(trim(text)) >= 200 AS long FROM benchmark")
def substantive_answers(spark, d):
    return table(spark, d, "benchmark").select("item_id", evaluation.substantive(F.col("text"), 200).alias("long"))


# --- sessions, logs and small functions

@query(f"""WITH {MESSAGES}, k AS (SELECT session_id, msg_id, role, text, CASE WHEN msg_id % 2 = 1 THEN 'a' END AS tools FROM messages WHERE role IN ('user', 'assistant') AND (trim(text) <> '' OR msg_id % 2 = 1)),
t AS (SELECT session_id, count(*) AS n, string_agg('## ' || role || ' (' || msg_id || ')' || CASE WHEN trim(text) <> '' THEN chr(10) || chr(10) || text ELSE '' END || CASE WHEN tools IS NOT NULL THEN chr(10) || chr(10) || '*tools: ' || tools || '*' ELSE '' END, chr(10) || chr(10) ORDER BY msg_id) AS turns FROM k GROUP BY 1)
SELECT session_id, n AS n_turns, '# session ' || session_id || chr(10) || chr(10) || '- source: cli' || chr(10) || CASE WHEN session_id % 2 = 0 THEN '- model: m' || chr(10) ELSE '' END || '- started: ' || CASE WHEN session_id % 3 = 0 THEN '-' ELSE strftime(make_timestamp((1700000000 + session_id * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') END
  || chr(10) || '- ended: -' || chr(10) || '- turns: ' || n || chr(10) || chr(10) || turns AS markdown FROM t WHERE n >= 2""")
def session_pages(spark, d):
    m = messages(spark, d).withColumn("tool_calls", F.when(F.col("msg_id") % 2 == 1, F.lit('[{"name":"a"}]')))
    none = F.lit(None).cast("string")
    i = F.col("session_id")
    sessions = m.select("session_id").distinct().select("session_id", none.alias("title"), none.alias("display_name"), F.lit("cli").alias("source"), F.when(i % 2 == 0, F.lit("m")).alias("model"), F.when(i % 3 != 0, 1700000000.0 + i * 3600).alias("started_at"), F.lit(None).cast("double").alias("ended_at"), none.alias("end_reason"))
    return readers.session_page(sessions, m)


@query(f"WITH {MESSAGES}, s AS (SELECT session_id, count(*) AS n_messages FROM messages GROUP BY 1) SELECT session_id, n_messages, CASE WHEN session_id % 4 <> 0 THEN 1700000000.0 - session_id END AS started_at FROM s WHERE session_id % 2 = 0")
def sessions_by_start(spark, d):
    m = messages(spark, d)
    i = F.col("session_id")
    sessions = m.select("session_id").distinct().select("session_id", F.when(i % 4 != 0, 1700000000.0 - i).alias("started_at"), F.when(i % 2 == 0, F.lit("cli")).otherwise(F.lit("web")).alias("source"))
    return readers.ordered_sessions(sessions, m, ["cli"]).select("session_id", "n_messages", "started_at")


@query("""WITH l AS (SELECT event_id, 'agent.log' AS file, CAST(event_id % 3 AS INTEGER) AS age, CAST(event_id // 3 AS INTEGER) AS line FROM events) SELECT event_id, row_number() OVER (PARTITION BY file ORDER BY age DESC, line) AS seq FROM l""")
def rotated_log_order(spark, d):
    i = F.col("event_id")
    lines = table(spark, d, "events").select(i, F.lit("agent.log").alias("file"), (i % 3).cast("int").alias("age"), F.floor(i / 3).cast("int").alias("line"))
    return readers.in_log_order(lines).select("event_id", F.col("seq").cast("long").alias("seq"))


@query("SELECT conv_id AS question_id, conv_id::VARCHAR || '-' || s AS session_id, turn - 1 AS turn, role, text AS content, s = 1 AS is_answer FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn, role, text FROM conversations), (VALUES (1), (2)) t(s)")
def haystack_turns(spark, d):
    """Each conversation twice as a session of an example; the first is the answer."""
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    own = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("question_id")).agg(turns.alias("t"))
    named = lambda s: F.concat(F.col("question_id").cast("string"), F.lit(f"-{s}"))
    examples = own.select("question_id", F.array("t", "t").alias("haystack_sessions"), F.array(named(1), named(2)).alias("haystack_session_ids"), F.array(named(1)).alias("answer_session_ids"))
    return readers.haystack_sessions(examples).select("question_id", "session_id", F.col("turn").cast("long").alias("turn"), "role", "content", "is_answer")


@query(f"WITH {POINTS} SELECT point_id, CASE WHEN ts IS NOT NULL THEN strftime(make_timestamp(CAST(ts * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS iso, CASE WHEN ts IS NULL THEN '-' ELSE strftime(make_timestamp(CAST(ts * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS stamp FROM points")
def time_texts(spark, d):
    return points(spark, d).select("point_id", T.iso_from_epoch(F.col("ts")).alias("iso"), T.stamp(F.col("ts")).alias("stamp"))


@query(f"WITH {POINTS} SELECT session_id, count(*) AS n FROM points GROUP BY 1")
def result_pages(spark, d):
    """Hits of a session as lines of one page, read back; texts of two lines stay together."""
    line = T.result_line(F.col("value"), F.col("point_id"), F.concat("text", F.lit("\nand a second line [1] (2)")))
    pages = points(spark, d).groupBy("session_id").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("page"))
    parsed = pages.select("session_id", F.explode(T.parsed_results(F.col("page"))).alias("h")).where(F.col("h.text").endswith("second line [1] (2)") & F.col("h.point_id").try_cast("long").isNotNull())
    return parsed.groupBy("session_id").agg(F.count("*").alias("n"))


@query("SELECT event_type, format('{:,}', count(*) * 1234567) AS n, event_type || ' · ' || CAST(round(avg(value)) AS BIGINT) || ' ms · points · hits ' || count(*) FILTER (value > 50) || '/' || count(*) AS label FROM events GROUP BY 1")
def status_lines(spark, d):
    e = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("ms"), F.count_if(F.col("value") > 50).alias("hits"))
    return e.select("event_type", T.counted(F.col("n") * 1234567).alias("n"), T.status_line(F.col("event_type"), F.col("ms"), F.lit("points"), F.col("hits"), F.col("n")).alias("label"))


@query("SELECT event_id, CAST(strlen('{\"kind\":\"' || event_type || '\",\"user\":' || user_id || '}') AS BIGINT) AS bytes FROM events")
def json_payload_bytes(spark, d):
    return table(spark, d, "events").select("event_id", T.json_bytes(F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"))).cast("long").alias("bytes"))


@query("SELECT conv_id, turn, array_to_string(list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'), lambda t: '\"' || t || '\"'), ' OR ') AS match FROM conversations")
def match_expressions(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", lexical.match_expression(F.col("text")).alias("match"))


@query(f"WITH {_FILES} SELECT path, root FROM f")
def label_roots(spark, d):
    return _turn_files(spark, d).select("path", docindex.root_of(F.col("path")).alias("root"))


@query("""SELECT item_id, '{"case":' || item_id || CASE WHEN item_id % 7 <> 0 THEN ',"rank":' || (item_id % 12 + 1) ELSE '' END || ',"retrieved":[{"path":"a/' || item_id || '","rank":1},{"path":"b","rank":2}]}' AS miss FROM benchmark WHERE item_id % 7 = 0 OR item_id % 12 + 1 > 5""")
def misses_with_hits(spark, d):
    i = F.col("item_id")
    rank_ = F.when(i % 7 != 0, i % 12 + 1)
    hits = F.array(F.struct(F.concat(F.lit("a/"), i.cast("string")).alias("path"), F.lit(1).alias("rank")), F.struct(F.lit("b").alias("path"), F.lit(2).alias("rank")))
    return table(spark, d, "benchmark").where(~evaluation.hit_at(rank_, 5)).select("item_id", evaluation.miss(i, rank_, hits).alias("miss"))


@query("""SELECT item_id, CASE WHEN item_id % 2 = 0 THEN true ELSE contains(lower('p/x h ' || text), 'the') END AS hit, item_id % 3 = 0 AS in_corpus FROM benchmark""")
def known_answers(spark, d):
    i = F.col("item_id")
    hits = F.array(F.struct(F.when(i % 3 == 0, F.lit("p/x")).otherwise(F.lit("q/x")).alias("path"), F.lit("h").alias("heading"), F.col("text").alias("snippet")))
    needles = F.when(i % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("The")))
    hit, inside = evaluation.known_answer(hits, needles, F.lit("p"))
    return table(spark, d, "benchmark").select("item_id", hit.alias("hit"), inside.alias("in_corpus"))

