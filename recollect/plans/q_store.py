"""Queries of chunks, ingest, the store, maintenance, ledger and export."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recollect.functions import text as T
from recollect.operators import chunks as C
from recollect.operators import store
from recollect.plans.base import MARKDOWN, MESSAGES, NOW, POINTS, markdown, messages, points, query, table, vectors
from recollect.sources import readers

_URL_HEX = C.URL_SPACE.replace("-", "")


def _uuid5_sql(name: str) -> str:
    h = f"sha1(unhex('{_URL_HEX}') || encode({name}))"
    v = f"lpad(lower(to_hex((CAST('0x' || substr({h}, 17, 2) AS INTEGER) & 63) | 128)), 2, '0')"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {v} || substr({h}, 19, 2) || '-' || substr({h}, 21, 12)"


@query("SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(text, CAST(i * 2000 + 1 AS BIGINT), 2000) AS piece FROM documents, range(0, 40) r(i) WHERE i * 2000 < length(text)")
def chunk_fixed_width(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.fixed_chunks(F.col("text"))).alias("chunk_index", "piece"))


_PARA = f"""{MARKDOWN}, whole AS (SELECT path, heading, regexp_replace(body, '^\\s+|\\s+$', '', 'g') AS body FROM md),
para AS (SELECT path, heading, body, list_filter(regexp_split_to_array(body, '\\n\\s*\\n'), lambda p: regexp_matches(p, '\\S')) AS ps FROM whole WHERE body <> ''),
fold AS (SELECT path, heading, 0 AS i, ps, CAST([] AS VARCHAR[]) AS done, '' AS cur FROM para WHERE length(body) > 1400
  UNION ALL SELECT path, heading, i + 1, ps, CASE WHEN cur <> '' AND length(cur) + length(ps[i + 1]) + 2 > 1400 THEN list_append(done, cur) ELSE done END,
    CASE WHEN cur = '' OR length(cur) + length(ps[i + 1]) + 2 > 1400 THEN ps[i + 1] ELSE cur || chr(10) || chr(10) || ps[i + 1] END FROM fold WHERE i < len(ps)),
packed AS (SELECT path, heading, CASE WHEN cur <> '' THEN list_append(done, cur) ELSE done END AS parts FROM fold WHERE i = len(ps) UNION ALL SELECT path, heading, [body] FROM para WHERE length(body) <= 1400),
chunks AS (SELECT path, heading, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS part, regexp_replace(unnest(parts), '^\\s+|\\s+$', '', 'g') AS content FROM packed)"""


@query(f"WITH RECURSIVE {_PARA} SELECT path, heading, part, content FROM chunks")
def chunk_pack_paragraphs(spark, d):
    return C.chunked(markdown(spark, d)).select("path", "heading", "part", "content")


_LONG = "x" * 700


@query(f"""SELECT * FROM (VALUES ('a.md', 'A', 0, '0 zero start' || chr(10) || chr(10) || '{_LONG}'), ('a.md', 'A', 1, '1. first {_LONG} ends in 20' || chr(10) || chr(10) || '  2024 kept its indent'),
  ('b.md', 'b.md', 0, 'no heading'), ('c.md', 'c.md', 0, '---' || chr(10) || 'only: this' || chr(10) || '---'), ('d.md', 'd.md', 0, 'd.md')) t(path, heading, part, content)""")
def chunk_edges(spark, d):
    """Digits and indents at the edges of paragraphs, a file without a heading, one of front matter only, and an empty one."""
    long = f"# A\n\n0 zero start\n\n{_LONG}\n \n1. first {_LONG} ends in 20\n\n\n  2024 kept its indent  \n"
    files = [("a.md", long), ("b.md", "no heading\n# Empty\n"), ("c.md", "---\nonly: this\n---\n"), ("d.md", "")]
    return C.chunked(spark.createDataFrame(files, "path string, content string")).select("path", "heading", "part", "content")


@query(f"WITH {MARKDOWN} SELECT path, heading FROM md WHERE trim(body) <> ''")
def chunk_heading_path(spark, d):
    return C.sections(markdown(spark, d)).select("path", "heading")


@query(f"WITH RECURSIVE {_PARA} SELECT path, part AS ordinal, {_uuid5_sql('path || chr(0) || heading || chr(0) || part')} AS chunk_id FROM chunks")
def chunk_ordinal_id(spark, d):
    return C.with_ids(C.chunked(markdown(spark, d))).select("path", "ordinal", "chunk_id")


@query(f"WITH {MARKDOWN} SELECT doc_id, length(regexp_replace(content, '(?s)\\A---\\s*\\n.*?\\n---\\s*\\n', '')) AS n, sha256(content) AS sha FROM md")
def frontmatter_strip(spark, d):
    return markdown(spark, d).select("doc_id", F.length(T.without_frontmatter(F.col("content"))).cast("long").alias("n"), "sha")


_SNAPSHOTS = f"""{MARKDOWN}, o AS (SELECT path, sha256(content) AS sha FROM md WHERE doc_id % 7 <> 0), n AS (SELECT path, CASE WHEN doc_id % 5 = 0 THEN sha256(content || 'x') ELSE sha256(content) END AS sha FROM md WHERE doc_id % 11 <> 0),
cdc AS (SELECT coalesce(n.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'new' WHEN n.path IS NULL THEN 'deleted' WHEN n.sha = o.sha THEN 'unchanged' ELSE 'changed' END AS status FROM n FULL JOIN o ON n.path = o.path)"""


def _snapshots(spark, d):
    md = markdown(spark, d)
    old = md.where("doc_id % 7 != 0").select("path", "sha")
    new = md.where("doc_id % 11 != 0").select("path", F.when(F.col("doc_id") % 5 == 0, F.sha2(F.concat("content", F.lit("x")), 256)).otherwise(F.col("sha")).alias("sha"))
    return old, new


@query(f"WITH {_SNAPSHOTS} SELECT path, status FROM cdc")
def ingest_cdc_status(spark, d):
    old, new = _snapshots(spark, d)
    return C.changes(new, old)


@query(f"WITH {_SNAPSHOTS} SELECT path FROM cdc WHERE status = 'deleted'")
def ingest_prune(spark, d):
    old, new = _snapshots(spark, d)
    return old.join(new, "path", "left_anti").select("path")


@query(f"WITH {_SNAPSHOTS} SELECT path, sha FROM o WHERE path NOT IN (SELECT path FROM n) UNION ALL SELECT path, sha FROM n")
def replace_file_chunks(spark, d):
    old, new = _snapshots(spark, d)
    return C.replaced(old, new)


@query("SELECT count(*) AS files, CAST(coalesce(sum(ceil(length(text) / 2000.0)), 0) AS BIGINT) AS chunks FROM documents")
def index_status(spark, d):
    per = F.ceil(F.length("text") / F.lit(2000.0))
    return table(spark, d, "documents").agg(F.count("*").alias("files"), F.coalesce(F.sum(per), F.lit(0)).cast("long").alias("chunks"))


@query("SELECT count(*) AS n, round(avg(len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))), 6) AS avgdl FROM documents")
def corpus_stats(spark, d):
    from recollect.operators.lexical import corpus_stats as stats

    return stats(table(spark, d, "documents"), "text").select("n", F.round("avgdl", 6).alias("avgdl"))


@query("""WITH v AS (SELECT o_orderkey AS k, o_totalprice AS price, 1 AS version FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_totalprice * 2, 2 FROM orders WHERE o_orderkey % 4 = 0)
SELECT k, price, version FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY version DESC) = 1""")
def upsert_latest_wins(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 3 != 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.lit(1).alias("version"))
    new = o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") * 2).alias("price"), F.lit(2).alias("version"))
    return store.upserted(old, new, "k", "version")


@query(f"WITH {POINTS} SELECT point_id, CASE WHEN point_id % 9 = 0 THEN true ELSE archived END AS archived, CASE WHEN point_id % 9 = 0 THEN point_id - 1 END AS superseded_by FROM points")
def set_flags(spark, d):
    p = points(spark, d).select("point_id", "archived", F.lit(None).cast("long").alias("superseded_by"))
    flags = p.where("point_id % 9 = 0").select("point_id", F.lit(True).alias("archived"), (F.col("point_id") - 1).alias("superseded_by"))
    return store.flagged(p, flags, "point_id", "archived", "superseded_by")


_BACK = f"""{MESSAGES}, ok AS (SELECT session_id, msg_id, role, trim(text) AS text FROM messages WHERE role IN ('user', 'assistant') AND trim(text) <> '' AND session_id % 4 <> 0),
parts AS (SELECT session_id, msg_id, role, CAST(i AS INTEGER) AS chunk_index, substr(text, CAST(i * 2000 + 1 AS BIGINT), 2000) AS text FROM ok, range(0, 20) r(i) WHERE i * 2000 < length(text))"""


@query(f"WITH {_BACK} SELECT session_id, msg_id, role, chunk_index, text, {_uuid5_sql('session_id || chr(58) || msg_id || chr(58) || chunk_index')} AS point_id FROM parts")
def backfill_points(spark, d):
    m = messages(spark, d)
    done = m.where("session_id % 4 = 0").select("session_id")
    return store.backfill(m, C.URL_SPACE, ["user", "assistant"], done).select("session_id", "msg_id", "role", "chunk_index", "text", "point_id")


@query(f"WITH {MESSAGES} SELECT DISTINCT session_id FROM messages WHERE session_id % 4 <> 0")
def backfill_skip_existing(spark, d):
    m = messages(spark, d).select("session_id").distinct()
    return m.join(m.where("session_id % 4 = 0"), "session_id", "left_anti")


_DECAY = f"""{POINTS}, sc AS (SELECT point_id, source, importance, ts, pow(0.5, greatest(({NOW} - ts) / 86400.0, 0) / 5.0) AS score FROM points),
dec AS (SELECT *, CASE WHEN importance >= 0.95 OR coalesce(lower(trim(source)) IN ('cli', 'tui'), false) THEN 'exempt' WHEN ts IS NULL THEN 'no_timestamp' WHEN score < 0.05 THEN 'archive' ELSE 'keep' END AS decision FROM sc)"""


@query(f"WITH {_DECAY} SELECT point_id, round(score, 9) AS score FROM sc")
def decay_score(spark, d):
    age = (F.lit(NOW) - F.col("ts")) / 86400.0
    return points(spark, d).select("point_id", F.round(store.decay_score(age, 5.0), 9).alias("score"))


@query(f"WITH {POINTS} SELECT point_id, importance >= 0.7 OR coalesce(lower(trim(source)) IN ('cli', 'tui'), false) AS exempt FROM points")
def decay_exempt(spark, d):
    return points(spark, d).select("point_id", store.decay_exempt(F.col("importance"), F.col("source")).alias("exempt"))


@query(f"WITH {_DECAY.replace('importance >= 0.95', 'importance >= 0.7')} SELECT decision, CASE WHEN decision IN ('keep', 'archive') THEN printf('%.1f', floor(score * 10) / 10) END AS bucket, count(*) AS n FROM dec GROUP BY 1, 2")
def decay_scan_histogram(spark, d):
    plan = store.decay_plan(points(spark, d), NOW, 5.0)
    bucket = F.when(F.col("decision").isin("keep", "archive"), F.format_string("%.1f", F.floor(F.col("score") * 10) / 10))
    return plan.groupBy("decision", bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query()
def cluster_first_fit(spark, d):
    return store.first_fit_clusters(vectors(spark, d).withColumn("pos", F.col("point_id")), "label", 0.35)


_GROUPS = f"""{POINTS}, g AS (SELECT point_id, session_id % 20 AS grp, text, ts, importance, CAST(point_id % 3 AS INTEGER) AS chunk_index, session_id, point_id AS pos FROM points)"""


@query(f"""WITH {_GROUPS}, one AS (SELECT grp, first(point_id ORDER BY ts DESC NULLS LAST, pos) AS point_id, first(text ORDER BY length(text) DESC, ts DESC NULLS LAST, pos) AS text, max(ts) AS ts, max(importance) AS importance,
  CASE WHEN count(DISTINCT chunk_index) = 1 AND count(chunk_index) = count(*) THEN max(chunk_index) END AS chunk_index, first(session_id ORDER BY ts DESC NULLS LAST, pos) AS session_id FROM g GROUP BY grp)
SELECT grp, point_id, text, ts, importance, chunk_index, session_id, coalesce((SELECT string_agg(CAST(s AS VARCHAR), ',' ORDER BY s) FROM (SELECT DISTINCT g.session_id AS s FROM g WHERE g.grp = one.grp AND g.session_id <> one.session_id)), '') AS merged_session_ids FROM one""")
def merge_payloads(spark, d):
    p = points(spark, d)
    rows = p.select("point_id", (F.col("session_id") % 20).alias("grp"), "text", "ts", "importance", (F.col("point_id") % 3).cast("int").alias("chunk_index"), "session_id", F.col("point_id").alias("pos"))
    return store.merged_payloads(rows, "grp")


@query(f"WITH {POINTS}, r AS (SELECT point_id, text, first_value(point_id) OVER w AS keeper, row_number() OVER w AS n FROM points WINDOW w AS (PARTITION BY text ORDER BY coalesce(ts, 0.0) DESC, point_id)) SELECT point_id, keeper AS superseded_by, true AS archived FROM r WHERE n > 1")
def supersede_flags(spark, d):
    w = Window.partitionBy("text").orderBy(F.coalesce("ts", F.lit(0.0)).desc(), "point_id")
    r = points(spark, d).select("point_id", F.first("point_id").over(w).alias("superseded_by"), F.row_number().over(w).alias("n"))
    return r.where("n > 1").select("point_id", "superseded_by", F.lit(True).alias("archived"))


_LEDGER = """ledger AS (SELECT user_id AS point_id, epoch_us(ts) / 1e6 AS ts, event_id AS seq, CASE event_type WHEN 'view' THEN 'recall' WHEN 'signup' THEN 'add' WHEN 'click' THEN 'update' ELSE 'feedback' END AS event,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS delta FROM events)"""


def _ledger(spark, d):
    t = F.col("event_type")
    event = F.when(t == "view", "recall").when(t == "signup", "add").when(t == "click", "update").otherwise("feedback")
    ts = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1e6
    return table(spark, d, "events").select(F.col("user_id").alias("point_id"), ts.alias("ts"), F.col("event_id").alias("seq"), event.alias("event"), F.when(t == "purchase", 1).when(t == "error", -1).otherwise(0).alias("delta"))


_USAGE = """us AS (SELECT point_id, count(*) FILTER (event = 'recall') AS retrieval_count, CAST(coalesce(sum(CASE WHEN event = 'feedback' THEN greatest(delta, 0) END), 0) AS BIGINT) AS helpful_count,
  CAST(coalesce(sum(CASE WHEN event = 'feedback' THEN greatest(-delta, 0) END), 0) AS BIGINT) AS unhelpful_count, arg_min(ts, seq) AS first_seen, arg_max(ts, seq) FILTER (event = 'recall') AS last_accessed
  FROM ledger WHERE event = 'recall' OR (event = 'feedback' AND delta <> 0) GROUP BY 1)"""


@query(f"WITH {_LEDGER} SELECT point_id, seq, event FROM ledger QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY ts DESC, seq DESC) <= 50")
def ledger_newest50(spark, d):
    return store.newest_events(_ledger(spark, d)).select("point_id", "seq", "event")


@query(f"WITH {_LEDGER}, {_USAGE} SELECT * FROM us")
def ledger_usage(spark, d):
    return store.usage(_ledger(spark, d))


@query(f"WITH {_LEDGER}, {_USAGE} SELECT point_id, round_even((helpful_count + 1) / (helpful_count + unhelpful_count + 2), 4) AS trust_score FROM us")
def trust_score(spark, d):
    return store.usage(_ledger(spark, d)).select("point_id", store.trust(F.col("helpful_count"), F.col("unhelpful_count")).alias("trust_score"))


@query(f"WITH {_LEDGER}, {_USAGE}, asked(point_id) AS (VALUES (1), (2), (888888)) SELECT a.point_id::BIGINT AS point_id, coalesce(retrieval_count, 0) AS retrieval_count, coalesce(helpful_count, 0) AS helpful_count, (SELECT count(*) FROM ledger l WHERE l.point_id = a.point_id) AS events, last_accessed FROM asked a LEFT JOIN us ON us.point_id = a.point_id")
def ledger_stats_unknown(spark, d):
    asked = spark.createDataFrame([(1,), (2,), (888888,)], "point_id long")
    ledger = _ledger(spark, d).where(F.col("point_id").isin(1, 2, 888888))
    counts = ledger.groupBy("point_id").agg(F.count("*").alias("events"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return asked.join(store.usage(ledger), "point_id", "left").join(counts, "point_id", "left").select("point_id", zero("retrieval_count"), zero("helpful_count"), zero("events"), "last_accessed")


@query(f"WITH {MESSAGES}, a AS (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM messages WINDOW w AS (PARTITION BY session_id ORDER BY msg_id)) SELECT session_id, msg_id, text AS user, nt AS assistant FROM a WHERE role = 'user' AND nr = 'assistant' AND trim(text) <> '' AND trim(nt) <> ''")
def turn_pairs(spark, d):
    return readers.turn_pairs(messages(spark, d))


@query(f"""WITH {MESSAGES}, k AS (SELECT * FROM messages WHERE role IN ('user', 'assistant') AND trim(text) <> ''),
t AS (SELECT session_id, count(*) AS n, string_agg('## ' || role || ' (' || msg_id || ')' || chr(10) || chr(10) || CASE WHEN length(text) > 20000 THEN substr(text, 1, 20000) || '… [truncated]' ELSE text END, chr(10) || chr(10) ORDER BY msg_id) AS turns FROM k GROUP BY 1)
SELECT session_id, '# ' || CASE WHEN session_id % 2 = 0 THEN 'Session no. ' || session_id ELSE 'session ' || session_id END || chr(10) || chr(10) || '- source: cli' || chr(10) || chr(10) || turns AS markdown FROM t WHERE n >= 2""")
def export_sessions_md(spark, d):
    m = messages(spark, d)
    title = F.when(F.col("session_id") % 2 == 0, F.concat(F.lit("Session no. "), F.col("session_id").cast("string")))
    sessions = m.select("session_id").distinct().select("session_id", title.alias("title"), F.lit(None).cast("string").alias("display_name"), F.lit("cli").alias("source"))
    return readers.session_markdown(sessions, m)


@query("""WITH l AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, upper(event_type) AS level, 'user.' || user_id AS logger, 'value ' || event_id AS msg FROM events WHERE event_id % 10 <> 9)
SELECT day, count(*) AS n, string_agg('- **' || level || ' | ' || logger || '** — ' || msg, chr(10) ORDER BY event_id) AS body FROM l GROUP BY 1""")
def export_log_by_day(spark, d):
    i = F.col("event_id")
    stamp, level, logger, msg = F.date_format(F.expr("cast(ts as timestamp_ntz)"), "yyyy-MM-dd HH:mm:ss"), F.upper("event_type"), F.concat(F.lit("user."), F.col("user_id").cast("string")), F.concat(F.lit("value "), i.cast("string"))
    plain = F.concat_ws(" ", stamp, level, F.concat(logger, F.lit(":")), msg)
    js = F.to_json(F.struct(stamp.alias("ts"), level.alias("level"), logger.alias("logger"), msg.alias("msg")))
    lines = table(spark, d, "events").select(i, F.when(i % 10 == 9, F.lit("garbage line")).when(i % 2 == 0, plain).otherwise(js).alias("value"))
    log = readers.parsed_log(lines)
    entry = readers.log_entry(F.col("level"), F.col("logger"), F.col("msg"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", entry.alias("e")))), lambda s: s["e"]), "\n")
    return log.groupBy("day").agg(F.count("*").alias("n"), body.alias("body"))


_CALLS = {
    '[{"name":"a"},{"function":{"name":"b"}},{"name":"a"}]': "a, b",
    '[]': "",
    '[' + ",".join(f'{{"name":"t{i}"}}' for i in range(10)) + ']': "t0, t1, t2, t3, t4, t5, t6, t7 (+2 more)",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _CALLS.items()) + ") t(calls, breadcrumb)")
def tool_breadcrumb_json(spark, d):
    rows = spark.createDataFrame([(c,) for c in _CALLS], "calls string")
    return rows.select("calls", readers.tool_names(F.col("calls")).alias("breadcrumb"))


@query("SELECT vec_id AS point_id, CASE WHEN len(embedding) <> 64 THEN 'width' END AS fault FROM embeddings")
def vector_quality(spark, d):
    return vectors(spark, d).select("point_id", store.vector_faults(F.col("dense"), 64).alias("fault"))


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), m AS (SELECT vec_id, x, list_min(x) AS lo, list_max(x) AS hi FROM v)
SELECT vec_id AS point_id, array_to_string(list_transform(x, lambda a: CAST(round((a - lo) / (hi - lo) * 255) - 128 AS INTEGER)), ',') AS codes FROM m""")
def int8_quantize(spark, d):
    return vectors(spark, d).select("point_id", F.array_join(store.quantized(F.col("dense")).cast("array<string>"), ",").alias("codes"))
