"""Queries of metrics, state and streams, and of the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recollect.operators import evaluation as E
from recollect.operators import store
from recollect.operators import rank as R
from recollect.operators.chunks import URL_SPACE
from recollect.operators.docindex import LexicalIndex
from recollect.plans.base import query, table, vectors
from recollect.plans.q_retrieval import _CLOSER as CLOSER
from recollect.plans.q_store import _uuid5_sql as uuid5_sql
from recollect.runtime import scratch
from recollect.streaming import jobs

_RANKS = "r AS (SELECT item_id, CASE WHEN item_id % 7 = 0 THEN NULL ELSE CAST(item_id % 12 + 1 AS INTEGER) END AS rank FROM benchmark)"


def _ranks(spark, d):
    i = F.col("item_id")
    return table(spark, d, "benchmark").select("item_id", F.when(i % 7 != 0, (i % 12 + 1).cast("int")).alias("rank"))


@query(f"WITH {_RANKS} SELECT round(avg(coalesce(CAST(rank <= 1 AS INTEGER), 0)), 9) AS r1, round(avg(coalesce(CAST(rank <= 5 AS INTEGER), 0)), 9) AS r5, round(avg(coalesce(CAST(rank <= 10 AS INTEGER), 0)), 9) AS r10 FROM r")
def recall_at_k(spark, d):
    r = F.col("rank")
    return _ranks(spark, d).agg(*[F.round(E.recall_at(r, k), 9).alias(f"r{k}") for k in (1, 5, 10)])


@query(f"WITH {_RANKS} SELECT round(avg(coalesce(1.0::DOUBLE / rank, 0)), 9) AS mrr FROM r")
def mrr(spark, d):
    return _ranks(spark, d).agg(F.round(E.mean_reciprocal(F.col("rank")), 9).alias("mrr"))


@query(f"WITH {_RANKS} SELECT round(avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE / log2(rank + 1) ELSE 0 END), 9) AS ndcg FROM r")
def ndcg_log2(spark, d):
    return _ranks(spark, d).agg(F.round(E.ndcg_log2(F.col("rank"), 5), 9).alias("ndcg"))


@query(f"WITH {_RANKS} SELECT round(avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE / rank ELSE 0 END), 9) AS ndcg FROM r")
def ndcg_linear(spark, d):
    return _ranks(spark, d).agg(F.round(E.ndcg_linear(F.col("rank"), 5), 9).alias("ndcg"))


@query("""WITH n(hits, n) AS (VALUES (0, 0), (32, 36), (5, 10), (10, 10), (0, 7)), w AS (SELECT *, hits::DOUBLE / nullif(n, 0) AS p, 1.96 * 1.96 AS z2 FROM n)
SELECT hits, n, CASE WHEN n > 0 THEN round(greatest(0, (p + z2 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)), 9) ELSE 0.0::DOUBLE END AS low,
  CASE WHEN n > 0 THEN round(least(1, (p + z2 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)), 9) ELSE 0.0::DOUBLE END AS high FROM w""")
def wilson_ci(spark, d):
    rows = spark.createDataFrame([(0, 0), (32, 36), (5, 10), (10, 10), (0, 7)], "hits int, n int")
    low, high = E.wilson(F.col("hits"), F.when(F.col("n") > 0, F.col("n").cast("double")))
    return rows.select("hits", "n", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


_CASES = "c AS (SELECT item_id, CASE WHEN item_id % 7 <> 0 THEN item_id % 12 + 1 END AS t, CASE WHEN item_id % 5 <> 0 THEN item_id % 9 + 1 END AS x, (item_id % 10) / 10.0::DOUBLE AS st, (item_id % 13) / 13.0::DOUBLE AS sx FROM benchmark)"


@query(f"""WITH {_CASES}, d AS (SELECT *, t IS NOT NULL OR x IS NOT NULL AS decidable, coalesce(t, 11) < coalesce(x, 11) AS win, CASE WHEN t IS NOT NULL AND x IS NOT NULL THEN abs(st - sx) END AS margin FROM c)
SELECT count(*) FILTER (decidable) AS decidable, round(count(*) FILTER (decidable AND win) / nullif(count(*) FILTER (decidable), 0), 9) AS beats, round(median(margin), 9) AS margin_median, round(min(margin), 9) AS margin_min, count(*) FILTER (margin < 0.10) AS close FROM d""")
def confusion_margin(spark, d):
    i = F.col("item_id")
    c = table(spark, d, "benchmark").select(F.when(i % 7 != 0, i % 12 + 1).alias("t"), F.when(i % 5 != 0, i % 9 + 1).alias("x"), ((i % 10) / 10.0).alias("st"), ((i % 13) / 13.0).alias("sx"))
    seen = F.col("t").isNotNull() | F.col("x").isNotNull()
    win = F.coalesce("t", F.lit(11)) < F.coalesce("x", F.lit(11))
    margin = F.when(F.col("t").isNotNull() & F.col("x").isNotNull(), F.abs(F.col("st") - F.col("sx")))
    return c.agg(
        F.count_if(seen).alias("decidable"),
        F.round(F.try_divide(F.count_if(seen & win), F.count_if(seen)), 9).alias("beats"),
        F.round(F.median(margin), 9).alias("margin_median"),
        F.round(F.min(margin), 9).alias("margin_min"),
        F.count_if(margin < 0.10).alias("close"),
    )


@query(f"WITH {_CASES} SELECT count(*) FILTER (coalesce(t <= 5, false) AND NOT coalesce(x <= 5, false)) AS win5, count(*) FILTER (coalesce(x <= 5, false) AND NOT coalesce(t <= 5, false)) AS loss5 FROM c")
def win_loss(spark, d):
    i = F.col("item_id")
    hit = lambda c: F.coalesce(c <= 5, F.lit(False))
    a, b = hit(F.when(i % 7 != 0, i % 12 + 1)), hit(F.when(i % 5 != 0, i % 9 + 1))
    return table(spark, d, "benchmark").agg(F.count_if(a & ~b).alias("win5"), F.count_if(b & ~a).alias("loss5"))


@query("""WITH s AS (SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY 1)
SELECT conv_id, CAST(list_position(list_transform(texts, lambda t: contains(lower(t), 'tion ')), true) AS BIGINT) AS rank FROM s""")
def answer_hit_at_k(spark, d):
    lists = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("texts"))
    return lists.select("conv_id", E.answer_rank(F.col("texts"), F.lit("TION ")).alias("rank"))


@query("SELECT doc_id, contains(lower(source || ' ' || text), 'src1') AND contains(lower(source || ' ' || text), 'the') AS ok FROM documents")
def known_answer_hits(spark, d):
    return table(spark, d, "documents").select("doc_id", E.holds_all(F.concat_ws(" ", "source", "text"), F.array(F.lit("SRC1"), F.lit("The"))).alias("ok"))


@query("""WITH s AS (SELECT user_id, list_sort(list(value)) AS v FROM events GROUP BY 1) SELECT user_id, v[CAST(greatest(1, ceil(len(v) * 50 / 100.0)) AS INTEGER)] AS p50, v[CAST(greatest(1, ceil(len(v) * 95 / 100.0)) AS INTEGER)] AS p95 FROM s""")
def percentile_nearest_rank(spark, d):
    return E.nearest_rank_by(table(spark, d, "events"), "user_id", "value", (50, 95))


@query("""WITH w AS (SELECT event_id, list_sort(list(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)) AS v FROM events)
SELECT event_id, v[CAST(greatest(1, ceil(len(v) * 50 / 100.0)) AS INTEGER)] AS p50, v[CAST(greatest(1, ceil(len(v) * 95 / 100.0)) AS INTEGER)] AS p95 FROM w""")
def rolling_p50_p95(spark, d):
    last = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-199, 0)
    w = table(spark, d, "events").select("event_id", F.array_sort(F.collect_list("value").over(last)).alias("v"))
    return w.select("event_id", E.nearest_rank(F.col("v"), 50).alias("p50"), E.nearest_rank(F.col("v"), 95).alias("p95"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS hits, round(avg(value), 6) AS mean, round(median(value), 6) AS mid, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def hit_rate(spark, d):
    v = F.col("value")
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(v > 50).alias("hits"), F.round(F.avg(v), 6).alias("mean"), F.round(F.median(v), 6).alias("mid"), F.min(v).alias("low"), F.max(v).alias("high"))


_ATTEMPTS = "att AS (SELECT CAST(user_id % 5 AS VARCHAR) AS endpoint, event_id AS seq, CAST(event_id AS DOUBLE) AS ts, event_type = 'signup' AS ok FROM events)"


@query(f"""WITH RECURSIVE {_ATTEMPTS}, o AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY seq) AS i FROM att),
f AS (SELECT endpoint, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, 0 AS failures, CAST(NULL AS DOUBLE) AS until, false AS is_open FROM (SELECT DISTINCT endpoint FROM o)
  UNION ALL SELECT f.endpoint, o.i, o.seq, CASE WHEN NOT (until IS NULL OR o.ts >= until) THEN f.failures WHEN o.ok THEN 0 ELSE (CASE WHEN until IS NULL THEN f.failures ELSE 0 END) + 1 END,
    CASE WHEN NOT (until IS NULL OR o.ts >= until) THEN until WHEN NOT o.ok AND (CASE WHEN until IS NULL THEN f.failures ELSE 0 END) + 1 >= 5 THEN o.ts + 120 END,
    NOT (until IS NULL OR o.ts >= until) FROM f JOIN o ON o.endpoint = f.endpoint AND o.i = f.i + 1)
SELECT endpoint, seq, is_open, CAST(failures AS BIGINT) AS failures FROM f WHERE i > 0""")
def breaker_state(spark, d):
    e = table(spark, d, "events")
    attempts = e.select((F.col("user_id") % 5).cast("string").alias("endpoint"), F.col("event_id").alias("seq"), F.col("event_id").cast("double").alias("ts"), (F.col("event_type") == "signup").alias("ok"))
    return store.breaker_states(attempts)


@query("SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark, d):
    return jobs.windowed_counts(spark, f"{d}/events.parquet")


@query(f"SELECT conv_id, turn FROM conversations WHERE trim(text) <> '' AND NOT {CLOSER.replace('lower(t)', 'lower(text)')}")
def stream_ingest_equals_batch(spark, d):
    return jobs.ingested_turns(spark, f"{d}/conversations.parquet")


@query(f"""WITH ok AS (SELECT conv_id AS session_id, turn AS msg_id, trim(text) AS text FROM conversations WHERE trim(text) <> '' AND NOT {CLOSER.replace('lower(t)', 'lower(text)')}),
parts AS (SELECT session_id, msg_id, CAST(i AS INTEGER) AS chunk_index, substr(text, CAST(i * 2000 + 1 AS BIGINT), 2000) AS text FROM ok, range(0, 20) r(i) WHERE i * 2000 < length(text))
SELECT session_id, msg_id, chunk_index, text, {uuid5_sql('session_id || chr(58) || msg_id || chr(58) || chunk_index')} AS point_id, true AS has_vector FROM parts""")
def stream_ingest_points(spark, d):
    """Turns as points: text, ids and vectors, as they arrive."""
    rows = jobs.ingested_points(spark, f"{d}/conversations.parquet", URL_SPACE)
    return rows.select("session_id", "msg_id", "chunk_index", "text", "point_id", (F.size("dense") == 64).alias("has_vector"))


@query("SELECT user_id AS point_id, count(*) FILTER (event_type = 'view') AS retrieval_count FROM events WHERE event_type = 'view' GROUP BY 1")
def stream_ledger(spark, d):
    """Ledger events appended by a stream; the counters are a view over them."""
    ts = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1e6
    events = jobs._stream(spark, f"{d}/events.parquet").where("event_type = 'view'").select(F.col("user_id").alias("point_id"), ts.alias("ts"), F.col("event_id").alias("seq"), F.lit("recall").alias("event"), F.lit(0).alias("delta"))
    return store.usage(jobs.ledger_stream(events)).select("point_id", "retrieval_count")


@query("SELECT event_type, count(*) AS attempts, count(*) FILTER (value > 50) AS hits FROM events GROUP BY 1")
def stream_hit_rate(spark, d):
    return jobs.counted_hits(jobs._stream(spark, f"{d}/events.parquet"), "event_type", F.col("value") > 50)


@query("""WITH w AS (SELECT user_id AS key, event_id AS seq, list_sort(list(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)) AS v FROM events)
SELECT key, seq, v[CAST(greatest(1, ceil(len(v) * 50 / 100.0)) AS INTEGER)] AS p50, v[CAST(greatest(1, ceil(len(v) * 95 / 100.0)) AS INTEGER)] AS p95 FROM w""")
def stream_rolling_latency(spark, d):
    events = jobs._stream(spark, f"{d}/events.parquet").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), "value")
    return jobs._drained(jobs.rolling_latency(events), "latency")


@query("SELECT item_id AS query_id, length(text) AS n FROM benchmark")
def stream_queries(spark, d):
    """Each batch of a stream of queries is answered as it comes."""
    asked = jobs._stream(spark, f"{d}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return jobs.answered(asked, lambda batch: batch.select("query_id", F.length("query").cast("long").alias("n")), "query_id long, n long")


@query("""WITH s(step, path, tier, status) AS (VALUES (1, 'a', 'lexical', 'new'), (1, 'b', 'lexical', 'new'), (2, 'b', 'lexical', 'changed'), (2, 'a', 'semantic', 'new'), (2, 'b', 'semantic', 'new')) SELECT * FROM s""")
def ingest_tiers(spark, d):
    """Two runs: a file changes, and a tier that was not there before catches up."""
    index, out = LexicalIndex(spark, scratch(spark, "index")), None
    for step, (texts, tiers) in enumerate([({"a": "one two", "b": "three"}, {"lexical": index.replace}), ({"a": "one two", "b": "four"}, {"lexical": index.replace, "semantic": lambda files: files.count()})], 1):
        files = spark.createDataFrame([(p, "r", t) for p, t in texts.items()], "path string, root string, content string").withColumn("sha", F.sha2("content", 256))
        one = jobs.ingest_files(index, files, tiers).withColumn("step", F.lit(step))
        out = one if out is None else out.unionByName(one)
    return out.select("step", "path", "tier", "status")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, id""")
def session_window_users(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def star_pricing_summary(spark, d):
    li = table(spark, d, "lineitem").where(F.expr("cast(l_shipdate as timestamp_ntz) <= timestamp_ntz'1998-09-02 00:00:00'"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1")
def star_region_orders(spark, d):
    t = lambda n: table(spark, d, n)
    own = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return own.where("r_name = 'ASIA'").groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""WITH q AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, q.label, e.label AS found, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.x, e.embedding::DOUBLE[]), 6) DESC, e.vec_id) AS rank FROM q JOIN embeddings e ON e.vec_id <> q.vec_id),
f AS (SELECT query_id, min(rank) FILTER (label = found AND rank <= 10) AS rank FROM s GROUP BY 1) SELECT count(*) AS queries, round(avg(CASE WHEN rank IS NULL THEN 0 ELSE 1 END), 9) AS recall10, round(avg(coalesce(1.0::DOUBLE / rank, 0)), 9) AS mrr FROM f""")
def retrieval_eval(spark, d):
    """Recall and reciprocal rank of the first neighbour of the same label."""
    v = vectors(spark, d)
    q = v.where("point_id % 50 = 0").select(F.col("point_id").alias("query_id"), "label", "dense")
    top = R.dense_topk(v, q, 11).where("query_id != point_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where("rank <= 10")
    hit = top.join(q.select("query_id", "label"), "query_id").join(v.select("point_id", F.col("label").alias("found")), "point_id").where("label = found").groupBy("query_id").agg(F.min("rank").alias("rank"))
    ranks = q.select("query_id").join(hit, "query_id", "left")
    return ranks.agg(F.count("*").alias("queries"), F.round(E.recall_at(F.col("rank"), 10), 9).alias("recall10"), F.round(E.mean_reciprocal(F.col("rank")), 9).alias("mrr"))
