"""Queries of formatting, parsing, probe corpora and the hashing embedder."""

from __future__ import annotations

from pyspark.sql import functions as F

from recollect.functions import embed
from recollect.functions import text as T
from recollect.plans.base import MESSAGES, POINTS, messages, points, query, table


@query("SELECT t AS topic, CAST(m AS INTEGER) AS month, t || ' note of month ' || m AS text, CAST(epoch(make_date(2026, CAST(m AS INTEGER), 15)) AS DOUBLE) AS ts FROM (VALUES ('garden'), ('budget'), ('travel')) v(t), range(1, 9) r(m)")
def probe_corpus(spark, d):
    """One fact for each topic and month."""
    topics = spark.createDataFrame([("garden",), ("budget",), ("travel",)], "topic string")
    rows = topics.select("topic", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("month"))
    day = F.make_date(F.lit(2026), "month", F.lit(15))
    return rows.select("topic", "month", F.concat_ws(" note of month ", "topic", F.col("month").cast("string")).alias("text"), (F.unix_date(day) * F.lit(86400.0)).alias("ts"))


@query(f"WITH {MESSAGES} SELECT session_id, string_agg(role || ': ' || text, chr(10) ORDER BY msg_id) AS text FROM messages GROUP BY 1")
def session_text(spark, d):
    turn = F.concat_ws(": ", "role", "text")
    lists = messages(spark, d).groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("msg_id", turn.alias("t")))).alias("x"))
    return lists.select("session_id", F.array_join(F.transform("x", lambda s: s["t"]), "\n").alias("text"))


@query(f"WITH {POINTS} SELECT point_id, printf('[%.2f] (%d) %s', value, point_id, text) AS line FROM points WHERE abs(value * 100 - round(value * 100)) < 1e-6")
def result_lines(spark, d):
    rows = points(spark, d).where("abs(value * 100 - round(value * 100)) < 1e-6")  # halves of a cent are rounded differently
    return rows.select("point_id", T.result_line(F.col("value"), F.col("point_id"), F.col("text")).alias("line"))


@query(f"WITH {POINTS} SELECT point_id, round(value, 2) AS score, text FROM points WHERE abs(value * 100 - round(value * 100)) < 1e-6")
def result_text_parse(spark, d):
    """Hits read back from their text lines."""
    rows = points(spark, d).where("abs(value * 100 - round(value * 100)) < 1e-6")
    page = rows.select(T.result_line(F.col("value"), F.col("point_id"), F.col("text")).alias("line"))
    hits = page.select(F.explode(T.parsed_results(F.col("line"))).alias("h"))
    return hits.select(F.col("h.point_id").cast("long").alias("point_id"), "h.score", "h.text")


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, length(text) AS chars FROM documents")
def payload_bytes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.length("text").cast("long").alias("chars"))


@query("SELECT item_id, '{\"item_id\":' || item_id || ',\"rank\":' || (item_id % 12 + 1) || '}' AS miss FROM benchmark WHERE item_id % 12 + 1 > 5")
def misses_json(spark, d):
    rank = (F.col("item_id") % 12 + 1).alias("rank")
    return table(spark, d, "benchmark").where("item_id % 12 + 1 > 5").select("item_id", F.to_json(F.struct("item_id", rank)).alias("miss"))


@query("SELECT user_id, 'user ' || user_id || ' · hits ' || count(*) FILTER (value > 50) || '/' || count(*) AS label FROM events GROUP BY 1")
def status_label(spark, d):
    hits = F.concat(F.lit("hits "), F.count_if(F.col("value") > 50).cast("string"), F.lit("/"), F.count("*").cast("string"))
    return table(spark, d, "events").groupBy("user_id").agg(hits.alias("hits")).select("user_id", F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" · "), "hits").alias("label"))


@query(r"""WITH w AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS t FROM benchmark),
c AS (SELECT item_id, CAST('0x' || substr(md5(t), 1, 7) AS INTEGER) % 64 AS cell, sum(CASE WHEN CAST('0x' || substr(md5(t), 8, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END) AS v FROM w GROUP BY 1, 2),
n AS (SELECT item_id, sqrt(sum(v * v)) AS n FROM c GROUP BY 1) SELECT item_id, cell, round(v / n, 9) AS value FROM c JOIN n USING (item_id) WHERE v <> 0""")
def embed_hash(spark, d):
    rows = table(spark, d, "benchmark").select("item_id", F.posexplode(embed.hash_embedder(64)("text")).alias("cell", "value"))
    return rows.where("value != 0").select("item_id", "cell", F.round("value", 9).alias("value"))
