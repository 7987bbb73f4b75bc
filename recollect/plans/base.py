"""Tables the queries work on, derived from the driver's, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.runtime import plain_unions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Clock of every query: just after the last event.
NOW = 1706745600.0


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    plain_unions(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def points(spark: SparkSession, d: str) -> DataFrame:
    """Events as points; some have no time, no source, or are archived."""
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        i.alias("point_id"),
        F.col("user_id").alias("session_id"),
        F.col("event_type").alias("kind"),
        F.when(i % 17 == 0, F.lit(None)).when(i % 5 == 0, F.lit("cli")).otherwise(F.lit("web")).alias("source"),
        "value",
        F.when(i % 11 != 0, F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))") / 1e6).alias("ts"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("importance"),
        F.when(i % 13 == 0, F.lit(True)).alias("archived"),
        F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" "), "event_type", F.lit(" item "), F.regexp_extract("props", "([0-9]+)", 1)).alias("text"),
        "props",
    )


POINTS = """points AS (SELECT event_id AS point_id, user_id AS session_id, event_type AS kind,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'cli' ELSE 'web' END AS source, value,
  CASE WHEN event_id % 11 <> 0 THEN epoch_us(ts) / 1e6 END AS ts, least(value / 100, 1.0) AS importance, CASE WHEN event_id % 13 = 0 THEN true END AS archived,
  'user ' || user_id || ' ' || event_type || ' item ' || regexp_extract(props, '([0-9]+)', 1) AS text, props FROM events)"""


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("dense"))


def query_vectors(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).where("point_id % 50 = 0").select(F.col("point_id").alias("query_id"), "label", "dense")


def markdown(spark: SparkSession, d: str) -> DataFrame:
    """Documents as markdown files: path, content, sha, root."""
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    content = F.concat(F.lit("---\nid: "), F.col("doc_id").cast("string"), F.lit("\n---\n# "), "lang", F.lit("\n\n## "), "source", F.lit("\n\n"), body)
    docs = table(spark, d, "documents")
    return docs.select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.col("source").alias("root"), content.alias("content"), F.sha2(content, 256).alias("sha"), "doc_id")


MARKDOWN = """md AS (SELECT source || '/' || doc_id AS path, source AS root, doc_id, lang || ' > ' || source AS heading, replace(text, chr(10), chr(10) || chr(10)) AS body,
  '---' || chr(10) || 'id: ' || doc_id || chr(10) || '---' || chr(10) || '# ' || lang || chr(10) || chr(10) || '## ' || source || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) AS content FROM documents)"""


def messages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select(F.col("conv_id").alias("session_id"), F.col("turn").alias("msg_id"), "role", "text")


MESSAGES = "messages AS (SELECT conv_id AS session_id, turn AS msg_id, role, text FROM conversations)"
