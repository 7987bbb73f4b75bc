"""Lexical search: postings, BM25 top-k, sparse inverse-document-frequency arm, all-terms match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recollect.functions.text import has_all_tokens, index_tokens
from recollect.runtime import small_side, stage

K1, B = 1.2, 0.75
#: Terms of queries that are sent to the executors at most; more are joined by shuffle.
ASKED_TERMS = 100_000


def postings(chunks: DataFrame, *columns: str, asked: DataFrame | None = None) -> DataFrame:
    """chunk_id, term, tf, dl over the named text columns; with ``asked`` (term) of these terms only, so that no other posting is shuffled."""
    # the tokens are a column of their own below the explode; beside it they would be made again for each of them
    split = chunks.select("chunk_id", index_tokens(F.concat_ws(" ", *columns)).alias("tokens"))
    terms = split.select("chunk_id", F.size("tokens").alias("dl"), F.explode("tokens").alias("term"))
    if asked is not None:
        terms = terms.join(small_side(stage(asked.select("term").distinct(), "asked-terms"), ASKED_TERMS), "term", "left_semi")
    return terms.groupBy("chunk_id", "term").agg(F.count("*").alias("tf"), F.max("dl").alias("dl"))


def corpus_stats(chunks: DataFrame, *columns: str) -> DataFrame:
    """n (chunks) and avgdl, one row."""
    size = F.size(index_tokens(F.concat_ws(" ", *columns)))
    return chunks.agg(F.count("*").alias("n"), F.avg(size).alias("avgdl"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term, once each; tokens split as the index splits them."""
    return queries.select("query_id", F.explode(F.array_distinct(index_tokens(F.col("query")))).alias("term"))


def bm25(index: DataFrame, stats: DataFrame, terms: DataFrame) -> DataFrame:
    """query_id, chunk_id, score: the better, the smaller (negative), as the full-text index ranks.

    Only the queries' terms are joined: their document frequencies come from the postings they select.
    """
    asked = stage(index.join(terms.select("term").distinct(), "term", "left_semi"), "postings")
    df = asked.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = df.crossJoin(F.broadcast(stats)).select("term", "avgdl", F.when(weight <= 0, F.lit(1e-6)).otherwise(weight).alias("idf"))  # stats is one row
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    joined = terms.join(asked, "term").join(idf, "term")
    return joined.groupBy("query_id", "chunk_id").agg(F.round(-F.sum(part), 6).alias("score"))


def sparse_idf(index: DataFrame, stats: DataFrame, queries: DataFrame, avgdl: float = 256.0) -> DataFrame:
    """query_id, chunk_id, score: saturated term weights on both sides times the store's inverse document frequency."""
    split = queries.select("query_id", index_tokens(F.col("query")).alias("tokens"))
    q = split.select("query_id", F.size("tokens").alias("ql"), F.explode("tokens").alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"), F.max("ql").alias("ql"))
    saturated = lambda tf, dl: tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))
    asked = stage(index.join(q.select("term").distinct(), "term", "left_semi"), "postings")
    df = asked.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats.select("n")))
    idf = df.select("term", F.log1p((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    score = saturated(F.col("qtf"), F.col("ql")) * saturated(F.col("tf"), F.col("dl")) * F.col("idf")
    return q.join(asked, "term").join(idf, "term").groupBy("query_id", "chunk_id").agg(F.round(F.sum(score), 6).alias("score"))


def topk(scores: DataFrame, k: int, descending: bool = False) -> DataFrame:
    order = F.col("score").desc() if descending else F.col("score").asc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "chunk_id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def match_expression(query: Column) -> Column:
    """Quoted word tokens joined by OR."""
    return F.array_join(F.transform(F.regexp_extract_all(query, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")


def phrase_hits(chunks: DataFrame, text: Column, phrase: str) -> DataFrame:
    """Chunks whose tokens hold the phrase's tokens in a row; underscores part tokens."""
    tokens = F.concat(F.lit(" "), F.array_join(index_tokens(text), " "), F.lit(" "))
    wanted = F.concat(F.lit(" "), F.array_join(index_tokens(F.lit(phrase)), " "), F.lit(" "))
    return chunks.where(F.contains(tokens, wanted))


def all_terms(points: DataFrame, query: str, text: Column, limit: int) -> DataFrame:
    """Last resort: every query token stands in the text; in id order."""
    return points.where(has_all_tokens(text, F.lit(query))).orderBy("point_id").limit(limit)
