"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a hash of the key. A bucket whose rows exceed the byte
limit splits on one further bit, and only that bucket; the rest of the directory stays as it is. The split is decided
from sizes alone: bytes are summed by a prefix a few bits longer than an even spread needs, rolled up to
every shorter prefix, and a prefix is a shard if it fits while its parent does not. Prefixes that are still too large are
summed anew, further down, from their own rows only.

Only DataFrame expressions are used. What is shuffled are sums by prefix, never texts.

Defined cases: null and empty texts have no bytes but a shard; a null key is hashed as the empty string; rows
with equal keys cannot be parted, so a bucket of one key over the limit (or a single row over it) is a shard
marked ``oversized``; very long texts count by their bytes; an empty table has no shards, and is written as a folder without rows; extra columns are ignored, and written as they are:
the folder column takes the first of ``shard``, ``shard_``, ... that is not in use.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.runtime import small_side, stage

LIMIT_BYTES = 4 << 20
#: Bits below an even spread that one pass looks at, and the bits of the hash.
SLACK_BITS = 4
HASH_BITS = 60
#: Hashes with their shard (about 150 bytes each) broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def hash_bits(key: Column) -> Column:
    """The key's hash as a string of HASH_BITS binary digits."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """shard, depth, shard_bytes, shard_docs, oversized from rows of (bits, bytes)."""
    total = rows.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
    if not total["n"]:
        return rows.sparkSession.createDataFrame([], "shard string, depth int, shard_bytes long, shard_docs long, oversized boolean")
    depth, top = 0, min(HASH_BITS, max(1, math.ceil(math.log2(max(1.0, (total["b"] or 0) / limit)))) + SLACK_BITS)
    left, shards = rows, None
    while True:
        # each prefix of `top` bits once, beside its own sums; then every shorter prefix down to `depth`
        cells = left.groupBy(F.substring("bits", 1, top).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"), F.min("bits").alias("low"), F.max("bits").alias("high"))
        cells = stage(cells, "shard-cells")
        up = cells.select("*", F.explode(F.sequence(F.lit(depth), F.lit(top))).alias("depth"))
        buckets = up.groupBy(F.expr("substring(cell, 1, depth)").alias("shard"), "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.min("low").alias("low"), F.max("high").alias("high"))
        buckets = stage(buckets, "shard-buckets")
        # a bucket with a single hash cannot be split any more
        ends = (F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high"))
        parents = buckets.where(~ends).select(F.col("shard").alias("parent"))
        parent_of = F.expr("substring(shard, 1, depth - 1)")
        if depth == 0:
            leaves = buckets.where(ends & (F.col("depth") > 0)).withColumn("parent", parent_of).join(parents, "parent", "left_semi").drop("parent").unionByName(buckets.where(ends & (F.col("depth") == 0)))
        else:
            leaves = buckets.where(ends & (F.col("depth") > depth)).withColumn("parent", parent_of).join(parents, "parent", "left_semi").drop("parent")
        leaves = leaves.select("shard", "depth", "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized"))
        shards = leaves if shards is None else shards.unionByName(leaves)
        large = stage(buckets.where(~ends & (F.col("depth") == top)).select(F.col("shard").alias("cell")), "shard-large")
        if top >= HASH_BITS or large.isEmpty():
            return stage(shards, "shard-directory")
        left = left.join(large, F.substring(left["bits"], 1, top) == large["cell"], "left_semi")
        depth, top = top, min(HASH_BITS, top + 2 * SLACK_BITS)


def _located(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """``rows`` (with ``bits``) beside the columns of the shard that each belongs to."""
    depths = [r["depth"] for r in shards.select("depth").distinct().orderBy("depth").collect()]  # at most HASH_BITS + 1
    if not depths:
        return rows.join(shards, F.lit(False))
    # a row belongs to the one shard among its prefixes of the depths that occur
    prefixes = F.array(*[F.substring("bits", 1, d) if d else F.lit("") for d in depths])
    return rows.withColumn("shard", F.explode(prefixes)).join(shards, "shard")


def assign(docs: DataFrame, key: str = "doc_id", limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, bytes, shard, depth, shard_bytes, shard_docs, oversized of every row."""
    size = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("bytes"), hash_bits(F.col(key)).alias("bits")), "shard-rows")
    return _located(rows, directory(rows, limit)).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs", "oversized")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", limit: int = LIMIT_BYTES) -> str:
    """Write ``docs`` as Parquet, one folder for each shard; returns the name of the folder column.

    Shards are found for the hashes of keys; texts are moved once, to the task that writes their shard.
    """
    used = {c.lower() for c in docs.columns}
    folder = "shard"
    while folder in used:
        folder += "_"
    size = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    rows = stage(docs.select(size.alias("bytes"), hash_bits(F.col(key)).alias("bits")), "shard-rows")
    # readers take a folder named by digits alone for a number
    places = _located(rows.select("bits").distinct(), directory(rows, limit)).select("bits", F.concat(F.lit("bits"), "shard").alias("place"))
    places = small_side(stage(places, "shard-places"), BROADCAST_ROWS)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), hash_bits(F.col(key)).alias("bits"))
    own = whole.join(places, "bits").select("r.*", F.col("place").alias(folder))
    own.repartition(folder).write.partitionBy(folder).parquet(path)
    return folder
