"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of word shingles (five words, lower-cased). Containment of an item in a document is the
share of the item's shingles that the document holds. Items are partitioned by size; in a partition of items with at
most u shingles the sketch of an item is its ``u - ceil(threshold * u) + 1`` smallest hashes. A document that holds the
threshold's share of an item misses at most ``n - ceil(threshold * n)`` of its n shingles, so however long it is, it holds all but
so many of the sketch. The search is by sketches alone: hashes of documents' shingles meet the sketches' hashes, and a document with
enough of an item's sketch is a candidate for that item. Candidates are then verified by counting the item's distinct
shingles in the document exactly, words against words.

Only DataFrame expressions are used. Documents are not shuffled: their shingle hashes meet the sketches, and the candidates' shingles
the items' shingles, in broadcast joins while those tables are within a counted size; beyond it hashes (16 bytes for each shingle) are
shuffled in the search, and shingles of candidates alone in the verification.

Defined cases: items with fewer than five words count as one shingle of all their words, which only a document
of just those words holds; null and empty items and texts have no shingles and match nothing; repeated rows of documents give
one row for each doc_id and item, and texts under one doc_id are one document; a row with a null doc_id is not searched, and stays; equal items each get their own rows; very
long texts are searched whole, one row for each shingle; an empty table of documents or items gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recollect.runtime import small_side, stage

SHINGLE = 5
THRESHOLD = 0.75
#: Fixed-width rows (sketch hashes, candidates, doc_ids) broadcast at most, and bytes of items' shingles.
BROADCAST_SHINGLES = 200_000
BROADCAST_BYTES = 32 << 20

_SPACE = r"[ \t-\r]+"


def _columns(width: int) -> list[str]:
    return [f"w{i}" for i in range(width)]


def shingles(rows: DataFrame, key: str, width: int = SHINGLE) -> DataFrame:
    """key, h, w0..: hash and words of every shingle (with repetitions); words that short texts lack are null."""
    words = F.array_remove(F.split(F.lower(F.col("text").cast("string")), _SPACE), "")
    cut = rows.where("text is not null").select(F.col(key).cast("long").alias(key), words.alias("w")).where(F.col(key).isNotNull() & (F.size("w") > 0))
    # the words side by side: zipped slices make rows whose hash is compiled code
    names, last = _columns(width), F.greatest(F.size("w") - (width - 1), F.lit(1))
    zipped = F.arrays_zip(*[F.slice("w", F.lit(1 + i), last).alias(w) for i, w in enumerate(names)])
    return cut.select(key, F.inline(zipped).alias(*names)).select(key, F.xxhash64(*names).alias("h"), *names)


def item_sketches(items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """item_id, h, w0.., n_item, in_sketch, asked: the distinct shingles of each item; ``asked`` of those in its sketch a holder must have."""
    own = shingles(items, "item_id", width).distinct()
    n = F.count("*").over(Window.partitionBy("item_id"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("h", *_columns(width)))
    sized = own.select("*", n.alias("n_item"), rank.alias("rank"))
    top = F.pow(F.lit(2.0), F.ceil(F.log2("n_item")))  # partition of sizes (top / 2, top]
    sketch = F.least((top - F.ceil(F.lit(threshold) * top) + 1).cast("long"), F.col("n_item"))
    missing = F.col("n_item") - F.ceil(F.lit(threshold) * F.col("n_item"))
    return sized.select("item_id", "h", *_columns(width), "n_item", (F.col("rank") <= sketch).alias("in_sketch"), F.greatest(sketch - missing, F.lit(1)).cast("long").alias("asked"))


def candidates(docs: DataFrame, sketches: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, item_id of the pairs that share enough of the item's sketch."""
    asked = sketches.where("in_sketch").select("item_id", "h", "asked").distinct()
    if asked.count() <= BROADCAST_SHINGLES:
        asked = F.broadcast(asked)
    met = shingles(docs, "doc_id", width).select("doc_id", "h").join(asked, "h").groupBy("doc_id", "item_id", "h").agg(F.first("asked").alias("asked"))
    return met.groupBy("doc_id", "item_id").agg(F.count("*").alias("k"), F.first("asked").alias("asked")).where("k >= asked").select("doc_id", "item_id")


def contained(docs: DataFrame, items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_item, n_common, containment of every pair at or above the threshold."""
    sketches = stage(item_sketches(items, width, threshold), "benchmark-sketches")
    found = stage(candidates(docs, sketches, width), "benchmark-candidates")
    words = _columns(width)
    size = sketches.agg(F.sum(sum((F.octet_length(F.coalesce(w, F.lit(""))) for w in words), F.lit(48 + 16 * width)))).first()[0] or 0
    theirs = sketches.select("item_id", F.col("h").alias("ih"), *[F.col(w).alias(f"i{w}") for w in words], "n_item")
    theirs = F.broadcast(theirs) if size <= BROADCAST_BYTES else theirs
    suspects = docs.withColumn("doc_id", F.col("doc_id").cast("long")).join(small_side(stage(found.select("doc_id").distinct(), "benchmark-suspects"), BROADCAST_SHINGLES), "doc_id", "left_semi")
    met = shingles(suspects, "doc_id", width).join(theirs, F.col("h") == F.col("ih"))
    for w in words:  # equal hashes are not taken for equal words
        met = met.where(F.col(w).eqNullSafe(F.col(f"i{w}")))
    each = met.select("doc_id", "item_id", "n_item", *words).distinct().join(small_side(found, BROADCAST_SHINGLES), ["doc_id", "item_id"], "left_semi")
    pairs = each.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_common")).where(F.col("n_common") >= F.lit(threshold) * F.col("n_item"))
    return pairs.select("doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), "n_common", (F.col("n_common") / F.col("n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item; every column is kept as it is."""
    hit = small_side(stage(contained(docs, items, width, threshold).select("doc_id").distinct(), "contaminated"), BROADCAST_SHINGLES)
    return docs.join(hit, docs["doc_id"] == hit["doc_id"], "left_anti")
