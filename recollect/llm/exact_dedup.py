"""Exact deduplication by composable polynomial fingerprints.

A text is normalised (each run of ASCII white space becomes one space; null counts as empty) and cut into
chunks. Every chunk gets two polynomial hashes ``sum(b[i] * r**(n-1-i)) mod p``, one matrix product for all
chunks of a text; hashes of neighbours combine by length-shifted arithmetic, ``H(AB) = H(A) * r**|B| + H(B)``,
so chunks of a huge text can be hashed in any order and place. Rows of equal fingerprint and length are then
compared chunk by chunk: the texts of repeated fingerprints alone are read again, and their chunks' bytes are grouped beside fingerprint
and chunk number, which collapses copies before the shuffle. A fingerprint with two different chunks in one place is a collision, and its rows
are grouped by their whole text instead.

Defined cases: null and empty texts are equal to each other; of equal texts the row with the smallest doc_id
stays (a null doc_id sorts last); of repeated rows with that doc_id exactly one is kept; very long texts are normalised and hashed in
blocks of fixed size, so that a text takes a small multiple of its own bytes; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.runtime import bound_batches, small_side, stage, tidied

#: (modulus, radix) of the two hashes; both moduli are primes below 2**31, so products fit 64 bits.
HASHES = ((2147483647, 1000003), (2147483629, 69069))
CHUNK = 4096
COMPARE_CHUNK = 65536
#: A set of repeated fingerprints (24 bytes each) of up to this many rows is broadcast; larger ones shuffle.
BROADCAST_ROWS = 200_000

#: Bytes that are normalised, and chunks that are hashed, at once.
BLOCK = 1 << 20
BLOCK_CHUNKS = 256

_SPACES = b" \t\n\x0b\x0c\r"


def _squeezed(raw: bytes) -> bytes:
    inner = b" ".join(raw.split())
    if not inner:
        return b" "
    return (b" " if raw[0] in _SPACES else b"") + inner + (b" " if raw[-1] in _SPACES else b"")


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text with each run of white space as one space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if len(raw) <= BLOCK:
        return _squeezed(raw) if raw else raw
    out = bytearray()
    for at in range(0, len(raw), BLOCK):
        piece = _squeezed(raw[at : at + BLOCK])
        out += piece[1:] if out[-1:] == b" " and piece[:1] == b" " else piece
    return bytes(out)


class Fingerprinter:
    """Hashes byte strings for one (modulus, radix) and combines hashes of adjacent strings."""

    def __init__(self, modulus: int, radix: int, chunk: int = CHUNK):
        self.p, self.r, self.chunk = modulus, radix % modulus, chunk
        powers = np.ones(chunk, dtype=np.uint64)
        for i in range(1, chunk):
            powers[i] = int(powers[i - 1]) * self.r % modulus
        self.powers = powers[::-1].copy()

    def combine(self, left: int, right: int, right_length: int) -> int:
        return (left * pow(self.r, right_length, self.p) + right) % self.p

    def chunks(self, data: bytes) -> list[tuple[int, int]]:
        """(hash, length) of each chunk; they are independent of one another."""
        raw = np.frombuffer(data, dtype=np.uint8)
        whole = len(raw) // self.chunk
        out = []
        table = raw[: whole * self.chunk].reshape(whole, self.chunk)
        for at in range(0, whole, BLOCK_CHUNKS):
            out += [(int(x) % self.p, self.chunk) for x in table[at : at + BLOCK_CHUNKS].astype(np.uint64) @ self.powers]
        rest = raw[whole * self.chunk :]
        if len(rest):
            out.append((int(rest.astype(np.uint64) @ self.powers[-len(rest) :]) % self.p, len(rest)))
        return out

    def __call__(self, data: bytes) -> int:
        value = 0
        for h, n in self.chunks(data):
            value = self.combine(value, h, n)
        return value


_KEY = [T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()), T.StructField("n", T.LongType())]


def fingerprints(docs: DataFrame, hashes=HASHES) -> DataFrame:
    """doc_id, f1, f2, n (bytes) and SHA-256 of every row's normalised text."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (Fingerprinter(*h) for h in hashes)
        for batch in batches:
            texts = [normalise(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([a(t) for t in texts], pa.int64()),
                    pa.array([b(t) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=["doc_id", "f1", "f2", "n", "text_sha256"],
            )

    schema = T.StructType([T.StructField("doc_id", T.LongType()), *_KEY, T.StructField("text_sha256", T.StringType())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), schema)


def _chunks(docs: DataFrame, hashes, size: int) -> DataFrame:
    """One row per chunk of each text, beside the text's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (Fingerprinter(*h) for h in hashes)
        for batch in batches:
            rows = []
            for text in map(normalise, batch.column(0).to_pylist()):
                key = (a(text), b(text), len(text))
                rows += [(*key, i // size, text[i : i + size]) for i in range(0, max(len(text), 1), size)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["f1", "f2", "n", "part", "chunk"])

    schema = T.StructType([*_KEY, T.StructField("part", T.LongType()), T.StructField("chunk", T.BinaryType())])
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), schema)


def collisions(docs: DataFrame, ids: DataFrame, hashes=HASHES, size: int = COMPARE_CHUNK) -> DataFrame:
    """Fingerprints under which texts differ in some chunk, of the rows of ``docs`` whose doc_id is in ``ids``."""
    again = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    again = again.join(ids, again["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    different = _chunks(again, hashes, size).groupBy("f1", "f2", "n", "part", "chunk").agg(F.lit(1).alias("one"))
    return different.groupBy("f1", "f2", "n", "part").agg(F.count("*").alias("k")).where("k > 1").select("f1", "f2", "n").distinct()


def exact_groups(docs: DataFrame, hashes=HASHES, size: int = COMPARE_CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes."""
    prints = stage(fingerprints(docs, hashes).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    print_key = ["f1", "f2", "n"]
    repeated = stage(prints.groupBy(*print_key).agg(F.count("*").alias("k")).where("k > 1").select(*print_key), "repeated")
    ids = stage(prints.join(small_side(repeated, BROADCAST_ROWS), print_key, "left_semi").select("doc_id").distinct(), "repeated-ids")
    collided = stage(collisions(docs, small_side(ids, BROADCAST_ROWS), hashes, size), "collided")
    if collided.isEmpty():
        rows = prints.withColumn("text", F.lit(""))
    else:  # the SHA-256 only pairs rows with their texts; equality is decided on the text
        bad = docs.select(F.decode(_normalised(F.col("text")), "utf-8").alias("text"))
        bad = bad.withColumn("text_sha256", F.sha2(F.encode("text", "utf-8"), 256)).distinct()
        wrong = prints.join(collided, print_key, "left_semi").select("text_sha256").distinct()
        texts = bad.join(wrong, "text_sha256", "left_semi")
        rows = prints.join(texts, "text_sha256", "left").withColumn("text", F.coalesce("text", F.lit("")))
    key = [*print_key, "text"]
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    # only groups of several rows meet their rows again: one row for each such group, staged, so that Spark can split the rows of a large one
    groups = stage(rows.groupBy(*key).agg(F.min(first).alias("first"), F.count("*").alias("group_size")).where("group_size > 1"), "exact-groups")
    own = F.col("first").isNull()
    return rows.join(small_side(groups, BROADCAST_ROWS) if collided.isEmpty() else groups, key, "left").select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (own | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
        F.col("n").alias("n_bytes"),
    )


def _normalised(text):
    return F.encode(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " "), "utf-8")


def drop_copies(docs: DataFrame, hashes=HASHES) -> DataFrame:
    """``docs`` with its own columns, one row of each group of equal texts."""
    groups = stage(exact_groups(docs, hashes), "exact-groups")
    lost = small_side(stage(groups.where(~F.col("kept")).select("doc_id").distinct(), "exact-lost"), BROADCAST_ROWS)
    same = docs["doc_id"].eqNullSafe(lost["doc_id"])
    whole = docs.join(lost, same, "left_anti")
    split = lost.join(groups.where("kept").select(F.col("doc_id").alias("stays")), F.col("doc_id").eqNullSafe(F.col("stays")), "left_semi")
    if split.isEmpty():
        return whole
    # Repeated ids: some rows of the id stay and others go, so each text of such an id is looked at by itself.
    kept = groups.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__kept"))
    again = docs.join(lost, same, "left_semi").withColumn("__sha", F.sha2(_normalised(docs["text"]), 256))
    again = again.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__kept")), "left_semi")
    return whole.unionByName(again.dropDuplicates(["doc_id", "__sha"]).select(*docs.columns))
