"""Personal data: fixed patterns, and terms that give the protected entity away.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers. The method then estimates from the
whole corpus how strongly a term reveals what is protected, as the share of the information about it that the term
gives: with counts n of whole documents, ``PMI = log(n(e,t) * N / (n(e) * n(t)))`` over ``IC = log(N / n(e))``.

* An *entity* is one address or number. A term that reaches ``DISCLOSURE`` with one, in several documents of the entity with different
  words, is a further span (kind ``term``) wherever it stands in a document that holds the entity.
* The *concept* is that a document holds any entity. Most entities stand in a single document, so what gives personal data away in
  general is estimated here: the probability of the concept given a term, taken at the lower end of a confidence interval (``CONFIDENCE`` standard
  deviations), has to give ``CONCEPT_DISCLOSURE`` of the concept's information. Such a term is a span in every document. Documents with the same least hash of three terms in a row (near copies) count once for a term.

Terms are words of three letters or more, and identifiers: runs of 16 or more letters, digits and ``+/_=-`` with a letter and a
digit. A single identifier is too rare to be counted, so identifiers are counted as their class (kinds of characters and length, as a power of two).

``sanitised`` replaces base spans by their kind and identifiers by ``<id>`` (generalisation), and removes other disclosing terms.

Defined cases: null counts as empty; matches that fail their test (a part over 255, digit counts, Luhn) are
dropped without another try; spans are code points, end exclusive; repeated rows get equal rows; documents with equal words (copies) count once as support;
a null doc_id is a document like any other; very long texts are read whole; terms of equal strength are all spans; with an empty table there are no statistics and no rows; extra columns are ignored
(``sanitised`` keeps them as they are).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.runtime import bound_batches, release, small_side, stage, tidied

KINDS = ("email", "ip", "card", "phone")
MIN_CONTEXTS = 3
DISCLOSURE = 0.9
CONCEPT_DISCLOSURE = 0.7
CONFIDENCE = 3.0
#: Candidate terms, and disclosing pairs, sent to the executors as a set, up to this many; more are joined by shuffle.
BROADCAST_TERMS = 100_000
#: Counts, or hashes of terms, that a task holds before it passes them on; and ranges of hashes that tasks pass counts on by.
HELD_COUNTS = 50_000
HELD_HASHES = 2_000_000
BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits that an earlier start could have taken, so the run is taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"(?P<id>(?=[A-Za-z0-9+/_=-]{16})(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]+)|[^\W\d_]{3,}")
_IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def identifier_class(run: str) -> str:
    """``#`` with the kinds of characters of an identifier and its length, rounded down to a power of two."""
    kinds = "".join(k for k, has in (("l", str.islower), ("u", str.isupper), ("d", str.isdigit)) if any(map(has, run)))
    return f"#{kinds}{'' if run.isalnum() else 's'}{1 << (len(run).bit_length() - 1)}"


def terms_of(text: str) -> list[tuple[str, int, int]]:
    """(term, start, end) of every term of the text."""
    return [(identifier_class(m.group()) if m.lastgroup else m.group().lower(), m.start(), m.end()) for m in _TERM.finditer(text)]


def outside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of every term that overlaps no span."""
    edges = sorted((a, b) for _, a, b in spans)
    out, i, far = [], 0, 0
    for term, start, end in terms_of(text):
        while i < len(edges) and edges[i][0] < end:
            far = max(far, edges[i][1])
            i += 1
        if far <= start:
            out.append((term, start, end))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def entities(text: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """The protected entities of the text, each once."""
    values = [(kind, text[start:end].lower()) for kind, start, end in spans]
    return sorted({_hash(f"{k}:{''.join(filter(str.isdigit, v)) if k in ('card', 'phone') else v}") for k, v in values})


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _parsed(written: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in written.split(",") if s)]


_SCAN = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("concept", T.StringType()),
        T.StructField("entities", T.ArrayType(T.LongType())),
        T.StructField("context", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def numbered(docs: DataFrame) -> DataFrame:
    """row, doc_id, text."""
    return _plain(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")


def scan(rows: DataFrame, terms: frozenset[str] = frozenset()) -> DataFrame:
    """Base spans of every one of ``rows`` (row, doc_id, text), and the places of ``terms`` outside them; of rows with base spans also the entities, a hash of the words outside the spans, and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            spans = [base_spans(t) for t in texts]
            counts = [Counter(k for k, _, _ in s) for s in spans]
            written = [_written(s) for s in spans]
            concept = [",".join(f"term:{a}:{b}" for w, a, b in outside(t, s) if w in terms) if terms else "" for t, s in zip(texts, spans, strict=True)]
            own = [entities(t, s) for t, s in zip(texts, spans, strict=True)]
            context = [_hash(" ".join(w for w, _, _ in outside(t, s))) if s else None for t, s in zip(texts, spans, strict=True)]
            held = [t if s else None for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS], pa.array([hashlib.sha256(w.encode()).hexdigest() for w in written], pa.string()), pa.array(written, pa.string()), pa.array(concept, pa.string()), pa.array(own, pa.list_(pa.int64())), pa.array(context, pa.int64()), pa.array(held, pa.string())],
                names=_SCAN.fieldNames(),
            )

    return rows.mapInArrow(tidied(run), _SCAN)


def kinship(terms: list[str], width: int = 3) -> int:
    """Least hash of the runs of ``width`` terms, which near copies mostly have in common."""
    return min(_hash(" ".join(terms[i : i + width])) for i in range(max(1, len(terms) - width + 1)))


def holders(docs: DataFrame) -> DataFrame:
    """kin, terms, n, n_holders: of each document with an entity its kinship and its distinct terms; for each task a row with its numbers of documents and of such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        names = ["kin", "terms", "n", "n_holders"]
        held = 0
        for batch in batches:
            n += batch.num_rows
            kin, terms = [], []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                if spans:
                    found = [t for t, _, _ in outside(text, spans)]
                    kin.append(kinship(found))
                    terms.append(sorted(set(found)))
            held += len(kin)
            none = pa.nulls(len(kin), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(kin, pa.int64()), pa.array(terms, pa.list_(pa.string())), none, none], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.string())), pa.array([n], pa.int64()), pa.array([held], pa.int64())], names=names)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), "kin long, terms array<string>, n long, n_holders long")


def disclosed(n_both: int, n_term: int, n_holders: int, total: int, confidence: float = CONFIDENCE) -> float:
    """Share of the concept's information that a term gives, at the lower end (Wilson) of the interval of its probability."""
    n, p, z = max(n_term, n_both), min(1.0, n_both / max(n_term, n_both)), confidence
    low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    prior = n_holders / total
    return math.log(low / prior) / -math.log(prior) if low > 0 and prior < 1 else 0.0


def _disclosed_column(n_both, n_term, n_holders: int, total: int, confidence: float = CONFIDENCE):
    n, z, prior = F.greatest(n_term, n_both), confidence, n_holders / total
    p = n_both / n
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return F.when(low > 0, F.log(low / prior) / -math.log(prior)).otherwise(0.0)


def concept_terms(docs: DataFrame, threshold: float = CONCEPT_DISCLOSURE, bound: int = BROADCAST_TERMS) -> DataFrame:
    """term, n_both, n_term, disclosure: the terms that give away, in any document, that it holds an entity (staged)."""
    rows = stage(holders(docs), "pii-holders")
    sums = rows.agg(F.sum("n").alias("n"), F.sum("n_holders").alias("k")).first()
    total, k = sums["n"] or 0, sums["k"] or 0
    empty = "term string, n_both long, n_term long, disclosure double"
    if not 0 < k < total or disclosed(k, k, k, total) < threshold:
        return docs.sparkSession.createDataFrame([], empty)
    # the least support that can reach the threshold, with a term that only holders have
    support = next(n for n in range(1, k + 1) if disclosed(n, n, k, total) >= threshold)
    once = rows.where("kin is not null").groupBy("kin").agg(F.min("terms").alias("terms"))
    both = once.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    both = stage(both, "pii-concept-pairs")
    release(rows)
    if both.isEmpty():
        return docs.sparkSession.createDataFrame([], empty)
    joined = both.join(document_counts(docs, both.select("term"), bound), "term")
    joined = joined.withColumn("disclosure", _disclosed_column(F.col("n_both"), F.col("n_term"), k, total))
    return stage(joined.where(F.col("disclosure") >= threshold).select("term", "n_both", "n_term", "disclosure"), "pii-concept")


def _concept_by_shuffle(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """row, concept: the places of ``terms`` in ``rows`` (row, text), where they are too many to be sent to every task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                flat = [(row, *t) for t in outside(text or "", base_spans(text))]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], kind) for i, kind in enumerate(kinds)], names=["row", "term", "start", "stop"])

    found = rows.select("row", "text").mapInArrow(tidied(each), "row long, term string, start long, stop long").join(terms.select("term"), "term", "left_semi")
    written = F.transform(F.sort_array(F.collect_list(F.struct("start", "stop"))), lambda s: F.concat(F.lit("term:"), s["start"], F.lit(":"), s["stop"]))
    return found.groupBy("row").agg(F.array_join(written, ",").alias("concept"))


def document_counts(docs: DataFrame, terms: DataFrame, bound: int = BROADCAST_TERMS) -> DataFrame:
    """term, n_term: in how many rows of ``docs`` each of ``terms`` stands. The bound decides what tasks pass on, not what is a term.

    Terms are counted by 64-bit hashes; a task passes its counts on as one row for each of ``BUCKETS`` ranges of hashes. The hashes of up to ten times
    ``bound`` terms (8 bytes each) are sent to the tasks, which then count no others.
    """
    named = terms.select("term", F.xxhash64("term").alias("h"))
    wanted = None
    if named.count() <= 10 * bound:
        wanted = np.sort(named.select("h").toArrow().column(0).to_numpy().view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            place = (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            rows = list(zip(edges.tolist(), [*edges[1:].tolist(), len(found)], strict=True))
            blobs = [pa.array([x[i:j].tobytes() for i, j in rows], pa.binary()) for x in (found, times.astype(np.int64))]
            return pa.RecordBatch.from_arrays([pa.array(place[edges]), *blobs], names=["bucket", "hashes", "times"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = {t for t, _, _ in terms_of(text or "")}
                hashes = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) for t in own), np.uint64, len(own))
                if wanted is not None:
                    at = np.searchsorted(wanted, hashes)
                    hashes = hashes[wanted[np.minimum(at, len(wanted) - 1)] == hashes] if len(wanted) else hashes[:0]
                if len(hashes):
                    held.append(hashes)
                    size += len(hashes)
            if size > HELD_HASHES:
                yield flushed()
                size = 0
        if size:
            yield flushed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, times = [], []
        for batch in batches:
            hashes += [np.frombuffer(x, dtype=np.uint64) for x in batch.column(1).to_pylist()]
            times += [np.frombuffer(x, dtype=np.int64) for x in batch.column(2).to_pylist()]
        if hashes:
            found, place = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate(times), minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(total)], names=["h", "n_term"])

    cells = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), "bucket int, hashes binary, times binary")
    sums = cells.repartition("bucket").mapInArrow(tidied(add), "h long, n_term long")
    return named.join(sums, "h").select("term", "n_term")


def together(held: DataFrame, support: int = MIN_CONTEXTS) -> DataFrame:
    """entity, term, n_both: the pairs that stand together in ``support`` documents with different words. ``held``: base, entities, context, text.

    A task passes on one count for each pair and at most ``support`` of its contexts, which is enough to tell whether there are so many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            flat = [(e, t, c, n) for (e, t), of in counts.items() for c, n in of.items()]
            counts.clear()
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], k) for i, k in enumerate(kinds)], names=["entity", "term", "context", "n"])

        counts: dict[tuple[int, str], dict[int, int]] = {}
        for batch in batches:
            for written, own, context, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms = {t for t, _, _ in outside(text, _parsed(written))}
                for entity in own:
                    for term in terms:
                        of = counts.setdefault((entity, term), {})
                        key = context if context in of or len(of) < support else next(iter(of))
                        of[key] = of.get(key, 0) + 1
                    if len(counts) >= HELD_COUNTS:
                        yield flushed()
        yield flushed()

    found = held.select("base", "entities", "context", "text").mapInArrow(tidied(run), "entity long, term string, context long, n long")
    found = found.groupBy("entity", "term", "context").agg(F.sum("n").alias("n")).groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("n_both"))
    return found.where(F.col("contexts") >= support).drop("contexts")


def disclosing(docs: DataFrame, both: DataFrame, entity: DataFrame, total: int, threshold: float = DISCLOSURE) -> DataFrame:
    """entity, term: the pairs at or above the disclosure threshold. ``both``: entity, term, n_both; ``entity``: entity, n_entity."""
    if both.isEmpty():
        return both.select("entity", "term")
    counts = document_counts(docs, stage(both.select("term").distinct(), "pii-terms"))
    joined = both.join(entity, "entity").join(counts, "term")
    n = F.lit(float(total))
    pmi = F.log(F.col("n_both") * n / (F.col("n_entity") * F.greatest("n_term", "n_both")))
    return joined.where((n > F.col("n_entity")) & (pmi / F.log(n / F.col("n_entity")) >= threshold)).select("entity", "term")


_MARKS = "array<struct<start:long,stop:long>>"


def marks(held: DataFrame, pairs: DataFrame, bound: int = BROADCAST_TERMS) -> DataFrame:
    """row, terms: every place of a disclosing term in the rows that hold its entity. ``held``: row, base, entities, text."""
    held = held.select("row", "base", "entities", "text")
    if pairs.count() <= bound:
        terms_with: dict[int, set[str]] = {}
        for r in pairs.collect():  # at most `bound` pairs
            terms_with.setdefault(r["entity"], set()).add(r["term"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, places = [], []
                for row, written, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    wanted = set().union(*(terms_with.get(e, ()) for e in own))
                    if found := [{"start": a, "stop": b} for t, a, b in outside(text, _parsed(written)) if t in wanted] if wanted else []:
                        rows.append(row)
                        places.append(found)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=["row", "terms"])

        return held.mapInArrow(tidied(run), f"row long, terms {_MARKS}")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        for batch in batches:
            for row, written, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                flat = [(row, e, *t) for t in outside(text, _parsed(written)) for e in own]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], k) for i, k in enumerate(kinds)], names=["row", "entity", "term", "start", "stop"])

    found = held.mapInArrow(tidied(each), "row long, entity long, term string, start long, stop long").join(pairs, ["entity", "term"], "left_semi")
    return found.select("row", "start", "stop").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("terms"))


def _found(numbered_rows: DataFrame, docs: DataFrame, threshold: float, support: int, bound: int) -> DataFrame:
    """row and the columns of ``find``; ``numbered_rows``: row, doc_id, text of ``docs``."""
    terms = concept_terms(docs, bound=bound)
    if terms.count() <= bound:
        rows = scan(numbered_rows, frozenset(r["term"] for r in terms.select("term").collect()))  # at most `bound` words
        rows = stage(rows, "pii-scan")
    else:
        numbered_rows = stage(numbered_rows, "pii-rows")
        places = _concept_by_shuffle(numbered_rows, terms)
        rows = stage(scan(numbered_rows).drop("concept").join(places, "row", "left").withColumn("concept", F.coalesce("concept", F.lit(""))), "pii-scan")
    each = rows.where("text is not null").select("row", "context", F.explode("entities").alias("entity"))
    seen = each.groupBy("entity", "context").agg(F.count("*").alias("n")).groupBy("entity").agg(F.count("*").alias("contexts"), F.sum("n").alias("n_entity"))
    entity = stage(seen.where(F.col("contexts") >= support).select("entity", "n_entity"), "pii-entities")
    added = None
    if not entity.isEmpty():
        own = each.join(small_side(entity.select("entity"), bound), "entity", "left_semi").groupBy("row").agg(F.collect_list("entity").alias("entities"))
        held = stage(rows.where("text is not null").select("row", "base", "context", "text").join(own, "row"), "pii-held")
        pairs = stage(disclosing(docs, stage(together(held, support), "pii-pairs"), entity, rows.count(), threshold), "pii-disclosing")
        added = marks(held, pairs, bound)
    place = lambda s: F.struct(F.split(s, ":")[1].cast("long").alias("start"), F.split(s, ":")[2].cast("long").alias("stop"))
    concept = F.transform(F.when(F.col("concept") == "", F.array().cast("array<string>")).otherwise(F.split("concept", ",")), place)
    if added is None:
        places = concept
    else:
        rows = rows.join(added, "row", "left")
        places = F.array_sort(F.array_union(concept, F.coalesce("terms", F.array().cast(_MARKS))))
    spans = F.transform(places, lambda s: F.concat(F.lit("term:"), s["start"], F.lit(":"), s["stop"]))
    return rows.select(
        "row",
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        "base_sha256",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), spans).alias("spans"),
        F.size(spans).cast("long").alias("n_term"),
    )


def find(docs: DataFrame, threshold: float = DISCLOSURE, support: int = MIN_CONTEXTS, bound: int = BROADCAST_TERMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts by kind, base_sha256, spans (base and added), n_term."""
    bound_batches(docs.sparkSession)
    return _found(numbered(docs), docs, threshold, support, bound).drop("row")


def sanitise(text: str, spans: str) -> str:
    """The text with base spans replaced by ``<kind>``, disclosing identifiers by ``<id>``, and other disclosing terms removed."""
    out, at = [], 0
    parsed = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    for start, stop, kind in parsed:
        if start >= at:
            general = "<id>" if _IDENTIFIER.fullmatch(text, start, -stop) else ""
            out += [text[at:start], general if kind == "term" else f"<{kind}>"]
        at = max(at, -stop)
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, threshold: float = DISCLOSURE, support: int = MIN_CONTEXTS, bound: int = BROADCAST_TERMS) -> DataFrame:
    """``docs`` with sanitised texts; null texts and every other column stay as they are."""
    bound_batches(docs.sparkSession)
    whole = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")), "pii-whole")
    plain = whole.select("row", F.col("r.doc_id").cast("long").alias("doc_id"), F.col("r.text").cast("string").alias("text"))
    spans = _found(plain, plain, threshold, support, bound).where("spans != ''").select("row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [sanitise(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string())], names=["row", "clean"])

    clean = plain.join(spans, "row").select("row", "text", "spans").mapInArrow(tidied(run), "row long, clean string")
    both = whole.join(clean, "row", "left")
    text = F.coalesce("clean", F.col("r.text"))
    return both.select(*[text.alias(c) if c == "text" else F.col(f"r.`{c}`").alias(c) for c in docs.columns])


__all__ = ["base_spans", "concept_terms", "disclosed", "disclosing", "document_counts", "entities", "find", "marks", "outside", "sanitise", "sanitised", "scan", "terms_of", "together"]
