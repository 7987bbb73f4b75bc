"""Phrases and scores of the document index in shards of chunks.

A shard is a bounded number of chunks with all their postings that a search needs, so a phrase is matched, and a query is scored, inside one
task: what leaves it are the hits of each unit once, and then k rows for each query. No pair of a query and a chunk is shuffled.

A unit is a term or several in a row. Units are known by number, on the driver as in the tasks; there are as many as the queries have distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from recollect.operators.lexical import K1, B
from recollect.runtime import bound_batches, tidied

#: Tokens and chunks of a shard, about; a smaller index has a shard for each LEAST_TOKENS up to the number of cores.
SHARD_TOKENS = 1 << 20
SHARD_CHUNKS = 1 << 15
LEAST_TOKENS = 1 << 17
#: Rows that a task holds before it hands them on.
FLUSH_ROWS = 100_000

_HITS = "shard int, ids binary, paths array<string>, dl binary, units array<int>, df array<int>, chunks binary, f binary"


def shard_count(chunks: int, tokens: int, cores: int) -> int:
    return max(tokens // SHARD_TOKENS + 1, chunks // SHARD_CHUNKS + 1, min(cores, tokens // LEAST_TOKENS + 1))


class Units:
    """Numbers of terms and of units (lists of terms), with the phrases as a tree of term after term."""

    def __init__(self, units: list[list[str]]):
        self.terms = {t: i for i, t in enumerate(sorted({t for u in units for t in u}))}
        edges: dict[tuple[int, int], int] = {}
        named = {}
        self.single = np.full(len(self.terms), -1, dtype=np.int64)
        self.in_phrase = np.zeros(len(self.terms), dtype=bool)
        for number, unit in enumerate(units):
            places = [self.terms[t] for t in unit]
            if len(places) == 1:
                self.single[places[0]] = number
                continue
            self.in_phrase[places] = True
            node = 0
            for t in places:
                node = edges.setdefault((node, t), len(edges) + 1)
            named[node] = number
        self.keys = np.array([n * len(self.terms) + t for n, t in edges], dtype=np.int64)
        order = np.argsort(self.keys)
        self.keys, self.child = self.keys[order], np.array(list(edges.values()), dtype=np.int64)[order]
        self.unit = np.full(len(edges) + 1, -1, dtype=np.int64)
        self.unit[list(named)] = list(named.values())

    def after(self, node: np.ndarray, term: np.ndarray) -> np.ndarray:
        """The nodes behind nodes by terms, -1 where no phrase goes on so."""
        if not len(self.keys):
            return np.full(len(node), -1, dtype=np.int64)
        key = node * len(self.terms) + term
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], -1)

    def phrases(self, code: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, index of its last entry) wherever a phrase stands; ``code`` ascends, by one from a place to the next."""
        if not len(code):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        goes_on = np.append(code[1:] == code[:-1] + 1, False)
        at, node = np.arange(len(code)), self.after(np.zeros(len(code), dtype=np.int64), term)
        found = []
        while True:
            going = node >= 0
            at, node = at[going], node[going]
            if not len(at):
                break
            done = self.unit[node] >= 0
            found.append((self.unit[node[done]], at[done]))
            more = goes_on[at]
            at = at[more] + 1
            node = self.after(node[more], term[at])
        units, ends = zip(*found, strict=True) if found else ((np.zeros(0, dtype=np.int64),),) * 2
        return np.concatenate(units), np.concatenate(ends)


def _matched(shard: int, rows: pa.Table, units: Units) -> pa.RecordBatch:
    """The hits of one shard by unit; chunks by path and id, so that their order breaks ties."""
    own = rows.filter(pc.is_null(rows["term"])).select(["chunk_id", "path", "dl"])
    own = own.take(pc.sort_indices(own, sort_keys=[("path", "ascending"), ("chunk_id", "ascending")]))
    ids = own["chunk_id"].to_numpy()
    posts = rows.filter(pc.is_valid(rows["term"]))
    by_id = np.argsort(ids, kind="stable")
    asked = posts["chunk_id"].to_numpy()
    at = np.minimum(np.searchsorted(ids[by_id], asked), max(0, len(ids) - 1))
    known = ids[by_id[at]] == asked if len(ids) else np.zeros(len(asked), dtype=bool)  # others belong to versions that are gone
    posts, chunk = posts.filter(pa.array(known)), by_id[at[known]] if len(ids) else at[known]
    term = posts["term"].to_numpy().astype(np.int64)
    alone = units.single[term]
    unit, where, often = [alone[alone >= 0]], [chunk[alone >= 0]], [posts["f"].to_numpy().astype(np.int64)[alone >= 0]]
    placed = units.in_phrase[term]
    if placed.any():
        lists = posts["places"].filter(pa.array(placed)).combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        times = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        code = (np.repeat(chunk[placed], times).astype(np.int64) << 32) + lists.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(code)
        code, by_place = code[order], np.repeat(term[placed], times)[order]
        number, end = units.phrases(code, by_place)
        key, count = np.unique(number * max(1, len(ids)) + (code[end] >> 32), return_counts=True)
        unit.append(key // max(1, len(ids)))
        where.append(key % max(1, len(ids)))
        often.append(count)
    unit, where, often = np.concatenate(unit), np.concatenate(where), np.concatenate(often)
    order = np.lexsort((where, unit))
    unit, where, often = unit[order], where[order].astype(np.int32), often[order].astype(np.int32)
    names, df = np.unique(unit, return_counts=True)
    of = lambda x, kind: pa.array([x], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([ids.tobytes()], pa.binary()), of(own["path"].to_pylist(), pa.string()), pa.array([own["dl"].to_numpy().astype(np.int32).tobytes()], pa.binary()),
         of(names, pa.int32()), of(df, pa.int32()), pa.array([where.tobytes()], pa.binary()), pa.array([often.tobytes()], pa.binary())],
        names=["shard", "ids", "paths", "dl", "units", "df", "chunks", "f"],
    )


def hits(chunks: DataFrame, posts: DataFrame, units: Units, shards: int) -> DataFrame:
    """A row for each shard with the hits of every unit: ``chunks`` (chunk_id, path, dl) are all that count, ``posts`` (chunk_id, term, places) the postings by number of term."""
    bound_batches(chunks.sparkSession, 1 << 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:], strict=False):
                if at is not None and at != shard[a]:
                    yield _matched(at, pa.Table.from_batches(held), units)
                    held = []
                at = int(shard[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield _matched(at, pa.Table.from_batches(held), units)

    none = lambda kind: F.lit(None).cast(kind)
    shard = F.pmod("chunk_id", F.lit(shards)).cast("int").alias("shard")
    own = chunks.select(shard, "chunk_id", none("int").alias("term"), none("int").alias("f"), none("array<int>").alias("places"), "path", F.col("dl").cast("int").alias("dl"))
    phrased = F.when(F.col("phrase"), F.col("places")).alias("places")
    rest = posts.select(shard, "chunk_id", F.col("no").alias("term"), F.size("places").alias("f"), phrased, none("string").alias("path"), none("int").alias("dl"))
    return own.unionByName(rest).repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(tidied(run), _HITS)


def best(found: DataFrame, ids: list, words: list[np.ndarray], idf: np.ndarray, avgdl: float, k: int, root: str | None, id_type: st.DataType) -> DataFrame:
    """query_id, chunk_id, path, score: of each shard of ``found`` the k best chunks for each query (``ids``, with its units in ``words``).

    Scores are negative and rounded to six places; equal ones go by path and chunk_id.
    """
    schema = st.StructType([st.StructField("query_id", id_type), st.StructField("chunk_id", st.LongType()), st.StructField("path", st.StringType()), st.StructField("score", st.DoubleType())])
    stop = np.cumsum([len(w) for w in words])
    asked = np.concatenate([np.zeros(0, dtype=np.int64), *words])
    start = np.append(0, stop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(batch.num_rows):
                number, paths = np.frombuffer(batch["ids"][s].as_py(), dtype=np.int64), batch["paths"][s].values
                n, dl = len(number), np.frombuffer(batch["dl"][s].as_py(), dtype=np.int32)
                units, df = (batch[c][s].values.to_numpy(zero_copy_only=False) for c in ("units", "df"))
                if not len(units):
                    continue
                chunk, f = (np.frombuffer(batch[c][s].as_py(), dtype=np.int32) for c in ("chunks", "f"))
                weight = f * (K1 + 1) / (f + K1 * (1 - B + B * dl[chunk] / avgdl))
                inside = np.asarray(pc.or_(pc.starts_with(paths, root + "/"), pc.equal(paths, root))) if root else None
                ends = np.cumsum(df)
                place = np.minimum(np.searchsorted(units, asked), len(units) - 1)
                place[units[place] != asked] = -1
                rows, size = [], 0
                for q in range(len(words)):
                    mine = place[start[q] : start[q + 1]]
                    mine = mine[mine >= 0]
                    if not len(mine):
                        continue
                    spans = [(int(ends[u] - df[u]), int(ends[u]), idf[units[u]]) for u in mine.tolist()]
                    at = np.concatenate([chunk[a:b] for a, b, _ in spans])
                    parts = np.concatenate([weight[a:b] * i for a, b, i in spans])
                    if len(at) * 8 < n:
                        which, at = np.unique(at, return_inverse=True)
                        score = np.bincount(at, weights=parts)
                    else:
                        score = np.bincount(at, weights=parts, minlength=n)
                        which = np.flatnonzero(score)
                        score = score[which]
                    if inside is not None:
                        which, score = which[inside[which]], score[inside[which]]
                    score = np.floor(score * 1e6 + 0.5) / 1e6
                    if len(which) > k:
                        keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                        which, score = which[keep], score[keep]
                    first = np.lexsort((which, -score))[:k]
                    rows.append((q, which[first], 0.0 - score[first]))
                    size += len(first)
                    if size >= FLUSH_ROWS:
                        yield _rows(rows, ids, number, paths, schema)
                        rows, size = [], 0
                if size:
                    yield _rows(rows, ids, number, paths, schema)

    return found.select("ids", "paths", "dl", "units", "df", "chunks", "f").mapInArrow(tidied(run), schema)


def _rows(rows: list[tuple], ids: list, number: np.ndarray, paths: pa.Array, schema: st.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    which, score = np.concatenate([w for _, w, _ in rows]), np.concatenate([s for _, _, s in rows])
    names = pa.array([ids[q] for q, _, _ in rows], to_arrow_type(schema["query_id"].dataType)).take(pa.array(np.repeat(np.arange(len(rows)), [len(w) for _, w, _ in rows])))
    return pa.RecordBatch.from_arrays([names, pa.array(number[which]), paths.take(pa.array(which)), pa.array(score)], names=schema.names)


def posted(rows: DataFrame, gap: int) -> DataFrame:
    """term, chunk_id, path, places, dl, version: the postings of ``rows`` (chunk_id, path, dl, version, t0, t1, ...) whose token lists follow each other ``gap`` places apart."""
    lists = [c for c in rows.columns if c[0] == "t" and c[1:].isdigit()]
    bound_batches(rows.sparkSession, 1 << 12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = np.zeros(batch.num_rows, dtype=np.int64)
            terms, row, place = [], [], []
            for c in lists:
                size = pc.fill_null(pc.list_value_length(batch[c]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                terms.append(batch[c].flatten())
                row.append(np.repeat(np.arange(batch.num_rows), size))
                place.append(np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(base, size))
                base += size + gap
            coded = pa.concat_arrays(terms).dictionary_encode()
            code, row, place = coded.indices.to_numpy(zero_copy_only=False), np.concatenate(row), np.concatenate(place)
            if not len(code):
                continue
            order = np.lexsort((place, code, row))
            code, row, place = code[order], row[order], place[order]
            head = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])]))
            places = pa.ListArray.from_arrays(pa.array(np.append(head, len(code)).astype(np.int32)), pa.array(place.astype(np.int32)))
            of = pa.array(row[head])
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[head])), batch["chunk_id"].take(of), batch["path"].take(of), places, batch["dl"].take(of), batch["version"].take(of)], names=["term", "chunk_id", "path", "places", "dl", "version"])

    return rows.select("chunk_id", "path", "dl", "version", *lists).mapInArrow(tidied(run), "term string, chunk_id long, path string, places array<int>, dl int, version long")
