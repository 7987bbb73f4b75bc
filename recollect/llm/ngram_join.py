"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles, held as 64-bit hashes. Two of them link when their Jaccard similarity reaches
the threshold; the result is each document's set size and the smallest doc_id of its linked component.

1. One pass profiles every document: set size, a 128-bit fingerprint of the set, a few minimum hashes, a parity signature
   (``signatures.py``) and a counting sketch of all shingles. Documents with equal sets become one class, known by its smallest doc_id.
2. Similar classes are partitioned into groups. Classes that share a minimum hash are dealt into blocks; within a block
   signatures say which may link, and a star around the best-linked class, with a forest for the rest, is verified
   on the sets; so is every class of a key that fills several blocks against the key's best-linked class. The components of the verified links are the groups.
3. The token-group matrix holds, by token, the groups that have it in a member's prefix: a group's row is the union of its
   members' prefixes. A prefix is the ``n - ceil(t * n) + 1`` first shingles in an order that puts shingles the sketch
   found frequent last, then goes by hash; two sets that link share a token of both prefixes, so no link is lost.
   For two groups the matrix counts the tokens their unions share, which bounds the overlap of any two members;
   only pairs of groups whose bound reaches what the sizes ask for qualify. The larger one is opened for the other.
   Groups that meet in a token of more than ``PAIRED_GROUPS`` groups are opened together, as a crowd named by its largest group.
4. What is opened is dealt into blocks, and every pair of blocks is a task of its own, so the members of one group or crowd
   may be any share of the corpus. Signatures bound the overlap of every two members of different groups; those that may link are verified on
   the whole sets. First each member meets its nearest one of each other group only; groups that this joins are one from then
   on, and whatever else may link between groups that are still apart is verified in a second turn.

The order only has to be the same everywhere, so a sketch of fixed size serves any corpus: a frequent shingle it misses
costs time, not links. Rows are classes, groups, or pairs that a bound could not rule out, never the pairs of a group's members.

Defined cases: A-Z is lower-cased and words are ``[^\\x20\\x09-\\x0D]+``; with fewer words than a shingle the whole sequence
is one; null and empty texts, and texts of white space, have no shingles and link with nothing; repeated rows of a doc_id get one
row each, with the component of its smallest linked id, and are one document (``one_of_each`` keeps one of them, that of the smallest text); a null
doc_id has a null component, links nothing and stays; very long texts are hashed in blocks; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm.components import components
from recollect.llm.signatures import keyed, near, signature
from recollect.runtime import bound_batches, release, small_side, stage, tidied

WIDTH = 5
THRESHOLD_PERCENT = 75
MIN_HASHES = 3
#: Counters of the shingle sketch, by the hash's top bits; the frequent ones become a bitmap of 512 KiB.
SKETCH_BITS = 22
SLICES = 64
#: Buckets of tokens for each task that meets the matrix's rows, as a power of two, and the most bits of a bucket.
SPARE_BITS = 5
MOST_BITS = 20
#: Fixed-width rows (16 to 24 bytes) broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Prefix tokens, or pairs of groups, that a task holds before it hands them on.
FLUSH_TOKENS = 500_000
#: Shingles of the corpus for each task that meets the matrix's rows; a quarter of them are in prefixes.
TOKENS_PER_TASK = 4_000_000
#: Groups with one token that the matrix still pairs; more of them are a crowd, which is opened as a whole.
PAIRED_GROUPS = 32
#: Sets and shingles of a block at most (a single larger set is a block of its own); what fills SPREAD_SETS is dealt into up to SPREAD blocks.
BLOCK_SETS = 512
BLOCK_TOKENS = 1 << 21
SPREAD = 8
SPREAD_SETS = 128
#: Pairs of one set that are verified in one task.
SALT_ROWS = 256
#: Bytes hashed at once.
BLOCK = 1 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_PLACE = _RNG.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _RNG.integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class ShingleHasher:
    """Sets of shingle hashes of UTF-8 texts, without a Python step for each word."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self._grow(BLOCK)

    def _grow(self, size: int) -> None:
        self.up = np.full(size + 1, _RADIX, dtype=np.uint64)
        self.down = np.full(size + 1, _INVERSE, dtype=np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def _words(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of each word of a byte array that holds no part of a word."""
        if len(raw) >= len(self.up):
            self._grow(len(raw))
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * self.up[: len(raw)], out=total[1:])
        return _mix((total[stop] - total[start]) * self.down[start] + (stop - start).astype(np.uint64)), start

    def words(self, data: bytes) -> np.ndarray:
        """Hash of each word of one text, in blocks that end at white space."""
        raw = np.frombuffer(data, dtype=np.uint8)
        if len(raw) <= BLOCK:
            return self._words(raw)[0]
        out, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + BLOCK)
            while end < len(raw) and not _SPACE[raw[end]]:
                more = np.flatnonzero(_SPACE[raw[end : end + BLOCK]])
                end = end + int(more[0]) if len(more) else min(len(raw), end + BLOCK)
            out.append(self._words(raw[at:end])[0])
            at = end
        return np.concatenate(out)

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        k = self.width
        if len(words) < k:
            return _mix(np.array([(words * _PLACE[8 : 8 + len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))], dtype=np.uint64))
        n = len(words) - k + 1
        out = words[:n] * _PLACE[0]
        for i in range(1, k):
            out += words[i : i + n] * _PLACE[i]
        return _mix(out)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text; short texts are hashed together."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(raw)
        at = 0
        while at < len(raw):
            stop, size = at, 0
            while stop < len(raw) and (stop == at or size + len(raw[stop]) + 1 <= BLOCK):
                size += len(raw[stop]) + 1
                stop += 1
            if stop == at + 1:
                words = [self.words(raw[at])]
            else:
                ends = np.cumsum([len(r) + 1 for r in raw[at:stop]])
                hashes, start = self._words(np.frombuffer(b"\n".join(raw[at:stop]), dtype=np.uint8))
                words = np.split(hashes, np.searchsorted(start, ends[:-1]))
            for i, w in enumerate(words, at):
                if len(w):
                    s = self._shingles(w)
                    s.sort()
                    out[i] = s[np.concatenate([[True], s[1:] != s[:-1]])]
            at = stop
        return out


def needed(n_a: int, n_b: int, percent: int = THRESHOLD_PERCENT) -> int:
    """Smallest intersection at which sets of these sizes link."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def prefix_length(n: int, percent: int = THRESHOLD_PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def profile(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per row of ``docs`` (doc_id, n, f1, f2, mins, signature) and, for each task, the slices of its shingle sketch."""
    bound_batches(docs.sparkSession)
    per = (1 << SKETCH_BITS) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        names = ["doc_id", "n", "f1", "f2", "mins", "signature", "slice", "counts"]
        for batch in batches:
            sets = hasher.sets(batch.column(1).to_pylist())
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            cells, times = np.unique((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
            counts[cells] += times.astype(np.uint32)
            f1 = [int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            f2 = [int(_mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            mins = [[int((s * seed).min().view(np.int64)) for seed in _SEEDS[:MIN_HASHES]] if len(s) else [] for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(mins, pa.list_(pa.int64())), pa.array([signature(s) if len(s) else None for s in sets], pa.binary()), none, pa.nulls(len(sets), pa.binary())], names=names)
        if counts.any():
            parts = [np.minimum(counts[i * per : (i + 1) * per], 65535).astype(np.uint16) for i in range(SLICES)]
            rows = [(i, p.tobytes()) for i, p in enumerate(parts) if p.any()]
            k = len(rows)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(k, pa.int64()) for _ in range(4)], pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.binary()), pa.array([i for i, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=names)

    return _docs(docs).mapInArrow(tidied(run), "doc_id long, n long, f1 long, f2 long, mins array<long>, signature binary, slice int, counts binary")


def frequent_bitmap(sketches: DataFrame, total: int) -> bytes:
    """One bit for each sketch counter: well above what an even spread of ``total`` shingles gives it."""
    mean = total / (1 << SKETCH_BITS)
    limit = mean + 6 * mean**0.5 + 12
    per = (1 << SKETCH_BITS) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(blob, dtype=np.uint16).astype(np.uint64)
        bits = [np.packbits(s > limit).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["slice", "bits"])

    rows = sketches.select("slice", "counts").repartition("slice").mapInArrow(tidied(run), "slice int, bits binary").collect()  # SLICES rows
    whole = np.zeros((1 << SKETCH_BITS) // 8, dtype=np.uint8)
    for r in rows:
        whole[r["slice"] * per // 8 : (r["slice"] + 1) * per // 8] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return whole.tobytes()


def verified(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """u, v: the staged pairs (u, v) of doc_ids whose sets link, on the sets of their whole texts.

    The sets to compare with one v come to it in tasks of bounded size, each beside v's own set, so a set travels once for each pair.
    """
    often = pairs.groupBy("v").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")).where("salts > 1")
    often = small_side(stage(often, "jaccard-often"), BROADCAST_ROWS)
    salted = pairs.join(often, "v", "left").select("v", F.pmod(F.xxhash64("u"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), F.lit(1).alias("follows"), F.col("u").alias("id"))
    roles = salted.unionByName(salted.select("v", "salt", F.lit(0).alias("follows"), F.col("v").alias("id")).distinct())
    wanted = small_side(stage(roles.select("id").distinct(), "jaccard-ids"), BROADCAST_ROWS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        for batch in batches:
            sets = hasher.sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "tokens"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leads = None, []
        for batch in batches:
            u, v = [], []
            for hub, salt, follows, id_, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(blob, dtype=np.uint64)
                if at != (hub, salt):
                    at, leads = (hub, salt), []
                if not follows:
                    leads.append(tokens)
                elif any(_links(tokens, lead, percent) for lead in leads):
                    u.append(id_)
                    v.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    sets = _docs(docs).withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi").select("id", "text").mapInArrow(tidied(hashed), "id long, tokens binary")
    met = sets.join(small_side(roles, BROADCAST_ROWS), "id").select("v", "salt", "follows", "id", "tokens")
    return met.repartition("v", "salt").sortWithinPartitions("v", "salt", "follows").mapInArrow(tidied(linked), "u long, v long").distinct()


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = overlap(a, b)
    return shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared)


def _by_size(columns: list, at: int, signatures: int) -> list:
    """A block's columns by ascending set size (column ``at``)."""
    order = np.lexsort((columns[0], columns[at]))
    return [[c[i] for i in order] if k == signatures else c[order] for k, c in enumerate(columns)]


def block_stars(blocks: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """j, low, u, v, hub, degree: for each block (j, low, slot, id, n, signature) pairs worth verifying, and its best-linked class.

    The pairs are a star around that class and a forest over the rest of what may link, at most one for each class. Pair rows have a null
    hub; a hub row has null u and v.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=["j", "low", "u", "v", "hub", "degree"])

        for (j, low, _), columns in keyed(batches, 3):
            ids, n, marks = _by_size(list(columns), 1, 2)
            a, b, _ = near(n, marks, percent, lambda i, js: slice(None))
            apart = ids[a] != ids[b]
            a, b = a[apart], b[apart]
            if len(a):
                degree = np.bincount(np.concatenate([a, b]), minlength=len(ids))
                best = int(degree.argmax())
                out.append((j, low, None, None, int(ids[best]), int(degree[best])))
                out += [(j, low, int(ids[x]), int(ids[y]), None, None) for x, y in _trees(a, b, best)]
            if len(out) > 10_000:
                yield flushed()
        yield flushed()

    return blocks.select("j", "low", "slot", "id", "n", "signature").repartition("j", "low", "slot").sortWithinPartitions("j", "low", "slot").mapInArrow(tidied(run), "j int, low long, u long, v long, hub long, degree long")


def _trees(a: np.ndarray, b: np.ndarray, root: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the edges (a, b), breadth first, ``root`` first."""
    beside: dict[int, list[int]] = {}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        beside.setdefault(x, []).append(y)
        beside.setdefault(y, []).append(x)
    seen: set[int] = set()
    for first in [root, *beside]:
        if first in seen:
            continue
        seen.add(first)
        todo = [first]
        for x in todo:
            for y in beside[x]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
                    yield y, x


def matrix(docs: DataFrame, status: DataFrame, frequent: bytes, total: int, width: int = WIDTH, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """a, b, shared, small, large: how many tokens two groups meet in, with the sizes that can link there; parts of sums.

    ``status``: id, first (whether it names a class), g (its group) of the documents that are copies or in a group of several;
    ``total``: shingles of the corpus. Rows that share 0 tokens say that group b is in the crowd of token a.
    A part leaves out what two groups share in it where that is so little (``spared``) that pairs that can link keep half of what they have to share.
    """
    rows = _docs(docs).withColumnRenamed("doc_id", "id").where("id is not null")
    rows = rows.join(small_side(status, BROADCAST_ROWS), "id", "left").where("coalesce(first, true)").select(F.coalesce("g", "id").alias("g"), "text")
    parts = part_count(docs, total)
    shift = np.uint64(64 - min(MOST_BITS, parts.bit_length() + SPARE_BITS))
    paired = PAIRED_GROUPS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        bitmap = np.unpackbits(np.frombuffer(frequent, dtype=np.uint8)).astype(bool)
        tokens, group, size, held = [], [], [], 0

        def flushed() -> pa.RecordBatch:
            t, g, n = np.concatenate(tokens), np.repeat(np.array(group, dtype=np.int64), list(map(len, tokens))), np.repeat(np.array(size, dtype=np.int32), list(map(len, tokens)))
            t, g, small, large = _one_each(t, g, n, n)
            bucket = (t >> shift).astype(np.int32)
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(at[1:], len(bucket))
            low = np.ascontiguousarray(t.view(np.uint8).reshape(-1, 8)[:, :5])
            blobs = [(int(bucket[a]), low[a:b].tobytes(), g[a:b].tobytes(), small[a:b].tobytes(), b"" if (small[a:b] == large[a:b]).all() else large[a:b].tobytes()) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
            columns = list(zip(*blobs, strict=True))
            part = pa.array([b % parts for b in columns[0]], pa.int32())
            return pa.RecordBatch.from_arrays([part, pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["part", "bucket", "tokens", "grp", "small", "large"])

        for batch in batches:
            for g, s in zip(batch.column(0).to_pylist(), hasher.sets(batch.column(1).to_pylist()), strict=True):
                if not len(s):
                    continue
                k = prefix_length(len(s), percent)
                common = bitmap[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                chosen = np.concatenate([s[~common], s[common]])[:k] if common.any() else s[:k].copy()
                tokens.append(chosen)
                group.append(g)
                size.append(len(s))
                held += k
                if held > FLUSH_TOKENS:
                    yield flushed()
                    tokens, group, size, held = [], [], [], 0
        if held:
            yield flushed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list] = {}
        for batch in batches:
            for part, bucket, t, g, n, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = np.zeros((len(t) // 5, 8), dtype=np.uint8)
                low[:, :5] = np.frombuffer(t, dtype=np.uint8).reshape(-1, 5)
                by_part.setdefault(part, []).append((low.view(np.uint64).reshape(-1) ^ (np.uint64(bucket) << shift), *(np.frombuffer(x, dtype=kind) for x, kind in ((g, np.int64), (n, np.int32), (m or n, np.int32)))))
        for part in sorted(by_part):
            yield from met_in(by_part.pop(part))

    def met_in(cells: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*cells, strict=True)]
        cells.clear()
        t, g, small, large = _one_each(*columns)
        head = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        tail = np.append(head[1:], len(t))
        many = tail - head > 1
        crowded = np.flatnonzero(many & (tail - head > paired))
        for x in crowded.tolist():
            a, b = int(head[x]), int(tail[x])
            none = pa.array(np.zeros(b - a, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, t[a]).view(np.int64)), pa.array(g[a:b]), pa.array(np.zeros(b - a, dtype=np.int64)), none, none], names=["a", "b", "shared", "small", "large"])
        found: list[tuple] = []
        held = 0
        few = many & (tail - head <= paired)
        for k in np.unique((tail - head)[few]).tolist():  # tokens with equally many groups at once
            starts = head[few & (tail - head == k)]
            i, j = np.triu_indices(k, 1)
            for part in np.array_split(starts, max(1, len(starts) * len(i) // FLUSH_TOKENS)):
                rows = _meetings(g, small, large, (part[:, None] + i).ravel(), (part[:, None] + j).ravel(), percent)
                found.append(rows)
                held += len(rows[0])
                if held > FLUSH_TOKENS:
                    found = [_summed(found)]
                    held = len(found[0][0])
                    if held > FLUSH_TOKENS // 2:  # handed on whole, so a part leaves out a pair's tokens once at most
                        yield _pairs(found[0])
                        found, held = [], 0
        if held:
            rows = _summed(found)
            keep = rows[4] > spared(rows[2], rows[3], parts, percent)
            yield _pairs(tuple(x[keep] for x in rows))

    cells = rows.mapInArrow(tidied(cut), "part int, bucket int, tokens binary, grp binary, small binary, large binary").repartition(parts, "part")
    return cells.mapInArrow(tidied(meet), "a long, b long, shared long, small int, large int")


def part_count(docs: DataFrame, total: int) -> int:
    """Parts into which the tokens of the matrix are dealt, whatever number of tasks meets them."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TOKENS_PER_TASK + 1)


def asked_tokens(small: np.ndarray, large: np.ndarray, percent: int = THRESHOLD_PERCENT) -> np.ndarray:
    """Tokens that the prefixes of linked sets of these sizes share at least: the overlap is no more than that and what lies behind the shorter-reaching prefix."""
    small, large = small.astype(np.int64), large.astype(np.int64)
    return -(-percent * (small + large) // (100 + percent)) - (-(-percent * large // 100) - 1) - 1


def spared(small: np.ndarray, large: np.ndarray, parts: int, percent: int = THRESHOLD_PERCENT) -> np.ndarray:
    """Tokens shared in one of ``parts`` that need no row: over all parts they are at most half of those that are asked for."""
    return np.maximum(asked_tokens(small, large, percent), 0) // (2 * parts)


def _one_each(t: np.ndarray, g: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries by token and group, one for each, with the smallest and the largest set that has the token."""
    order = np.lexsort((g, t))
    t, g, small, large = (x[order] for x in (t, g, small, large))
    row = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])]))
    return t[row], g[row], np.minimum.reduceat(small, row), np.maximum.reduceat(large, row)


def _meetings(group: np.ndarray, small: np.ndarray, large: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int = THRESHOLD_PERCENT) -> tuple:
    """(a, b, smallest, largest fitting size, 1) of the entries i and j that share a token and have sizes that can link."""
    small_i, small_j, large_i, large_j = (x.astype(np.int64) for x in (small[i], small[j], large[i], large[j]))
    keep = (large_i * 100 >= small_j * percent) & (large_j * 100 >= small_i * percent)
    # the sets of the one that have a size the other can link with
    low = np.maximum(np.minimum(small_i, small_j), -(-np.maximum(small_i, small_j) * percent // 100))
    high = np.minimum(np.maximum(large_i, large_j), np.minimum(large_i, large_j) * 100 // percent)
    return group[i][keep], group[j][keep], low[keep].astype(np.int32), high[keep].astype(np.int32), np.ones(int(keep.sum()), dtype=np.int64)


def _summed(found: list[tuple]) -> tuple:
    """Meetings of many tokens, one for each pair of groups."""
    a, b, small, large, shared = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((b, a))
    a, b, small, large, shared = (x[order] for x in (a, b, small, large, shared))
    if not len(a):
        return a, b, small, large, shared
    head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[head], b[head], np.minimum.reduceat(small, head), np.maximum.reduceat(large, head), np.add.reduceat(shared, head)


def _pairs(rows: tuple) -> pa.RecordBatch:
    a, b, small, large, shared = rows
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, shared, small, large)], names=["a", "b", "shared", "small", "large"])


#: How a group stands in what is opened: opened for all others, one of a crowd, asking only.
OPENED, CROWD, ASKING = 0, 1, 2


def opened(met: DataFrame, groups: DataFrame, percent: int = THRESHOLD_PERCENT, parts: int | None = None) -> DataFrame:
    """job, g, kind: the groups g that are compared because of the matrix's rows ``met``, by the largest group of each pair or crowd.

    ``parts``: of the matrix; None if it left nothing out.
    """
    pairs = met.where("shared > 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("small").alias("small"), F.max("large").alias("large"))
    # overlap <= shared + what lies behind the shorter-reaching prefix; least for the smallest and the largest set
    total = F.col("small") + F.col("large")
    asked = F.ceil(total * percent / (100.0 + percent)) - (F.ceil(F.col("large") * percent / 100.0) - 1) - 1
    if parts is not None:  # the least of r - parts * (r // (2 * parts)) for any r from ``asked`` on
        asked = F.least(asked, F.greatest(F.lit(parts), F.ceil(asked / 2)))
    pairs = pairs.where(F.col("shared") >= asked).select("a", "b")
    sizes = small_side(stage(groups.groupBy("g").agg(F.count("*").alias("k")), "jaccard-sizes"), BROADCAST_ROWS)
    of = lambda rows, side: rows.join(sizes.select(F.col("g").alias(side), F.struct("k", "g").alias(f"of_{side}")), side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", F.struct(F.lit(1).cast("long").alias("k"), F.col(side).alias("g"))))
    sized = of(of(pairs, "a"), "b").select(F.greatest("of_a", "of_b").getField("g").alias("job"), F.least("of_a", "of_b").getField("g").alias("g"))
    sized = sized.select("job", F.explode(F.array(F.struct(F.col("job").alias("g"), F.lit(OPENED).alias("kind")), F.struct("g", F.lit(ASKING).alias("kind")))).alias("x")).select("job", "x.*")
    crowds = met.where("shared = 0").select(F.col("a").alias("token"), F.col("b").alias("g"))
    named = of(crowds, "g").groupBy("token").agg(F.max("of_g").getField("g").alias("job"))
    crowds = crowds.join(small_side(stage(named, "jaccard-crowds"), BROADCAST_ROWS), "token").select("job", "g", F.lit(CROWD).alias("kind"))
    return sized.unionByName(crowds).groupBy("job", "g").agg(F.min("kind").alias("kind"))


def candidates(members: DataFrame, nearest: bool, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """job, u, v, more: pairs of different groups within a job whose signatures allow a link. ``members``: job, id, g, kind, n, signature (staged).

    With ``nearest`` a block pair gives, of the pairs of one set with one group, that of the nearest members only, and ``more`` says that it held others.
    """
    k, w = F.count("*"), F.sum("n")
    wide = F.greatest(F.ceil(k / BLOCK_SETS), F.ceil(w / BLOCK_TOKENS), F.least(F.lit(SPREAD), F.ceil(k / SPREAD_SETS))).cast("int")
    slots = small_side(stage(members.groupBy("job").agg(wide.alias("slots")), "jaccard-slots"), BROADCAST_ROWS)
    dealt = members.join(slots, "job").withColumn("slot", F.pmod(F.xxhash64("id", "job"), "slots").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).withColumn("lo", F.least("slot", "other")).withColumn("hi", F.greatest("slot", "other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (job, lo, hi), columns in keyed(batches, 3):
            ids, g, kind, n, slot, marks = _by_size(list(columns), 3, 5)

            def meets(i: int, js: np.ndarray) -> np.ndarray:
                apart = (g[js] != g[i]) & (ids[js] != ids[i])
                if lo != hi:
                    apart &= slot[js] != slot[i]
                if kind[i] != OPENED:
                    apart &= (kind[js] == OPENED) | (kind[js] == CROWD) & (kind[i] == CROWD)
                return apart

            a, b, differ = near(n, marks, percent, meets)
            had = len(a)
            if nearest:
                a, b, differ = _nearest(a, b, g[b], differ)
                b, a, differ = _nearest(b, a, g[a], differ)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), job)), pa.array(ids[a]), pa.array(ids[b]), pa.array(np.full(len(a), had > len(a)))], names=["job", "u", "v", "more"])

    dealt = dealt.select("job", "lo", "hi", "id", "g", "kind", "n", "slot", "signature")
    return dealt.repartition("job", "lo", "hi").sortWithinPartitions("job", "lo", "hi").mapInArrow(tidied(run), "job long, u long, v long, more boolean")


def _nearest(one: np.ndarray, other: np.ndarray, group: np.ndarray, differ: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (one, other) the one that differs least for each ``one`` and ``group`` of the other."""
    order = np.lexsort((differ, group, one))
    x, y = one[order], group[order]
    if len(order):
        order = order[np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])]
    return one[order], other[order], differ[order]


def linked_components(docs: DataFrame, width: int = WIDTH, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    table = stage(profile(docs, width), "jaccard-profile")
    rows = table.where("n is not null").select("doc_id", "n", "f1", "f2")
    total = rows.agg(F.sum("n").alias("s")).first()["s"] or 0
    real = table.where("n > 0 and doc_id is not null")
    key = ["n", "f1", "f2"]
    named = real.groupBy(*key).agg(F.min("doc_id").alias("id"), F.first("mins").alias("mins"), F.first("signature").alias("signature"))
    named = stage(named, "jaccard-classes")

    # groups: blocks of classes that share a minimum hash; of keys with the same classes one is enough
    mins = named.select("id", "n", F.posexplode("mins").alias("j", "low"))
    slots = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    keys = mins.groupBy("j", "low").agg(F.count("*").alias("k"), slots.alias("slots"), F.bit_xor(F.xxhash64("id")).alias("same")).where("k > 1")
    keys = keys.groupBy("k", "same").agg(F.min(F.struct("j", "low", "slots")).alias("x")).select("x.*")
    members = stage(mins.join(keys, ["j", "low"]).withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int")).select("j", "low", "slot", "slots", "id", "n"), "jaccard-members")
    found = stage(block_stars(members.join(named.select("id", "n", "signature"), ["id", "n"]), percent), "jaccard-stars")
    hubs = found.where("hub is not null").groupBy("j", "low").agg(F.max_by("hub", F.struct("degree", "hub")).alias("v"))
    spokes = members.where("slots > 1").join(hubs, ["j", "low"]).where("id != v").select(F.col("id").alias("u"), "v")
    pairs = stage(found.where("u is not null").select("u", "v").unionByName(spokes).distinct(), "jaccard-pairs")
    links = stage(verified(pairs, docs, width, percent), "jaccard-links")
    groups = stage(components(links, "jaccard-groups").select(F.col("node").alias("id"), F.col("component").alias("g")), "jaccard-groups")

    # the matrix, and the groups that its bound lets through
    copies = real.select("doc_id", *key).join(named.select(*key, "id"), key).groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("doc_id") == F.col("id")).alias("first"))
    status = stage(copies.join(groups, "id", "left").where("not first or g is not null"), "jaccard-status")
    met = stage(matrix(docs, status, frequent_bitmap(table.where("slice is not null"), total), total, width, percent), "jaccard-met")
    jobs = stage(opened(met, groups, percent, part_count(docs, total)), "jaccard-jobs")
    release(met, found, members)

    # members of what is opened, by their signatures and then by their sets
    alone = jobs.join(groups.select("g").distinct(), "g", "left_anti").withColumn("id", F.col("g"))
    members = jobs.join(groups, "g").select("job", "g", "kind", "id").unionByName(alone.select("job", "g", "kind", "id"))
    members = stage(members.join(named.select("id", "n", "signature"), "id"), "jaccard-opened")
    close = stage(candidates(members, True, percent), "jaccard-close")
    links = [links, stage(verified(stage(close.select("u", "v").distinct(), "jaccard-pairs"), docs, width, percent), "jaccard-links")]
    label = stage(components(_merged(*links), "jaccard-joined"), "jaccard-labels")
    of = lambda side: label.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    apart = close.where("more").join(of("u"), "u", "left").join(of("v"), "v", "left").where("coalesce(of_u, u) != coalesce(of_v, v)").select("job").distinct()
    apart = stage(apart, "jaccard-apart")
    if not apart.isEmpty():
        left = members.join(apart, "job", "left_semi").join(label.withColumnRenamed("node", "id"), "id", "left")
        left = stage(left.select("job", "id", F.coalesce("component", "g").alias("g"), "kind", "n", "signature"), "jaccard-opened")
        pairs = stage(candidates(left, False, percent).select("u", "v").distinct(), "jaccard-pairs")
        links.append(stage(verified(pairs, docs, width, percent), "jaccard-links"))
        label = stage(components(_merged(*links), "jaccard-joined"), "jaccard-labels")
    release(close, members, jobs)

    by_class = named.join(label, named["id"] == label["node"], "left").select(*key, F.coalesce("component", "id").alias("component"))
    out = rows.join(by_class, key, "left")
    # documents without shingles are alone; a document named twice has the smallest of its components
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _merged(*edges: DataFrame) -> DataFrame:
    out = edges[0].select("u", "v")
    for e in edges[1:]:
        out = out.unionByName(e.select("u", "v"))
    return out


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``docs`` with one row of each component, of the document with the smallest doc_id; every column is kept as it is."""
    found = stage(linked_components(docs, width, percent), "jaccard-components")
    lost = stage(found.where("component_id != doc_id").select("doc_id").distinct(), "jaccard-lost")
    kept = docs.join(small_side(lost, BROADCAST_ROWS), "doc_id", "left_anti").select(*docs.columns)
    twice = stage(found.where("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id"), "jaccard-twice")
    if twice.isEmpty():
        return kept
    twice = small_side(twice, BROADCAST_ROWS)
    one = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(c) for c in docs.columns]), F.struct(F.coalesce(F.col("text"), F.lit("")))).alias("x"))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select("x.*"))
