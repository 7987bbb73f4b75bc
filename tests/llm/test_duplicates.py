"""Exact copies, near copies, repeated lines, shards and benchmark passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recollect.llm import components, decontaminate, exact_dedup, line_dedup, ngram_join, sharding

SCHEMA = "doc_id long, text string"


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, rows):
    """Rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], SCHEMA + ", n int, `row` string, k int")


# --- exact copies


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 5000, bytes(range(256)) * 40])
def test_fingerprints_compose(data):
    f = exact_dedup.Fingerprinter(2147483647, 1000003, 64)
    plain = 0
    for b in data:
        plain = (plain * 1000003 + b) % 2147483647
    assert f(data) == plain
    for cut in (0, len(data) // 3, len(data)):
        assert f.combine(f(data[:cut]), f(data[cut:]), len(data) - cut) == plain


@pytest.mark.parametrize("text", ["", " ", "\t\n", " a  b ", "a  b", "x\r\ny", "\x0b\x0cq", "a" * 9000 + "  b"])
def test_normalise(text):
    assert exact_dedup.normalise(text) == re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()


EXACT = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, "a b"), (5, "a b"), (6, "z" * 100_000), (7, "z" * 99_999 + "y"), (None, "a b"), (8, " "), (9, "\t"), (6, "z" * 100_000)]


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min(i for i in ids if i is not None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return Counter(out), len(groups)


@pytest.mark.parametrize("hashes", [exact_dedup.HASHES, ((2, 1), (3, 1))], ids=["production", "colliding"])
def test_exact_groups(spark, hashes):
    rows = EXACT + [(i, f"t{i % 4}") for i in range(20, 40)]
    out = exact_dedup.exact_groups(frame(spark, rows), hashes, 1000).collect()
    want, n = brute_exact(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
    kept = [r.doc_id for r in out if r.kept]
    assert len(kept) == n and all(r.doc_id == r.keep_id for r in out if r.kept)


def test_drop_copies(spark):
    out = exact_dedup.drop_copies(frame(spark, [*EXACT, (1, "other")]))
    assert out.columns == ["doc_id", "text", "n", "row", "k"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter([(1, "a  b"), (3, None), (6, "z" * 100_000), (7, "z" * 99_999 + "y"), (8, " "), (1, "other")])
    assert exact_dedup.drop_copies(frame(spark, []).limit(0)).count() == 0


# --- near copies


def brute_sets(rows):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        s = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        out.setdefault(i, []).append(s)
    return out


def brute_components(sets):
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 75 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_rows():
    rng = random.Random(3)
    rows, at = [], 0
    passage = words(rng, 60)
    base = words(rng, 150)
    for _ in range(160):  # a family whose members differ by a few words each, around one original
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((at, " ".join(w)))
        at += 1
    for _ in range(60):  # different texts that share a passage
        rows.append((at, " ".join(words(rng, rng.randrange(5, 60)) + passage + words(rng, rng.randrange(5, 60)))))
        at += 1
    for n in (4, 5, 6, 8, 9, 20, 40):  # small families, sizes near the threshold
        w = words(rng, n)
        for cut in (0, 1, 2, 0):
            rows.append((at, " ".join(w[cut:])))
            at += 1
    rows += [(at, None), (at + 1, ""), (at + 2, " \t\n"), (at + 3, "One two THREE"), (at + 4, "one\ttwo three"), (at + 5, "a b c d e"), (at + 6, "A B C D E"), (at + 7, "é É x y z"), (at + 8, "long " * 30000)]
    rows += rows[3:6]  # repeated rows
    rng.shuffle(rows)
    return rows


def test_jaccard_join(spark, monkeypatch):
    rows = near_rows()
    want = brute_components(brute_sets(rows))
    sizes = brute_sets(rows)
    # null ids link nothing; blocks of a few sets make groups meet across blocks
    for limits in ((128, 1 << 16), (8, 1500)):
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", limits[0])
        monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", limits[1])
        out = ngram_join.linked_components(frame(spark, [*rows, (None, rows[0][1])])).collect()
        assert len(out) == len(rows) + 1
        for r in out:
            if r.doc_id is None:
                assert r.component_id is None
            else:
                assert r.component_id == want[r.doc_id], r.doc_id
                assert r.n_shingles == len(sizes[r.doc_id][0])


def test_jaccard_without_broadcast_or_groups(spark, monkeypatch):
    """No minimum hashes: every link has to come from the matrix."""
    monkeypatch.setattr(ngram_join, "MIN_HASHES", 0)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ngram_join, "PAIRED_GROUPS", 5)
    rows = [r for r in near_rows() if r[0] < 40 or r[0] >= 160]
    want = brute_components(brute_sets(rows))
    out = ngram_join.linked_components(frame(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == want


def test_one_of_each(spark):
    rows = [(2, "a b c d e f"), (1, "a b c d e f"), (3, "q r s t u"), (4, None)]
    out = ngram_join.one_of_each(frame(spark, rows))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4] and out.columns == ["doc_id", "text", "n", "row", "k"]
    assert ngram_join.linked_components(frame(spark, rows).limit(0)).count() == 0


def test_hasher_is_the_same_for_blocks(monkeypatch):
    text = "Alpha  beta\tgamma delta epsilon zeta eta theta iota kappa " * 50
    whole = ngram_join.ShingleHasher().sets([text, "x", text.upper()])
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    parts = ngram_join.ShingleHasher().sets([text, "x", text.upper()])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True)) and np.array_equal(whole[0], whole[2])


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(root[n] == c for n, c in got.items()) and set(got) == {n for a, b in edges if a != b for n in (a, b)}


# --- repeated lines


def brute_lines(rows, full=50):
    docs, seen = {}, {}
    for i, t in rows:
        if i is not None and t is not None:
            docs.setdefault(i, t)
    runs = []
    for i in sorted(docs):
        lines = [(p, re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", x)) for p, x in enumerate(docs[i].split("\n"))]
        lines = [(p, x, len(re.split(r"[ \t-\r]+", x))) for p, x in lines if x]
        for a in range(len(lines)):
            n, run = 0, []
            for p, x, w in lines[a:]:
                n += w
                run.append(x)
                if n >= full:
                    runs.append((i, lines[a][0], p, tuple(run)))
                    break
    gone = {}
    for i, a, b, run in runs:
        if run in seen:
            gone.setdefault(i, set()).update(range(a, b + 1))
        else:
            seen[run] = i
    return gone


def line_rows():
    rng = random.Random(9)
    long = " ".join(words(rng, 55))
    block = [" ".join(words(rng, 9)) for _ in range(8)]
    short = " ".join(words(rng, 20))
    rows = []
    for i in range(30):
        lines = [" ".join(words(rng, rng.randrange(1, 20))) for _ in range(rng.randrange(1, 10))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), long)
        if i % 4 == 0:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = block[rng.randrange(2) :]
        if i % 5 == 0:
            lines += [short, "", "  "]
        rows.append((i, "\n".join(lines)))
    rows += [(30, "\n".join(["same line of six words here"] * 30)), (31, None), (32, ""), (33, rows[0][1]), (33, rows[0][1]), (34, "  " + long + "\t"), (35, "\n\n\n")]
    return rows


def test_line_dedup(spark):
    rows = line_rows()
    out = {r.doc_id: r for r in line_dedup.report(frame(spark, [*rows, (None, rows[0][1])])).collect()}
    want = brute_lines(rows)
    got = {i: {p for part in r.removed.split(",") for p in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)} for i, r in out.items()}
    # ranges reach from line to line; blank lines between are part of them
    assert set(got) == set(want)
    assert all(got[i] == {p for p in range(min(want[i]), max(want[i]) + 1) if p in got[i]} and want[i] <= got[i] for i in want)
    text = {r.doc_id: r.text for r in line_dedup.without_repeats(frame(spark, rows)).collect()}
    for i, t in dict(rows).items():
        if t is not None:
            assert text[i] == "\n".join(x for p, x in enumerate(t.split("\n")) if p not in got.get(i, ()))
    assert text[31] is None
    assert line_dedup.report(frame(spark, rows).limit(0)).count() == 0


# --- shards


def brute_shards(rows, limit):
    bits = [(f"{int(hashlib.md5(('' if i is None else str(i)).encode()).hexdigest()[:15], 16):060b}", i, len((t or "").encode())) for i, t in rows]
    out = {}

    def split(part, depth):
        size = sum(b for _, _, b in part)
        if not part:
            return
        if size <= limit or len({x for x, _, _ in part}) == 1:
            for x, i, b in part:
                out.setdefault(x[:depth], []).append((i, b, size > limit))
            return
        for bit in "01":
            split([p for p in part if p[0][depth] == bit], depth + 1)

    split(bits, 0)
    return out


@pytest.mark.parametrize("limit", [50, 400, 3000, 10**9])
def test_shards(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "x" * rng.randrange(0, 80)) for i in range(150)] + [(3, "é" * 600), (200, None), (201, ""), (None, "abc")]
    out = sharding.assign(frame(spark, rows), limit=limit).collect()
    want = brute_shards(rows, limit)
    got = {}
    for r in out:
        got.setdefault(r.shard, []).append((r.doc_id, r.bytes, r.oversized))
        assert r.depth == len(r.shard) and r.shard_docs == len(want[r.shard]) and r.shard_bytes == sum(b for _, b, _ in want[r.shard])
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in want.items()}


def test_no_rows_no_shards(spark, tmp_path):
    assert sharding.assign(frame(spark, []).limit(0)).count() == 0
    docs = frame(spark, [(i, "y" * 50) for i in range(40)])
    sharding.write_shards(docs, str(tmp_path / "s"), limit=500)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 40 and back.groupBy("shard").agg(F.sum(F.length("text")).alias("b")).where("b > 500").count() == 0


# --- benchmark passages


def item_rows():
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate((30, 45, 6, 5, 12, 100))] + [(6, "two words"), (7, None), (8, ""), (9, None)]
    items[9] = (9, items[0][1])
    docs = []
    for i in range(40):
        body = words(rng, rng.randrange(0, 400))
        if i % 4 == 0:
            item = items[rng.randrange(6)][1].split()
            if i % 8 == 0:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = item
        docs.append((i, " ".join(body)))
    docs += [(40, "Two  WORDS"), (41, "two words and"), (42, None), (43, ""), (44, " ".join(words(rng, 30000)) + " " + items[1][1].upper()), (44, items[0][1]), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("bound", [200_000, 0], ids=["broadcast", "shuffle"])
def test_contained(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", bound)
    docs, items = item_rows()
    ds, its = {}, brute_sets([(i, (t or "").lower()) for i, t in items])
    for i, t in docs:
        if i is not None:
            ds.setdefault(i, set()).update(*brute_sets([(i, (t or "").lower())])[i])
    want = {(d, i, len(s), len(s & w)) for d, w in ds.items() for i, (s,) in its.items() if s and len(s & w) >= 0.75 * len(s)}
    got = decontaminate.contained(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_item, r.n_common) for r in got} == want and len(got) == len(want)
    assert {44, 40} <= {r.doc_id for r in got}


def test_drop_contaminated(spark):
    docs, items = item_rows()
    out = decontaminate.drop_contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    kept = {r.doc_id for r in out.collect()}
    assert 44 not in kept and 42 in kept and None in kept and out.columns == ["doc_id", "text", "n", "row", "k"]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame(spark, docs), empty).count() == len(docs)


def test_matrix_leaves_out_what_cannot_link(spark, tmp_path):
    """Long texts that have one passage in common make no rows; linked ones stay linked, and so does what lies at the threshold."""
    from recollect.llm import ngram_join

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        passage = " ".join(f"p{i}" for i in range(20))
        own = lambda d, n: " ".join(f"d{d}w{i}" for i in range(n))
        texts = [f"{own(d, 600)} {passage}" for d in range(12)]
        texts += [f"{own(50, 600)} {own(51, 98)}", f"{own(50, 600)} {own(52, 98)}", f"{own(60, 600)} {own(61, 104)}", f"{own(60, 600)} {own(62, 104)}"]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        status = spark.createDataFrame([], "id long, first boolean, g long")
        total = sum(len(t.split()) - 4 for t in texts)
        rows = ngram_join.matrix(docs, status, bytes((1 << ngram_join.SKETCH_BITS) // 8), total).collect()
        assert {(r["a"], r["b"]) for r in rows} >= {(12, 13)} and not [r for r in rows if r["b"] < 12]
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.linked_components(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    for a, b in ((12, 13), (14, 15)):
        assert (got[b] == a) == (100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    assert got[13] == 12 and all(got[d] == d for d in range(12))
