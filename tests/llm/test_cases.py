"""Defined cases of the operators: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names; and paths that sizes choose."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_duplicates import brute_components, brute_sets, frame, item_rows, near_rows, words  # noqa: E402

from recollect.llm import components, decontaminate, exact_dedup, line_dedup, ngram_join, sharding, signatures  # noqa: E402


# --- signatures, components, the join


def test_signatures_bound_differences():
    rng = np.random.default_rng(1)
    for n in (1, 5, 60, 300, 2000, 9000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for share in (0.5, 0.8, 0.95, 1.0):
            kept = a[rng.random(len(a)) < share]
            b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(n * (1 - share)) + 1, dtype=np.uint64)]))
            differ = len(np.setxor1d(a, b))
            sets = sorted([a, b], key=len)
            sizes = np.array([len(s) for s in sets])
            i, j, bits = signatures.near(sizes, [signatures.signature(s) for s in sets], 75, lambda i, js: slice(None))
            assert not len(bits) or bits[0] <= differ
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 75 * (len(a) + len(b) - shared):
                assert len(bits) == 1


@pytest.mark.parametrize("least", [components.TASK_EDGES, 0], ids=["one task", "rounds"])
def test_components_on_both_paths(spark, monkeypatch, least):
    monkeypatch.setattr(components, "TASK_EDGES", least)
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0 if not least else 200_000)
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)] + [(1000, i) for i in range(1001, 1060)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_crowds_and_the_second_turn(spark, monkeypatch):
    """Members of different groups that are near but not the nearest still link, in crowds cut into many blocks."""
    monkeypatch.setattr(ngram_join, "MIN_HASHES", 1)
    for name, value in (("PAIRED_GROUPS", 2), ("BLOCK_SETS", 16), ("SPREAD_SETS", 4), ("BROADCAST_ROWS", 0), ("SALT_ROWS", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(9)
    base, rows = words(rng, 80), []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(80)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = brute_components(brute_sets(rows))
    got = {r.doc_id: r.component_id for r in ngram_join.linked_components(frame(spark, rows)).collect()}
    assert got == want and len(set(want.values())) > 3


def test_one_of_each_repeated_ids(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (2, text), (3, "q r s t u v"), (3, "something else entirely here now"), (None, text), (None, text), (4, None), (4, None), (5, "")]
    out = ngram_join.one_of_each(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "n", "row", "k"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter([(1, text), (3, "q r s t u v"), (None, text), (None, text), (4, None), (5, "")])
    assert ngram_join.one_of_each(frame(spark, rows).limit(0)).count() == 0


# --- line dedup


def passage(rng, n=6):
    return [" ".join(words(rng, 12)) for _ in range(n)]


def test_two_texts_under_one_id(spark):
    rng = random.Random(5)
    shared = passage(rng)
    rows = [(1, "\n".join(passage(rng, 2) + shared)), (2, "\n".join(shared + passage(rng, 3))), (2, "\n".join(passage(rng, 4))), (3, None), (4, ""), (None, "\n".join(shared)), (1, None)]
    rows.append(rows[1])  # a repeated row is one document
    out = line_dedup.report(frame(spark, rows)).collect()
    assert [(r.doc_id, r.removed, r.sources) for r in out] == [(2, "0-5", [1])]
    kept = line_dedup.without_repeats(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "n", "row", "k"]
    assert Counter((r.doc_id, r.text) for r in kept.collect())[2, rows[2][1]] == 1
    assert line_dedup.report(frame(spark, rows).limit(0)).count() == 0


def test_common_run_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    rng = random.Random(6)
    shared = passage(rng)
    rows = [(i, "\n".join(passage(rng, 1) + shared)) for i in range(30)]
    out = {r.doc_id: (r.removed, r.sources) for r in line_dedup.report(frame(spark, rows)).collect()}
    assert out == {i: ("1-6", [0]) for i in range(1, 30)}


# --- exact copies


@pytest.mark.parametrize("bound", [200_000, 0], ids=["broadcast", "shuffle"])
def test_long_texts_in_blocks(spark, monkeypatch, bound):
    for name, value in (("BLOCK", 64), ("BLOCK_CHUNKS", 2), ("BROADCAST_ROWS", bound)):
        monkeypatch.setattr(exact_dedup, name, value)
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab \t\n\x0b") for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    for t in texts:
        assert exact_dedup.normalise(t) == re.sub(r"[\x20\x09-\x0D]+", " ", t).encode()
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t.replace("\t", "\n")) for i, t in enumerate(texts)] + [(None, texts[0])]
    out = exact_dedup.exact_groups(frame(spark, rows)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(exact_dedup.normalise(t), []).append(i)
    want = Counter((i, min(x for x in ids if x is not None), len(ids)) for ids in groups.values() for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out) == want and sum(r.kept for r in out) == len(groups)


# --- shards


def test_written_shards_keep_the_tables_columns(spark, tmp_path):
    rows = [(i, "y" * 50 if i else None, "mine", "theirs", "b") for i in range(40)] + [(None, "z", "mine", "theirs", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, __bits string, bits string")
    folder = sharding.write_shards(docs, str(tmp_path / "s"), limit=500)
    assert folder == "shard_"
    back = spark.read.parquet(str(tmp_path / "s"))
    assert set(back.columns) == {"doc_id", "text", "shard", "__bits", "bits", "shard_"}
    assert sorted(back.select(*docs.columns).collect(), key=repr) == sorted(docs.collect(), key=repr)
    assert back.groupBy(folder).agg(F.sum(F.length("text")).alias("b")).where("b > 500").count() == 0
    want = {(r.doc_id, r.shard) for r in sharding.assign(docs, limit=500).collect()}
    assert {(r.doc_id, r[folder].removeprefix("bits")) for r in back.collect()} == want
    sharding.write_shards(docs.limit(0), str(tmp_path / "none"))
    assert spark.read.schema(docs.schema).parquet(str(tmp_path / "none")).count() == 0


# --- decontamination


def test_result_comes_through_the_sketches(spark, monkeypatch):
    docs, items = item_rows()
    d, i = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contained(d, i).collect()}
    near = {(r.doc_id, r.item_id) for r in decontaminate.candidates(d, decontaminate.item_sketches(i)).collect()}
    assert found and found <= near
    plain = decontaminate.item_sketches
    monkeypatch.setattr(decontaminate, "item_sketches", lambda *a, **k: plain(*a, **k).withColumn("in_sketch", F.lit(False)))
    assert decontaminate.contained(d, i).count() == 0


def test_items_that_are_too_large_to_broadcast(spark, monkeypatch):
    docs, items = item_rows()
    d, i = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    want = {tuple(r) for r in decontaminate.contained(d, i).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    assert {tuple(r) for r in decontaminate.contained(d, i).collect()} == want
    assert decontaminate.contained(d.limit(0), i).count() == 0 and decontaminate.contained(d, i.limit(0)).count() == 0


def test_sketches_miss_nothing_at_the_threshold(spark):
    """Documents that hold just the threshold's share of an item, whichever shingles they miss."""
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([5, 6, 7, 8, 9, 12, 16, 17, 33, 64, 65])]
    docs = []
    for i, t in items:
        w = t.split()
        for k in range(12):
            cut = list(w)
            if len(w) > 8:
                cut[rng.randrange(len(w))] = f"z{k}"
            docs.append((len(docs), " ".join(words(rng, rng.randrange(0, 60)) + cut)))
    ds, its = brute_sets(docs), brute_sets(items)
    want = {(d, i) for d, (w,) in ds.items() for i, (s,) in its.items() if len(s & w) >= 0.75 * len(s)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 60
