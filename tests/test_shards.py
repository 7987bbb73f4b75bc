"""Search of the document index in shards: phrases by a tree, scores and ties against plain sums, no pairs of query and chunk in a shuffle."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from recollect.operators import docindex, shards


def test_phrases_against_brute_force():
    """Every window of every length, with units that begin alike and repeat a term."""
    rng = random.Random(3)
    units = [["a", "b"], ["a", "b", "c"], ["a", "a"], ["c", "a", "b"], ["b"], ["d", "a", "d"]]
    known = shards.Units(units)
    texts = [[rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(60)]
    placed = [((i << 32) + p, known.terms[t]) for i, text in enumerate(texts) for p, t in enumerate(text) if t in known.terms and known.in_phrase[known.terms[t]]]
    code, term = (np.array(x, dtype=np.int64) for x in zip(*placed, strict=True))
    number, end = known.phrases(code, term)
    got = sorted(zip(number.tolist(), (code[end] >> 32).tolist(), strict=True))
    assert got == sorted((u, i) for i, text in enumerate(texts) for u, unit in enumerate(units) if len(unit) > 1 for p in range(len(text)) if text[p : p + len(unit)] == unit)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    own = docindex.LexicalIndex(spark, str(tmp_path_factory.mktemp("index") / "i"))
    files = [(f"r{i % 3}/f{i}.md", f"r{i % 3}", "alpha beta " * (1 + i % 4) + ("gamma delta" if i % 5 == 0 else "delta gamma") + f" word{i}", f"s{i}") for i in range(40)]
    own.replace(spark.createDataFrame([(p, r, "old gamma_delta text", s) for p, r, _, s in files[:9]], "path string, root string, content string, sha string"))
    own.replace(spark.createDataFrame(files, "path string, root string, content string, sha string"))
    return own


@pytest.mark.parametrize("root,size", [(None, 1 << 20), ("r1", 1 << 20), (None, 64)])
def test_search_against_plain_sums(spark, index, monkeypatch, root, size):
    """Replaced versions do not count, ties go by path, the number of shards and of blocks changes nothing."""
    monkeypatch.setattr(shards, "SHARD_TOKENS", size)
    monkeypatch.setattr(docindex, "QUERY_BLOCK", 1 << 14 if size > 64 else 2)
    asked = {"q1": "alpha gamma_delta", "q2": "Word7 old", "q3": "beta beta ALPHA", "q4": "_", "q5": "gamma_delta gamma__delta"}
    chunks = {r["path"]: [t for c in (r["path"], r["heading"], r["content"]) for t in [*re.findall(r"[^\W_]+", c.lower()), "|"]] for r in index._read("chunks", docindex.CHUNKS).join(index.files(), ["path", "version"]).collect()}
    avgdl = sum(len(t) - 3 for t in chunks.values()) / len(chunks)
    want = []
    for q, text in asked.items():
        scores = {}
        for unit in dict.fromkeys(re.findall(r"\w+", text.lower())):
            parts = re.findall(r"[^\W_]+", unit)
            f = {p: n for p, t in chunks.items() if parts and (n := sum(t[i : i + len(parts)] == parts for i in range(len(t))))}
            idf = math.log((len(chunks) - len(f) + 0.5) / (len(f) + 0.5))
            for p, n in f.items():
                scores[p] = scores.get(p, 0) + (idf if idf > 0 else 1e-6) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * (len(chunks[p]) - 3) / avgdl))
        ranked = sorted((round(-s, 6), p) for p, s in scores.items() if root in (None, p.split("/")[0]))[:3]
        want += [(q, p, s, i) for i, (s, p) in enumerate(ranked, 1)]
    queries = spark.createDataFrame(list(asked.items()), "query_id string, query string")
    assert sorted((r["query_id"], r["path"], r["score"], r["rank"]) for r in index.search(queries, 3, root).collect()) == sorted(want)


def test_no_pairs_of_query_and_chunk_are_shuffled(spark, index):
    queries = spark.createDataFrame([(i, "alpha beta gamma") for i in range(30)], "query_id long, query string")
    found = index.search(queries, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*chunk_id", plan)
    assert found.count() == 60


def test_postings_of_a_chunk(spark):
    rows = spark.createDataFrame([(1, "p", 5, 7, ["a", "b", "a"], [], ["a"]), (2, "q", 1, 7, [], ["c"], [])], "chunk_id long, path string, dl int, version long, t0 array<string>, t1 array<string>, t2 array<string>")
    got = sorted((r["term"], r["chunk_id"], r["places"]) for r in shards.posted(rows, 10).collect())
    assert got == [("a", 1, [0, 2, 23]), ("b", 1, [1]), ("c", 2, [10])]
    assert list(itertools.chain(*(r["places"] for r in shards.posted(rows.limit(0), 10).collect()))) == []
