"""Maintenance, documents, streams and sources of the store as a whole."""

import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from recollect import conf
from recollect.conf import EngineConf
from recollect.operators import docindex, rank, store
from recollect.plans import catalog
from recollect.plans.engine import MemoryStore
from recollect.sources import readers
from recollect.streaming import jobs

SF = "/root/testdata/sf0.001"


def filled(spark, path, **settings):
    own = MemoryStore(spark, str(path), EngineConf(gate=False, **settings))
    rows = [(1, "alpha beta gamma", "s", 100.0), (2, "alpha beta gamma", "s", 300.0), (3, "quite another thing", "s", 200.0), (4, "alpha beta gamma", "t", 50.0)]
    own.upsert(spark.createDataFrame(rows, "point_id long, text string, session_id string, ts double"))
    return own


def state(own):
    return {r.point_id: (bool(r.archived), r.superseded_by) for r in own.points(True).collect()}


def test_dedup_and_unmerge(spark, tmp_path):
    own = filled(spark, tmp_path / "m")
    with pytest.raises(ValueError):
        own.dedup()
    assert [tuple(r) for r in own.dedup(0.95, allow_unbounded=True).collect()] == [(1, 2, True)]
    assert state(own) == {1: (True, 2), 2: (False, None), 3: (False, None), 4: (False, None)}
    own.unmerge()
    assert state(own) == dict.fromkeys((1, 2, 3, 4), (False, None))
    assert own.dedup(0.95, limit=1).count() == 0


def test_decay_and_unarchive(spark, tmp_path):
    own = filled(spark, tmp_path / "m")
    now = 100.0 + 10 * 86400
    assert own.decay(now, 1.0).first().asDict() == {"considered": 4, "exempt": 0, "no_timestamp": 0, "below": 4}
    assert not any(a for a, _ in state(own).values())
    own.decay(now, 1.0, apply=True)
    assert all(a for a, _ in state(own).values())
    own.unarchive()
    assert not any(a for a, _ in state(own).values())


def test_documents(spark, tmp_path):
    own = filled(spark, tmp_path / "m")
    files = lambda texts: spark.createDataFrame([(p, p.split("/")[0], t) for p, t in texts.items()], "path string, root string, content string").withColumn("sha", F.sha2("content", 256))
    texts = {"a/x.md": "# Guide\n\nstart_here with apples", "a/y.md": "start something, here", "b/z.md": "pears only"}
    assert {(r.path, r.tier, r.status) for r in own.md_ingest(files(texts)).collect()} == {(p, t, "new") for p in texts for t in ("lexical", "semantic")}
    assert own.md_ingest(files(texts)).count() == 0
    texts["b/z.md"] = "plums only"
    assert {(r.path, r.tier, r.status) for r in own.md_ingest(files(texts)).collect()} == {("b/z.md", t, "changed") for t in ("lexical", "semantic")}
    ask = lambda q: spark.createDataFrame([(1, q)], "query_id long, query string")
    found = lambda q, **k: [(r.path, r.tier) for r in sorted(own.md_search(ask(q), **k)[0].collect(), key=lambda r: (r.tier, r.rank))]
    assert found("start_here", mode="off") == [("a/x.md", "lexical")]
    assert found("pears", mode="off") == [] and found("plums", mode="off") == [("b/z.md", "lexical")]
    assert found("plums", mode="off", root="a") == []
    assert ("b/z.md", "lexical") in found("plums only") and len({p for p, _ in found("plums only", mode="always")}) == 3
    assert found("!!!", mode="off") == [] and found("", mode="off") == []
    status = {r.item: r.value for r in own.status().collect()}
    assert status["points"] == "4" and status["document_files"] == "3" and status["gate"] == "False"


def test_index_is_rebuilt(spark, tmp_path):
    index = docindex.LexicalIndex(spark, str(tmp_path / "i"))
    files = lambda texts: spark.createDataFrame([(p, "r", t, t) for p, t in texts.items()], "path string, root string, content string, sha string")
    index.set_meta(spark.createDataFrame([("k", "v")], "k string, v string"))
    index.replace(files({"a": "one", "b": "two"}))
    index.rebuild(files({"c": "three one"}))
    assert {(r.path, r.chunks) for r in index.files().collect()} == {("c", 1)} and index.meta().count() == 1
    asked = spark.createDataFrame([(1, "one two")], "query_id long, query string")
    assert [r.path for r in index.search(asked).collect()] == ["c"]
    assert spark.read.parquet(f"{index.path}/postings").select("path").distinct().count() == 1
    index.drop(spark.createDataFrame([("c",)], "path string"))
    assert index.search(asked).count() == 0 and index.stats().first().asDict() == {"files": 0, "chunks": 0, "avgdl": 0.0}


def test_tiers_that_fail_leave_a_note(spark):
    q = spark.createDataFrame([(1, "x"), (2, "y")], "query_id long, query string")
    hits = spark.createDataFrame([(1, "p", 1), (1, "q", 2)], "query_id long, path string, rank int")

    def broken(asked):
        return asked.select("query_id", F.raise_error(F.lit("down")).alias("path"), F.lit(1).alias("rank"))

    found, notes = docindex.md_search(q, lambda a: hits, broken, "auto")
    assert found.count() == 2 and [(r.query_id, r.note.split(":")[0]) for r in notes.collect()] == [(2, "note")]
    found, notes = docindex.md_search(q, broken, lambda a: hits, "always")
    assert {r.tier for r in found.collect()} == {"semantic"} and notes.count() == 2
    _, notes = docindex.md_search(q, lambda a: hits, None, "always")
    assert {r.note.split(":")[0] for r in notes.collect()} == {"error"}
    with pytest.raises(ValueError):
        docindex.md_search(q, lambda a: hits, None, "sometimes")


def test_search_goes_on_without_its_sparse_arm(spark, tmp_path, monkeypatch):
    own = filled(spark, tmp_path / "m", hybrid=True)
    q = spark.createDataFrame([(1, "alpha beta")], "query_id long, query string")
    both = own.search(q, 3).count()
    monkeypatch.setattr("recollect.operators.lexical.bm25", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert own.search(q, 3).count() == both == 3


def test_call_and_ledger(spark, tmp_path):
    own = filled(spark, tmp_path / "m")
    assert own.call("collect").first().points == 4
    with pytest.raises(ValueError):
        own.call("compact")
    events = spark.createDataFrame([(1, float(i), i, "recall", 0, "t") for i in range(60)], "point_id long, ts double, seq long, event string, delta int, text string")
    own.record(events)
    own.compact_ledger()
    kept = spark.read.parquet(f"{own.path}/ledger")
    assert kept.count() == 50 and kept.agg(F.min("seq")).first()[0] == 10


def test_sparse_backfill(spark):
    points = spark.createDataFrame([(1, "b a b"), (2, "c"), (3, "!!!")], "point_id long, text string")
    done = spark.createDataFrame([(2, [7], [1.0])], "point_id long, indices array<int>, values array<double>")
    got = {r.point_id: (len(r.indices), sorted(r["values"])) for r in store.with_sparse(points, done).collect()}
    assert got == {1: (2, [1.0, 2.0]), 2: (1, [1.0])}


def brute_clusters(rows, threshold):
    """First fit by the definition: in order, each vector joins the first cluster whose mean is near enough."""
    clusters = []
    for point, v in rows:
        for c in clusters:
            mean = np.mean([x for _, x in c], axis=0)
            if v @ mean / np.sqrt((v @ v) * (mean @ mean)) >= threshold:
                c.append((point, v))
                break
        else:
            clusters.append([(point, v)])
    return {p: c[0][0] for c in clusters if len(c) > 1 for p, _ in c}


def test_cluster_first_fit_and_semantic_dedup(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    by_label = {}
    for r in sorted(rows, key=lambda r: r.vec_id):
        by_label.setdefault(r.label, []).append((r.vec_id, np.array(r.embedding, dtype=float)))
    want = {k: v for own in by_label.values() for k, v in brute_clusters(own, 0.35).items()}
    assert {r.point_id: r.cluster for r in catalog.QUERIES["cluster_first_fit"](spark, SF).collect()} == want and want
    want = {k: v for own in by_label.values() for k, v in brute_clusters(own[::-1], 0.35).items() if k != v}
    assert {r.point_id: r.superseded_by for r in catalog.QUERIES["semantic_dedup"](spark, SF).collect()} == want


def test_logs_and_roots(spark, tmp_path):
    for name, text in (("agent.log", "c1\nc2\n"), ("agent.log.1", "b1"), ("agent.log.10", "a1\n"), ("other.txt", "no")):
        (tmp_path / name).write_text(text)
    lines = readers.in_log_order(readers.log_files(spark, str(tmp_path), "agent.log*"))
    assert [r.value for r in sorted(lines.collect(), key=lambda r: r.seq)] == ["a1", "b1", "c1", "c2"]
    for folder in ("one/deep", "one/skipme", "two"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "x.md").write_text("# x")
    found = readers.configured_roots(spark, {"first": str(tmp_path / "one"), "second": str(tmp_path / "two")}, overlay={"first": ("skipme",)})
    assert {r.path for r in found.collect()} == {"first/deep/x.md", "second/x.md"}


def test_pages_are_written(spark, tmp_path):
    pages = spark.createDataFrame([(1, "# a\n\nb"), (2, "c")], "session_id long, markdown string")
    readers.write_pages(pages, str(tmp_path / "p"))
    assert {r.page for r in spark.read.text(str(tmp_path / "p")).select("page").distinct().collect()} == {1, 2}


def test_warnings_come_once():
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert [conf.display_level(v) for v in ("Verbose", "loud-once", "loud-once", None)] == ["verbose", "off", "off", "off"]
    assert len(seen) == 1


def test_listener_notes_what_streams_write(spark):
    told = []
    own = jobs.LastWrite(lambda event, values: told.append(event), "verbose")
    spark.streams.addListener(own)
    try:
        catalog.QUERIES["stream_queries"](spark, SF).count()
        for _ in range(50):
            if "ended" in told:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(own)
    assert {"started", "progress", "ended"} <= set(told)
    assert any(s.get("rows") for s in own.status.values()) and not any(s.get("running") for s in own.status.values())


def test_dense_search_in_blocks(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(80)]
    p = spark.createDataFrame(rows, "point_id long, dense array<double>")
    q = p.withColumnRenamed("point_id", "query_id")
    want = [tuple(r) for r in rank.dense_topk(p, q, 4).orderBy("query_id", "rank").collect()]
    x = np.array([v for _, v in rows])
    s = np.round(x @ x.T / np.sqrt((x * x).sum(1)[:, None] * (x * x).sum(1)[None, :]), 6)
    assert [(a, b) for a, b, _, _ in want] == [(i, j) for i in range(80) for j in sorted(range(80), key=lambda j: (-s[i, j], j))[:4]]
    monkeypatch.setattr(rank, "QUERY_BLOCK", 20)
    assert [tuple(r) for r in rank.dense_topk(p, q, 4).orderBy("query_id", "rank").collect()] == want
    with pytest.raises(Exception, match="different width"):
        rank.dense_topk(p, spark.createDataFrame([(1, [1.0])], "query_id long, dense array<double>"), 2).collect()
    with pytest.raises(Exception, match="different width"):
        spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>").select(rank.cosine(F.col("a"), F.col("b"))).collect()


def test_cascade_hook_that_fails(spark):
    q = spark.createDataFrame([(1,)], "query_id int")
    seen = []

    def hook(name, error):
        seen.append(name)
        raise RuntimeError("the hook itself")

    def wrong(asked):
        raise KeyError("no such level")

    out = rank.cascade(q, [("wrong", wrong), ("right", lambda a: a.withColumn("point_id", F.lit(1)))], hook).collect()
    assert seen == ["wrong"] and (out[0].level, out[0].degraded, out[0].attempted) == ("right", True, "wrong,right") and out[0].reason.startswith("wrong failed: KeyError")


def test_rerank_model(spark):
    class Lengths:
        """A cross-encoder that likes long texts and fails for one query."""

        def rerank(self, query, texts):
            if query == "bad":
                raise RuntimeError("no scores")
            return [len(t) for t in texts]

    rows = spark.createDataFrame([(1, "q", 1, "a"), (1, "q", 2, "abc"), (1, "q", 3, "ab"), (2, "bad", 1, "a"), (2, "bad", 2, "abc")], "query_id int, query string, rank int, text string")
    out = rank.reranked(rows, rank.rerank_udf(Lengths)(F.col("query"), F.col("text"))).collect()
    assert {(r.query_id, r["rank"]): r.text for r in out} == {(1, 1): "abc", (1, 2): "ab", (1, 3): "a", (2, 1): "a", (2, 2): "abc"}


def test_functions_for_sql(spark):
    from recollect.functions.register import register

    assert "recollect_root" in register(spark)
    row = spark.sql("""SELECT recollect_root('a/b') AS r, recollect_contains('One two', 'TWO one') AS c, recollect_contains('x', '!!!') AS n, recollect_decay(10, 5) AS d,
      recollect_trust(1, 0) AS t, recollect_valid_id('12') AS v, recollect_valid_id(NULL) AS w, recollect_jaccard(array('a', 'b'), array('b')) AS j, size(recollect_embed('x')) AS e, recollect_window('no time') AS p""").first()
    assert (row.r, row.c, row.n, row.d, row.t, row.v, row.w, row.j, row.e) == ("a", True, False, 0.25, 0.6667, True, False, 0.5, 64) and row.p.start is None
