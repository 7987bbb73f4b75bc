"""Literal expectations of the pure functions and small frames."""

import uuid
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recollect.functions import entities, gate, temporal
from recollect.functions import text as T
from recollect.operators import filters, rank, store
from recollect.sources import readers
from recollect.streaming import jobs

NOW = datetime(2026, 10, 19, 14, 30, tzinfo=UTC)


def ts(*a):
    return datetime(*a, tzinfo=UTC).timestamp()


@pytest.mark.parametrize(
    "query,window",
    [
        ("today", (ts(2026, 10, 19), ts(2026, 10, 20))),
        ("what happened yesterday?", (ts(2026, 10, 18), ts(2026, 10, 19))),
        ("this week", (ts(2026, 10, 19), ts(2026, 10, 26))),
        ("next month", (ts(2026, 11, 1), ts(2026, 12, 1))),
        ("last year", (ts(2025, 1, 1), ts(2026, 1, 1))),
        ("5 days ago", (ts(2026, 10, 14, 14, 30), ts(2026, 10, 19, 14, 30))),
        ("past 2 weeks", (ts(2026, 10, 5, 14, 30), ts(2026, 10, 19, 14, 30))),
        ("next 2 months", (ts(2026, 10, 19, 14, 30), ts(2026, 12, 19, 14, 30))),
        ("2023-05-01", (ts(2023, 5, 1), ts(2023, 5, 2))),
        ("2023-05", (ts(2023, 5, 1), ts(2023, 6, 1))),
        ("March of 2023", (ts(2023, 3, 1), ts(2023, 4, 1))),
        ("during march", (ts(2026, 3, 1), ts(2026, 4, 1))),
        ("in december", (ts(2025, 12, 1), ts(2026, 1, 1))),
        ("next spring", (ts(2027, 3, 1), ts(2027, 6, 1))),
        ("before 2023-05-01", (None, ts(2023, 5, 1))),
        ("after June 2024", (ts(2024, 6, 1), None)),
        ("after the migration, in 2023", (ts(2023, 1, 1), None)),
        ("until today", (None, ts(2026, 10, 19))),
        ("2023-13-45", (ts(2023, 1, 1), ts(2024, 1, 1))),
        ("march through the code", None),
        ("from the 3 layers", None),
        ("last weekend", None),
        ("version 2023", None),
        ("", None),
        (None, None),
    ],
)
def test_windows(query, window):
    assert temporal.parse_window(query, NOW) == window


def test_month_shift_clamps():
    assert temporal.parse_window("1 month ago", datetime(2026, 3, 31, tzinfo=UTC))[0] == ts(2026, 2, 28)


@pytest.mark.parametrize(
    "text,found",
    [
        ("The New York Times wrote", ["New York Times"]),
        ("see entities.py and my_function", ["entities.py", "my_function"]),
        ("HTTPServer and BM25", ["HTTPServer", "BM25"]),
        ("e.g. nothing here", []),
        ('a "quoted term" stays', ["quoted term"]),
        ("plain words only", []),
        ("Alice Smith joined the team", ["Alice Smith"]),
        ("I saw The Rock at the cinema", ["The Rock"]),
        ("The cat sat on the mat.", []),
        ("I and A", []),
        ("install some-plugin-name today", ["some-plugin-name"]),
        ("the API and BM25", ["API", "BM25"]),
        ("run `do_recall` now", ["do_recall"]),
        ('"' + "word " * 40 + '"', []),
        ('he said "Stop. Now" loudly', ["Stop. Now"]),
        ("Alice met ALICE", ["Alice"]),
        ("Alice Smith saw Alice", ["Alice Smith", "Alice"]),
        ("MemoryProvider and Memory Provider", ["MemoryProvider"]),
        ("Done. The\tBig  Apple is it", ["Done", "Big Apple"]),
        ("   ", []),
        ("", []),
        (None, []),
    ],
)
def test_entities(spark, text, found):
    assert spark.createDataFrame([(text,)], "t string").select(entities.mentions(F.col("t"))).first()[0] == found


def test_overlap(spark):
    cases = [
        (["New York City"], "we saw New York", 1.0),
        (["entityOverlap", "Paris"], "entity overlap is here", 0.5),
        ([], "x", 0.0),
        (None, "x", 0.0),
        (["Alice"], None, 0.0),
        (["Alice", "Bob"], "alice went home", 0.5),
        (["Alice", "ALICE"], "Alice", 1.0),
        (["New York"], "New York City", 1.0),
        (["MemoryStoreProvider"], "the Memory Store Provider class", 1.0),
        (["ok"], "the token was accepted", 0.0),
        (["hi"], "this is history", 0.0),
        (["a\\E.b"], "see a\\E.b here", 1.0),
    ]
    rows = spark.createDataFrame(cases, "w array<string>, t string, x double")
    for r in rows.select("*", entities.coverage(F.col("w"), F.col("t")).alias("got")).collect():
        assert r.got == r.x, r


def test_gate(spark):
    rows = spark.createDataFrame([("ok thanks", True, True), ("this", False, False), ("token?", False, False), ("👍", True, True), ("fix it", False, True), ("who are you", False, False), ("thank you very much!", True, True), (None, True, True)], "t string, store boolean, recall boolean")
    for r in rows.select("*", gate.skip_store(F.col("t")).alias("s"), gate.skip_recall(F.col("t")).alias("r")).collect():
        assert (r.s, r.r) == (r.store, r.recall), r.t


def test_filter_faults():
    assert filters.faults({"k": "v"}) == []
    assert len(filters.faults({"a": {"gt": "x"}, "b": {"in": []}, "AND": [{"OR": []}]})) == 3
    assert filters.faults({"a": {"gte": True}})
    assert filters.faults({"s": "other"}, {"s": "mine"})
    assert not filters.faults({"s": {"in": ["mine", "x"]}}, {"s": "mine"})
    with pytest.raises(filters.FilterError):
        filters.where(StructType(), {"k": {"nope": 1}})


def test_scope_is_never_widened(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "a", 2), (4, None, 3)], "id int, s string, v int")
    scoped = {r.id for r in filters.matching(rows, {}, {"s": "a"}).collect()}
    for spec in ({"v": {"ne": 1}}, {"OR": [{"v": 1}, {"v": {"nin": [1]}}]}, {"NOT": [{"v": 1}]}, {"v": "*"}):
        assert {r.id for r in filters.matching(rows, spec, {"s": "a"}).collect()} <= scoped


def test_uuid5(spark):
    space = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    names = ["", "a", "ü/x", "src/1"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", T.uuid5(space, F.col("n")).alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.UUID(space), r.n)) for r in rows)


def test_rerank_keeps_order_without_scores(spark):
    rows = spark.createDataFrame([(1, 1, 0.2), (1, 2, None), (2, 1, 0.1), (2, 2, 0.9), (3, 1, float("nan"))], "query_id int, rank int, s double")
    out = {(r.query_id, r.s): r["rank"] for r in rank.reranked(rows, F.col("s")).collect() if r.query_id < 3}
    assert out == {(1, 0.2): 1, (1, None): 2, (2, 0.9): 1, (2, 0.1): 2}


def test_cascade_notes_failures(spark):
    q = spark.createDataFrame([(1,), (2,)], "query_id int")
    out = rank.cascade(q, [("bad", lambda d: d.select("nope")), ("good", lambda d: d.where("query_id = 1"))]).collect()
    assert [(r.query_id, r.level) for r in out] == [(1, "good")] and out[0].reason.startswith("bad failed")
    with pytest.raises(ValueError):
        rank.cascade(q, [])


def test_first_fit_depends_on_order(spark):
    v = spark.createDataFrame([(1, 1, "b", [1.0, 0.0]), (2, 2, "b", [0.8, 0.6]), (3, 3, "b", [0.6, 0.8]), (4, 4, "b", [0.0, 0.0])], "point_id long, pos long, block string, dense array<double>")
    found = {r.point_id: r.cluster for r in store.first_fit_clusters(v, "block", 0.75).collect()}
    assert found == {1: 1, 2: 1, 3: 1}
    with pytest.raises(ValueError):
        store.first_fit_clusters(v, "block", 2.0)


def test_markdown_walk(spark, tmp_path):
    for name, text in {"a.md": "# A\n", "sub/b.md": "x", ".hid/c.md": "no", "node/d.md": "no", "e.txt": "no"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    found = {r.path for r in readers.markdown_files(spark, str(tmp_path), "docs", ("node",)).collect()}
    assert found == {"docs/a.md", "docs/sub/b.md"}


def test_streaming_breaker_equals_batch(spark, tmp_path):
    rows = [("e", i, float(i), i % 9 == 8) for i in range(40)]
    schema = "endpoint string, seq long, ts double, ok boolean"
    data = spark.createDataFrame(rows, schema)
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.breaker(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 5, 10.0)
    got = jobs._drained(stream, "breaker").orderBy("seq").collect()
    assert got == store.breaker_states(data, 5, 10.0).orderBy("seq").collect()
