"""The store end to end, and its settings."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from recollect import conf
from recollect.plans.engine import MemoryStore


def test_settings(tmp_path):
    with pytest.warns(UserWarning):
        c = conf.EngineConf().changed("x", {"hybrid": "maybe", "top_k": "7", "nope": 1})
    assert c.top_k == 7 and not c.hybrid
    path = str(tmp_path / "c.json")
    conf.save(path, {"hybrid": True, "api_key": "s", "top_k": 3})
    assert conf.load(path, {"RECOLLECT_TOP_K": "9", "RECOLLECT_GATE": "off"}) == conf.EngineConf(hybrid=True, top_k=3, gate=False)
    assert "api_key" not in (tmp_path / "c.json").read_text()
    (tmp_path / "bad.json").write_text("{")
    with pytest.warns(UserWarning):
        assert conf.load(str(tmp_path / "bad.json"), {}) == conf.EngineConf()


def test_store(spark, tmp_path):
    s = MemoryStore(spark, str(tmp_path / "m"), conf.EngineConf(temporal=True, entities=True, rerank=True, hybrid=True))
    t = datetime(2026, 10, 18, 12, tzinfo=UTC).timestamp()
    rows = [(1, "deploy the parser on friday", "a", t), (2, "deploy the parser on friday", "b", None), (3, "thanks!", "a", t), (4, "the cat sat on the mat", "a", t - 9e6)]
    s.upsert(spark.createDataFrame(rows, "point_id long, text string, session_id string, ts double"), 1)
    assert {r.point_id for r in s.points().collect()} == {1, 2, 4}
    q = spark.createDataFrame([(1, "parser deploy yesterday?"), (2, "ok thanks")], "query_id long, query string")
    now = datetime(2026, 10, 19, 14, 30, tzinfo=UTC)
    got = s.recall(q, now).collect()
    assert [r.point_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 1][0] in (1, 2) and all(r.query_id == 1 for r in got)
    assert {r.point_id for r in s.search(q, scope={"session_id": "a"}).collect()} <= {1, 4}
    s.upsert(spark.createDataFrame([(1, "release is monday", "a", t)], "point_id long, text string, session_id string, ts double"), 2)
    assert s.scroll("a").collect()[0].text == "release is monday"
    s.flag(spark.createDataFrame([(4, True, 1)], "point_id long, archived boolean, superseded_by long"))
    assert {r.point_id for r in s.points().collect()} == {1, 2}
    plan = {r.id: r.status for r in s.forget(["2", "77", "x y"], confirm=True).collect()}
    assert plan == {"2": "found", "77": "missing", "x y": "invalid"}
    assert s.collect().first().asDict() == {"points": 2, "archived": 1, "sessions": 1, "width": 64}
    s.compact()
    assert {r.point_id for r in s.points(True).collect()} == {1, 4} and s.prepare().count() == 0
    s.record(spark.createDataFrame([(1, t, 1, "recall", 0, "x")], "point_id long, ts double, seq long, event string, delta int, text string"))
    assert s.ledger().count() == 1
    with pytest.raises(ValueError):
        s.record(spark.createDataFrame([(1, t, 1, "oops", 0, "x")], "point_id long, ts double, seq long, event string, delta int, text string"))


def test_empty_store(spark, tmp_path):
    s = MemoryStore(spark, str(tmp_path / "e"))
    q = spark.createDataFrame([(1, "anything at all here")], "query_id long, query string")
    assert s.search(q).count() == 0 and s.recall(q).count() == 0 and s.collect().first().points == 0
    assert s.points().select(F.count("*")).first()[0] == 0
