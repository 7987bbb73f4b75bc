"""Queries that once kept a few ids work on whole tables, and so does their SQL."""

import re

import duckdb
import pytest

from recollect.operators import rank
from recollect.plans import catalog
from recollect.plans.base import vectors
from tests.test_oracles import SF, TABLES, norm, same

ASKED = [n for n in ("knn_topk", "knn_dot", "knn_euclid", "knn_scoped_filtered", "bm25_topk", "bm25_root_filter", "sparse_idf_topk", "hybrid_rrf", "md_search_auto") if n in catalog.ORACLES]


CANDIDATES = [n for n in ("temporal_window_halfopen", "time_range_inclusive", "bucket_spread", "temporal_keep_unknown", "temporal_fallback_empty", "dedup_jaccard_greedy", "jaccard_pairs", "rerank_overlap") if n in catalog.ORACLES]
LARGER = SF.replace("0.001", "0.01")  # 10,000 events


def tables(d):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def con():
    return tables(SF)


@pytest.fixture(scope="module")
def larger():
    return tables(LARGER)


@pytest.mark.parametrize("name", ASKED)
def test_queries_with_ids_divisible_by_50(spark, con, name):
    sql = catalog.ORACLES[name]
    assert re.search(r"(vec_id|item_id) % 50 = 0", sql) and not re.search(r"(vec_id|item_id) < \d", sql)
    same(spark, con, catalog.QUERIES[name], sql)


def test_recall_pipeline_asks_ids_divisible_by_50(spark):
    ids = {r.query_id for r in catalog.QUERIES["recall_pipeline"](spark, SF).select("query_id").distinct().collect()}
    assert ids and all(i % 50 == 0 for i in ids)


def equal(spark, con, d, name, sql):
    df, rel = catalog.QUERIES[name](spark, d), con.sql(sql)
    at = [rel.columns.index(c) for c in df.columns]
    got = sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", CANDIDATES)
def test_candidates_come_from_all_points(spark, larger, name):
    assert "point_id < 4000" not in catalog.ORACLES[name]
    equal(spark, larger, LARGER, name, catalog.ORACLES[name])


def test_entity_boost_has_all_sessions_top_12(spark, larger):
    got = {(r.query_id, r.point_id) for r in catalog.QUERIES["entity_boost"](spark, LARGER).collect()}
    want = larger.sql("select user_id, event_id from events qualify row_number() over (partition by user_id order by value desc, event_id) <= 12")
    assert got == set(want.fetchall())


@pytest.mark.parametrize(
    ("name", "cut", "d"),
    [
        ("merge_payloads", " WHERE point_id < 400", SF),
        ("supersede_flags", " WHERE point_id < 3000", LARGER),
        ("breaker_state", " WHERE event_id < 600", SF),
        ("gate_store", " WHERE conv_id % 10 = 0", SF),
        ("text_truncation", " WHERE point_id % 50 = 1", SF),
    ],
)
def test_whole_table(spark, name, cut, d):
    assert cut not in catalog.ORACLES[name]
    equal(spark, tables(d), d, name, catalog.ORACLES[name])


def test_near_dup_pairs_without_top_k(spark, con, monkeypatch):
    monkeypatch.setattr(rank, "dense_topk", None)  # its k cut partners off, and it collects every query vector
    equal(spark, con, SF, "near_dup_pairs", catalog.ORACLES["near_dup_pairs"])


def test_pairs_of_many_parts(spark):
    v = vectors(spark, SF)
    want = rank.pairs_at_least(v, 0.2, "label", block=1 << 20).collect()
    got = rank.pairs_at_least(v, 0.2, "label", block=7).collect()
    assert want and sorted(map(tuple, got)) == sorted(map(tuple, want))
