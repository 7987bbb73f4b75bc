"""The pipeline's stages against brute force on a small table, and the SQL of the operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_duplicates import brute_components, brute_sets  # noqa: E402

import corpus_pipeline  # noqa: E402
from recollect.llm import exact_dedup, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "decontamination", "bpe"]
    rows = {r.doc_id: r for r in docs.collect()}
    model = queries.toxicity_model(spark, SF)
    kept = {i for i, r in rows.items() if model.score(r.text) < 0.5}
    first = {}
    for i in sorted(kept):
        first.setdefault(exact_dedup.normalise(rows[i].text), i)
    unique = set(first.values())
    comp = brute_components(brute_sets([(i, rows[i].text) for i in unique]))
    near = {i for i in unique if comp[i] == i}
    items = [s for (s,) in brute_sets([(r.item_id, r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]).values()]
    sets = {i: brute_sets([(i, (rows[i].text or "").lower())])[i][0] for i in near}
    clean = {i for i in near if not any(s and len(s & sets[i]) >= 0.75 * len(s) for s in items)}
    for (name, step), want in zip(corpus_pipeline.STAGES, (kept, unique, near, clean, clean), strict=True):
        docs = corpus_pipeline.stage(step(spark, docs, SF), f"test-{name}")
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
        if name != "bpe":
            assert docs.columns == columns
    assert {"doc_id", "n_tokens", "ids"} <= set(docs.columns)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import os

    import duckdb
    from test_oracles import TABLES, same

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    same(spark, con, queries.QUERIES[name], queries.ORACLES[name])
