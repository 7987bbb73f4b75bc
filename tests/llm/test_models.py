"""Language, toxicity and personal data: gradients, held-out accuracy, brute force, edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recollect.llm import langid, pii, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_gradients_through_time():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"], hidden=3, seed=1)
    for p in net.parameters():
        p *= 2
    x = rng.integers(0, 256, (6, 4)).astype(np.uint8)
    mask = (np.arange(6)[:, None] < np.array([6, 6, 3, 1])[None, :]).astype(np.float32)[:, :, None]
    y = np.array([0, 1, 2, 1])
    _, grads = net.gradients(x, mask, y)
    for p, g in zip(net.parameters(), grads, strict=True):
        flat = p.reshape(-1)
        for i in rng.permutation(np.flatnonzero(np.abs(g.reshape(-1)) > 1e-4))[:5]:
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up, _ = net.gradients(x, mask, y)
            flat[i] = old - eps
            down, _ = net.gradients(x, mask, y)
            flat[i] = old
            assert abs((up - down) / (2 * eps) - g.reshape(-1)[i]) < 3e-3


def test_probabilities_read_every_byte():
    net = langid.Network(["a", "b"], hidden=4, seed=2)
    texts = [b"abc", b"", b"x" * 64, b"hello world " * 20]
    got = net.probabilities(texts)
    for t, p in zip(texts, got, strict=True):
        if t:
            parts = [t[i : i + 64] for i in range(0, len(t), 64)]
            each = [net.label(np.frombuffer(s, dtype=np.uint8)[:, None].copy(), None)[:, 0] for s in parts]
            assert np.allclose(np.concatenate(each).mean(axis=0), p, atol=1e-5)


def test_language_held_out(spark):
    out = queries.op2_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    rows = [(1, "some text here", "en", 0), (2, "quelque chose là", "fr", 0), (3, None, "en", 0), (4, "", None, 0), (5, "123 !", "en", 0), (5, "123 !", "en", 0), (6, "word", None, 0), (None, "null id", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = langid.identify(docs, F.lit(True)).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out if r.doc_id in (3, 4, 5)} == {"und"}
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 6, None)} <= {"en", "fr"}
    assert {r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
    assert langid.identify(docs.limit(0), F.lit(True)).count() == 0


def toxic_docs(n=240):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(6):
                w[rng.randrange(len(w))] = rng.choice(["nastyone", "nastytwo", "vile"])
        rows.append((i, " ".join(w), "k"))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_positive_unlabelled(spark):
    rows, labels = toxic_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), queries.fold(5) != 0)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i].predicted == (i % 6 == 0) for i in held) / len(held) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in out.values())
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.predicted == 0}


def test_prior_corrected_risk():
    """Unlabelled data that holds positives does not turn them into negatives."""
    rng = np.random.default_rng(0)
    rows, positive = [], []
    for i in range(400):
        toxic = i < 100 or (i - 100) % 4 == 0
        rows.append(np.array([0] if toxic else [1]) if rng.random() < 0.95 else np.array([], dtype=np.int64))
        positive.append(i < 100)
    w, b = toxicity.fit_nnpu(rows, np.array(positive), 0.25, 2)
    assert w[0] + b > 0 > w[1] + b


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "vile"), (3, "vile " * 50000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none, F.lit(True))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0] * 4
    model = toxicity.ToxicityModel({"=vile": 9.0}, -4.0)
    assert sorted(r.predicted for r in toxicity.score(docs, model).collect()) == [0, 0, 1, 1]
    labels = spark.createDataFrame([(1, 1), (None, 1), (9, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels, F.lit(True))).count() == 0


def test_toxicity_held_out(spark):
    out = queries.op8_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    found = [r.toxic for r in out if r.predicted]
    assert sum(found) / len(found) > 0.9 and sum(found) / sum(r.toxic for r in out) > 0.7


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, rx in KINDS.items():
        for m in re.finditer(rx, text):
            s = m.group()
            digits = re.sub("[^0-9]", "", s)
            if kind == "ip" and any(int(p) > 255 for p in s.split(".")):
                continue
            if kind == "card":
                total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_base_spans(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choice("ab.@-1290 +()é٣\n_%5") for _ in range(rng.randrange(0, 60)))
        assert pii.base_spans(text) == brute_spans(text), text
    for text in ("4539 1488 0343 6467 x", "4539148803436467", "1.2.3.4.5.6.7.8", "0300.1.2.3", "256.1.1.1 1.2.3.4", "+1 (234) 567-8901", "a@b.c@d.e", "a@b@c.d", "x" * 50000 + "@", "9" * 50000):
        assert pii.base_spans(text) == brute_spans(text)


def test_disclosing_terms(spark):
    rows = [(i, f"report {i} about Zorblatt from zed@corp.example number n{'abcdefghij'[i]}x") for i in range(6)]
    rows += [(100 + i, f"about the report from ordinary people q{i}") for i in range(60)] + [(200, None), (201, "")]
    rows += [(300 + i, "copy of Wibble with solo@x.example here") for i in range(5)]  # one context, however many copies
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, near int")
    out = {r.doc_id: r for r in pii.find(docs).collect()}
    text = dict(rows)
    for i in range(6):
        terms = [s.split(":") for s in out[i].spans.split(",") if s.startswith("term")]
        assert {text[i][int(a) : int(b)].lower() for _, a, b in terms} == {"zorblatt", "number"}
        assert out[i].spans.startswith("email:") and out[i].n_email == 1 and out[i].n_term == 2
        clean = pii.sanitise(text[i], out[i].spans)
        assert "<email>" in clean and "Zorblatt" not in clean and "about" in clean
    assert all(out[300 + i].n_term == 0 and out[300 + i].n_email == 1 for i in range(5))
    empty = hashlib.sha256(b"").hexdigest()
    assert (out[200].base_sha256, out[200].spans, out[201].n_email) == (empty, "", 0)
    assert pii.find(docs.limit(0)).count() == 0


def test_document_counts_by_shuffle(spark):
    docs = spark.createDataFrame([(1, "alpha beta alpha"), (2, "Beta"), (3, None)], "doc_id long, text string")
    terms = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    for bound in (10, 0):
        assert {r.term: r.n_term for r in pii.document_counts(docs, terms, bound).collect()} == {"alpha": 1, "beta": 2}


def test_pii_matches_brute_force_on_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op5_pii(spark, "/root/testdata/sf0.001").collect():
        want = brute_spans(docs[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest() and r.spans.startswith(written)
