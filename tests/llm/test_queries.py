"""Registered queries without SQL against plain loops, and the pipeline on odd rows."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_duplicates import brute_components, brute_sets  # noqa: E402

import corpus_pipeline  # noqa: E402
from recollect.llm import bpe, exact_dedup, langid, pii, queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- language


def plain_probabilities(net, text):
    """The network by loops over numbers: both directions over each segment, every byte labelled, the mean of all."""
    data, sums = text.encode(), np.zeros(len(net.langs))
    sig = lambda x: 1 / (1 + math.exp(-x))

    def states(layer, data):
        table, gates, cand = (p.astype(float) for p in layer.p)
        k, state, out = layer.h, [0.0] * layer.h, []
        for byte in data:
            a = table[byte]
            z = [sig(a[i] + sum(state[j] * gates[j][i] for j in range(k))) for i in range(k)]
            r = [sig(a[k + i] + sum(state[j] * gates[j][k + i] for j in range(k))) for i in range(k)]
            n = [math.tanh(a[2 * k + i] + sum(r[j] * state[j] * cand[j][i] for j in range(k))) for i in range(k)]
            state = [(1 - z[i]) * state[i] + z[i] * n[i] for i in range(k)]
            out.append(state)
        return out

    for at in range(0, len(data), langid.SEGMENT):
        part = data[at : at + langid.SEGMENT]
        ahead, behind = states(net.ahead, part), states(net.behind, part[::-1])[::-1]
        for f, b in zip(ahead, behind, strict=True):
            y = np.array(f + b) @ net.out[0].astype(float) + net.out[1]
            e = np.exp(y - y.max())
            sums += e / e.sum()
    return sums / len(data)


def test_language_query(spark, documents):
    out = {r.doc_id: r for r in queries.op2_language_id(spark, SF).collect()}
    assert set(out) == set(documents) and all(r.held_out == (crc(i, 3) == 1) for i, r in out.items())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(*langid.training_segments(docs.where(queries.fold(3) != 1).select("doc_id", "text", "lang")))
    lettered = [i for i, r in documents.items() if any(map(str.isalpha, r.text or ""))]
    for i in sorted(lettered, key=lambda i: len(documents[i].text))[::20]:
        p = plain_probabilities(net, documents[i].text)
        assert out[i].lang_pred == net.langs[int(p.argmax())] and abs(out[i].score - p.max()) < 1e-3
    for i, r in documents.items():
        if i not in lettered:
            assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    held = [out[i].lang_pred == documents[i].lang for i in lettered if crc(i, 3) == 1]
    assert sum(held) / len(held) > 0.9


def test_language_cases(spark):
    rows = [(1, "the cat and the dog " * 4000, "en"), (1, "the cat and the dog " * 4000, "en"), (2, "le chat et le chien " * 50, "fr"), (None, "the cat", None), (3, None, "en"), (4, "123 !", "fr"), (5, "", None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")
    out = [(r.doc_id, r.lang_pred) for r in langid.identify(docs, queries.fold(3) >= 0).collect()]
    assert Counter(out) == Counter([(1, "en"), (1, "en"), (2, "fr"), (None, "en"), (3, "und"), (4, "und"), (5, "und")])
    assert langid.identify(docs.limit(0), queries.fold(3) >= 0).count() == 0


# --- toxicity


def risk(w, b, rows, positive, prior):
    """The non-negative risk's two parts, by the definition."""
    z = np.array([sum(w[i] for i in r) + b for r in rows])
    s = 1 / (1 + np.exp(-z))
    p, u = s[positive], s[~positive]
    return prior * np.mean(-np.log(p)), u.mean() - prior * p.mean()


def test_gradient_of_the_risk_by_finite_differences():
    """One step of plain gradient descent, read off the first Adam moment, against differences of the risk."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 6, rng.integers(1, 5))) for _ in range(30)]
    positive = np.arange(30) < 10
    prior = 0.2
    w, b = toxicity.fit_nnpu(rows, positive, prior, 6, steps=1)
    start = float(np.log(prior / (1 - prior)))
    first, rest = risk(np.zeros(6), start, rows, positive, prior)
    assert rest > 0
    for k in range(7):
        e = 1e-5
        up, down = (np.eye(7)[k] * e * s for s in (1, -1))
        total = [sum(risk(d[:6], start + d[6], rows, positive, prior)) for d in (up, down)]
        slope = (total[0] - total[1]) / (2 * e)
        moved = (w[k] if k < 6 else b - start)
        assert abs(moved + toxicity.RATE * np.sign(slope)) < 1e-3 * toxicity.RATE or abs(slope) < 1e-6  # Adam's first step has the gradient's sign and the rate's size


def test_training_takes_back_a_negative_part():
    """With unlabelled rows that look like the positives the corrected part falls below zero; its gradient is then reversed."""
    rows = [np.array([0])] * 10 + [np.array([1])] * 10
    positive = np.arange(20) < 10
    w, b = toxicity.fit_nnpu(rows, positive, 0.6, 2, steps=400)
    assert risk(w, b, rows, positive, 0.6)[1] > -0.05


def test_toxicity_query(spark, documents):
    out = {r.doc_id: r for r in queries.op8_toxicity(spark, SF).collect()}
    assert set(out) == set(documents) and all(r.held_out == (crc(i, 5) == 0) for i, r in out.items())
    model = queries.toxicity_model(spark, SF)
    for i, r in documents.items():
        own = set()
        for w in toxicity.words(r.text):
            own |= {"=" + w, *["^" + w[:k] for k in toxicity.PREFIXES if len(w) > k]}
        z = model.bias + sum(model.weights.get(f, 0.0) for f in own)
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        assert abs(out[i].score - want) < 1e-9 and out[i].predicted == int(out[i].score >= 0.5)


# --- tokens


def test_token_query(spark, documents):
    path = P.path(queries.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    out = {r.doc_id: r for r in queries.op9_bpe(spark, SF).collect()}
    assert set(out) == set(documents)
    for i, r in documents.items():
        ids = library.encode_ordinary(r.text or "")
        assert out[i].n_tokens == len(ids)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_memory_of_two_generations():
    memory = bpe.Memory(10 * bpe.ENTRY_BYTES)
    for i in range(100):
        memory.put(f"w{i}", bytes([i]))
        assert memory.get(f"w{i}") == bytes([i]) and len(memory.young) + len(memory.old) <= 10
    assert memory.get("w0") is None and memory.get("w98") == bytes([98])


# --- personal data


def concept_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(400):
        text = [word() for _ in range(20)]
        if i % 10 == 0:
            text += [f"user{i}@mail.example", "token", "=", f'"{rng.getrandbits(160):040x}"']
        elif i % 97 == 0:
            text += ["token", "=", f'"{rng.getrandbits(160):040x}"']
        rows.append((i, " ".join(text)))
    return rows


def brute_concept(rows):
    spans = {i: pii.base_spans(t) for i, t in rows}
    holders = [i for i in spans if spans[i]]
    once = {}
    for i, t in rows:
        if spans[i]:
            found = [w for w, _, _ in pii.outside(t, spans[i])]
            kin = min(pii._hash(" ".join(found[j : j + 3])) for j in range(max(1, len(found) - 2)))
            terms = sorted(set(found))
            once[kin] = min(once.get(kin, terms), terms)
    both = Counter(w for terms in once.values() for w in terms)
    n_term = Counter(w for _, t in rows for w in {w for w, _, _ in pii.terms_of(t)})
    out = {}
    for w, k in both.items():
        n, z = max(n_term[w], k), pii.CONFIDENCE
        p = k / n
        low = (p + z**2 / (2 * n) - z * math.sqrt(p * (1 - p) / n + z**2 / (4 * n**2))) / (1 + z**2 / n)
        prior = len(holders) / len(rows)
        if low > 0 and math.log(low / prior) / math.log(1 / prior) >= pii.CONCEPT_DISCLOSURE:
            out[w] = (k, n_term[w])
    return out


@pytest.mark.parametrize("bound", [pii.BROADCAST_TERMS, 0], ids=["broadcast", "shuffle"])
def test_concept_terms(spark, bound):
    rows = concept_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string")
    want = brute_concept(rows)
    assert set(want) == {"token", "#ld32"}
    assert {r.term: (r.n_both, r.n_term) for r in pii.concept_terms(docs, bound=bound).collect()} == want
    out = {r.doc_id: r for r in pii.find(docs, bound=bound).collect()}
    for i, t in rows:
        base = pii.base_spans(t)
        places = [f"term:{a}:{b}" for w, a, b in pii.outside(t, base) if w in want]
        assert out[i].spans == ",".join([f"{k}:{a}:{b}" for k, a, b in base] + places) and out[i].n_term == len(places)


def test_sanitised(spark):
    rows = [*concept_rows(), (None, "write to user10@mail.example"), (500, None), (500, None), (501, "")]
    docs = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], "doc_id long, text string, spans string, `row` int")
    out = pii.sanitised(docs)
    assert out.columns == docs.columns
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert out.count() == len(rows) and {(500, None), (501, ""), (None, "write to <email>")} <= got
    text = {i: t for i, t in got}
    assert text[0].endswith(' <email>  = "<id>"') and "token" not in text[97] and text[97].endswith('= "<id>"') and text[1] == rows[1][1]
    assert pii.sanitised(docs.limit(0)).count() == 0 and pii.find(docs.limit(0)).count() == 0


# --- the pipeline


ODD = [
    (1, "one two three four five six seven eight nine ten"),
    (1, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine  ten"),
    (3, "ONE two three four five six seven eight nine ten eleven"),
    (4, None),
    (5, None),
    (6, ""),
    (7, " \n"),
    (None, "a text without an id that stands alone here"),
    (8, "plain " * 60000),
    (9, "ties " * 20),
    (10, "ties " * 21),
    (11, None),
    (11, "another text under the id of a null text, long enough"),
]


def test_pipeline_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "k", 1, "c") for i, t in ODD], "doc_id long, text string, `row` string, n int, component_id string")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert items.count()
    model = queries.toxicity_model(spark, SF)
    assert all(model.score(t) < 0.5 for _, t in ODD)
    first = {}
    for i, t in sorted(ODD, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(exact_dedup.normalise(t), (i, t))
    unique = Counter(i for i, _ in first.values())
    comp = brute_components(brute_sets(list(first.values())))
    near = Counter([i for i in unique if i is None or comp[i] == i])
    for (name, step), want in zip(corpus_pipeline.STAGES, (Counter(i for i, _ in ODD), unique, near, near, near), strict=True):
        columns = docs.columns
        docs = corpus_pipeline.stage(step(spark, docs, SF), f"odd-{name}")
        assert Counter(r.doc_id for r in docs.select("doc_id").collect()) == want, name
        if name != "bpe":
            assert docs.columns == columns
    out = {r.doc_id: r for r in docs.collect()}
    assert out[8].n_tokens > 60000 and out[None].n_tokens > 0
    assert out[4].n_tokens == 0 and out[4].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
