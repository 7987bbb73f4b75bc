"""Personal data: disclosing terms over whole documents, and the same terms on every path."""

import math
import random
from collections import Counter

from recollect.llm import pii


def test_document_counts_are_the_same_on_both_paths(spark):
    texts = ["café table", "cafe table", "m²abc", "كَتَبَ كتب", "İstanbul istanbul", "नमस्ते", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter(t for x in texts for t in {t for t, _, _ in pii.terms_of(x or "")})
    terms = spark.createDataFrame([(t,) for t in want], "term string")
    for bound in (100, 0):
        assert {r.term: r.n_term for r in pii.document_counts(docs, terms, bound).collect()} == want
    assert want["cafe"] == 2 and want["m²abc"] == 1


def test_disclosing_terms_stand_anywhere_in_the_document(spark):
    filler = [" ".join(f"{w}{'abcdefghij'[i]}q" for w in ("lorem", "ipsum", "dolor", "amet", "elit", "sed", "tempor", "magna", "quis", "nisi", "aute", "velit")) for i in range(6)]
    rows = [(i, f"Zorblatt\n{filler[i]} about\n{filler[i]} and ZORBLATT again, contact zed@corp.example") for i in range(6)]
    rows += [(100 + i, f"about the ordinary people and contact again, day {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    for bound in (pii.BROADCAST_TERMS, 0):
        out = {r.doc_id: r for r in pii.find(docs, bound=bound).collect()}
        for i in range(6):
            spans = [s.split(":") for s in out[i].spans.split(",")]
            assert [text[i][int(a) : int(b)] for k, a, b in spans if k == "term"] == ["Zorblatt", "ZORBLATT"]
            assert "zorblatt" not in pii.sanitise(text[i], out[i].spans).lower()
        assert all(out[100 + i].spans == "" for i in range(60))


def test_pairs_match_brute_force(spark):
    rng = random.Random(3)
    people = ["ann@a.example", "bob@b.example", "+1 (234) 567-8901"]
    rows = []
    for i in range(300):
        words = [rng.choice("alpha beta gamma delta epsilon zeta théta kappa".split()) for _ in range(rng.randrange(3, 12))]
        held = rng.sample(people, rng.randrange(3)) if i % 3 == 0 else []
        rows.append((i, " ".join(words + held + ([f"only{held[0][:2]}"] if held and held[0][0] in "ab" else []))))
    n, docs_of, together = len(rows), Counter(), Counter()
    entity_docs, different, seen = Counter(), {}, {}
    for i, t in rows:
        spans = pii.base_spans(t)
        terms = {w for w, _, _ in pii.outside(t, spans)}
        docs_of.update({w for w, _, _ in pii.terms_of(t)})
        context = " ".join(w for w, _, _ in pii.outside(t, spans))
        seen[i] = (spans, pii.entities(t, spans))
        for e in seen[i][1]:
            entity_docs[e] += 1
            for w in terms:
                together[e, w] += 1
                different.setdefault((e, w), set()).add(context)
    want = {
        (e, w)
        for (e, w), both in together.items()
        if len(different[e, w]) >= 3 and math.log(both * n / (entity_docs[e] * max(docs_of[w], both))) / math.log(n / entity_docs[e]) >= pii.DISCLOSURE
    }
    assert {w for _, w in want} == {"onlyan", "onlybo"}
    out = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        spans, own = seen[i]
        places = [f"term:{a}:{b}" for w, a, b in pii.outside(t, spans) if any((e, w) in want for e in own)]
        assert out[i].spans == ",".join([f"{k}:{a}:{b}" for k, a, b in spans] + places) and out[i].n_term == len(places)
