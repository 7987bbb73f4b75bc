"""BPE against the public library, URL rules against plain globs."""

import random
import re

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from recollect.llm import bpe, queries, url_filter

PATH = P.path(queries.VOCABULARY)
ALPHABET = "abcdeghilnorstuvéñßçü'  \n\tABC0123.,!-_日本語😀\x1c\x85\xa0²"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(PATH, P.PATTERN, True)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(ALPHABET), max_size=60) | st.text(max_size=30))
def test_equals_library(text):
    if any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}) if not hasattr(test_equals_library, "lib") else test_equals_library.lib
    test_equals_library.lib = lib
    e = bpe.encoder(PATH, P.PATTERN, True)
    ids = e.encode(text)
    assert ids == lib.encode_ordinary(text)
    assert e.decode(ids) == text.encode()


def test_edits(own, library):
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        edited = bpe.EditableText(own, text)
        a, b = sorted((rng.randint(0, len(text)), rng.randint(0, len(text))))
        new = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 5)))
        edited.replace(a, b, new)
        assert edited.ids() == library.encode_ordinary(text[:a] + new + text[b:])
        edited.append("'l")
        edited.append("l x")
        assert edited.ids() == library.encode_ordinary(edited.text)


def test_prefix_table_appends(own):
    whole = bpe.PrefixTable(own.vocabulary, b"international")
    grown = bpe.PrefixTable(own.vocabulary, b"inter")
    before = list(grown.last)
    grown.append(b"national")
    assert grown.last == whole.last and grown.last[:5] == before
    assert [grown.ids(k) for k in range(14)] == [bpe.PrefixTable(own.vocabulary, b"international"[:k]).ids() for k in range(14)]
    grown.replace(2, 5, b"")
    assert grown.ids() == bpe.PrefixTable(own.vocabulary, b"innational").ids()


def test_long_piece(own, library):
    assert own.encode("ab" * 20000) == library.encode_ordinary("ab" * 20000)
    assert own.encode(" " * 5000 + "x") == library.encode_ordinary(" " * 5000 + "x")


def test_documents(spark, library):
    rows = [(1, None), (1, None), (2, ""), (3, "Hello  world"), (None, "x y")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_tokens int")
    out = bpe.encode_documents(docs, PATH, P.PATTERN, spaced=True, with_ids=True).collect()
    assert len(out) == 5
    assert {r.doc_id: r.ids for r in out}[3] == library.encode_ordinary("Hello  world")
    assert bpe.encode_documents(docs.limit(0), PATH, P.PATTERN).count() == 0


def plain(globs, text):
    out = []
    for g in globs:
        head, slash, tail = g.partition("/")
        rx = re.escape(head).replace(r"\*", "[^/]*") + slash + re.escape(tail).replace(r"\*", ".*")
        out.append(re.fullmatch(rx, text, re.DOTALL) is not None)
    return out


@settings(max_examples=300, deadline=None)
@given(globs=st.lists(st.text(st.sampled_from("ab./*"), min_size=1, max_size=12), min_size=1, max_size=30), texts=st.lists(st.text(st.sampled_from("ab./"), max_size=14), max_size=6))
def test_automaton(globs, texts):
    # a star right before the first slash may not pass it
    hit = url_filter.WildcardAutomaton(globs).match([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert hit[i].tolist() == plain(globs, t)


def brute_rule(url):
    host, path = url_filter.split_url(url)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_pages(spark):
    urls = ["http://WWW.Example.com/en/x?q", "https://example.com/en/", "http://a.net/es/1#t", "net://net/fr/", "http://notexample.com/en/x", "http://example.com", "x", "", None, "http://é.net/es/ñ", "a://b.com/" + "x" * 5000, "http://x.org/cart/1", "http://x.com/y.exe"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = {r.page_id: r for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    for i, u in enumerate(urls):
        rule = brute_rule(u)
        assert (out[i].host, out[i].path) == url_filter.split_url(u)
        assert out[i].rule == (rule.name if rule else None)
        if rule:
            assert out[i].verdict == rule.verdict
    assert out[8].verdict == "allow" and out[11].verdict == "block" and out[12].verdict == "allow"
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0
