"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read each segment of a text's UTF-8 bytes, one from either end; their states label
every byte position with a distribution over the languages, and a document's probabilities are the mean over
all its positions. Segments are ``SEGMENT`` bytes, in training and in prediction; the state starts anew in each, so that a document's segments can be read at once. The network is trained in numpy by backpropagation through time, on the driver, from a
bounded sample: up to ``DOCS_PER_LANG`` documents of each language by hash order, up to ``SEGMENTS_PER_DOC``
evenly spaced segments from each. Prediction reads every byte of every text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows without a language are not
learned from; with nothing to learn from every row is ``und``; one learned language is always predicted with
score 1; ties go to the first language by name; repeated rows get equal rows, and count once each as examples; a null doc_id is labelled but not learned from;
very long texts are labelled whole, ``BLOCK`` segments at a time; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.runtime import bound_batches, small_side, stage, tidied

SEGMENT = 64
HIDDEN = 8
DOCS_PER_LANG = 250
SEGMENTS_PER_DOC = 8
#: Times as many documents of a language as are wanted whose hashes are ranked, and languages that are broadcast at most.
SPARE = 4
BROADCAST_LANGS = 10_000
STEPS = 160
BATCH = 256
#: Segments labelled at once.
BLOCK = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


class GatedLayer:
    """One direction. Parameters: byte table (256, 3H) for update, reset and candidate, and recurrent weights."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.h = hidden
        self.p = [
            rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            rng.normal(0, 0.3, (hidden, 2 * hidden)).astype(np.float32),
            rng.normal(0, 0.3, (hidden, hidden)).astype(np.float32),
        ]

    def forward(self, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """x: (T, B) bytes; mask: (T, B, 1) or None if all are real. Returns states (T, B, H)."""
        table, gates, cand = self.p
        k = self.h
        steps, batch = x.shape
        out = np.empty((steps, batch, k), dtype=np.float32)
        state = np.zeros((batch, k), dtype=np.float32)
        for t in range(steps):
            a = table[x[t]]
            zr = state @ gates
            zr += a[:, : 2 * k]
            _sigmoid(zr)
            z, r = zr[:, :k], zr[:, k:]
            rs = r * state
            n = rs @ cand
            n += a[:, 2 * k :]
            np.tanh(n, out=n)
            new = n - state
            new *= z
            new += state
            if mask is not None:
                new *= mask[t]
            if keep is not None:
                keep.append((state, z, r, n, rs))
            out[t] = state = new
        return out

    def backward(self, x: np.ndarray, mask: np.ndarray, keep: list, up: np.ndarray) -> list[np.ndarray]:
        """Gradients of the parameters for the gradient ``up`` of the states."""
        table, gates, cand = self.p
        k = self.h
        dt, dg, dc = (np.zeros_like(p) for p in self.p)
        back = np.zeros_like(up[0])
        for t in range(len(x) - 1, -1, -1):
            state, z, r, n, rs = keep[t]
            d = (back + up[t]) * mask[t]
            dn = d * z * (1 - n * n)
            dz = d * (n - state) * z * (1 - z)
            drs = dn @ cand.T
            dr = drs * state * r * (1 - r)
            dzr = np.concatenate([dz, dr], axis=1)
            np.add.at(dt, x[t], np.concatenate([dzr, dn], axis=1))
            dg += state.T @ dzr
            dc += rs.T @ dn
            back = d * (1 - z) + drs * r + dzr @ gates.T
        return [dt, dg, dc]


class Network:
    """Both directions and the labelling of positions."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.ahead, self.behind = GatedLayer(rng, hidden), GatedLayer(rng, hidden)
        self.out = [rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32), np.zeros(len(langs), dtype=np.float32)]

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.p, *self.behind.p, *self.out]

    def _label(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = f.shape[2]
        p = f.reshape(-1, k) @ self.out[0][:k]
        p += b.reshape(-1, k) @ self.out[0][k:]
        p += self.out[1]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p.reshape(f.shape[0], f.shape[1], -1)

    def label(self, x: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Distribution over the languages at every position: (T, B, L)."""
        f = self.ahead.forward(x, mask)
        b = self.behind.forward(x[::-1], None if mask is None else mask[::-1])[::-1]
        return self._label(f, b)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over real positions and its gradients, through all time steps."""
        kf, kb = [], []
        f = self.ahead.forward(x, mask, kf)
        rb = self.behind.forward(x[::-1], mask[::-1], kb)
        b = rb[::-1]
        p = self._label(f, b)
        total, k = mask.sum(), f.shape[2]
        pos = np.arange(len(y))
        loss = float(-(np.log(p[:, pos, y] + 1e-9) * mask[:, :, 0]).sum() / total)
        d = p
        d[:, pos, y] -= 1
        d *= mask / total
        flat = d.reshape(-1, d.shape[2])
        dw = np.concatenate([f.reshape(-1, k).T @ flat, b.reshape(-1, k).T @ flat])
        df, db = d @ self.out[0][:k].T, d @ self.out[0][k:].T
        return loss, [*self.ahead.backward(x, mask, kf, df), *self.behind.backward(x[::-1], mask[::-1], kb, db[::-1]), dw, flat.sum(axis=0)]

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text: (texts, L)."""
        sums = np.zeros((len(texts), len(self.langs)))
        counts = np.array([-(-len(t) // SEGMENT) for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = b"".join(t + bytes(c * SEGMENT - len(t)) for t, c in zip(texts, counts.tolist(), strict=True))
        cells = np.frombuffer(padded, dtype=np.uint8).reshape(-1, SEGMENT)
        last = np.cumsum(counts) - 1
        real = np.full(len(cells), SEGMENT, dtype=np.int64)
        some = counts > 0
        real[last[some]] = np.array([len(t) for t in texts], dtype=np.int64)[some] - (counts[some] - 1) * SEGMENT
        order = np.argsort(-real, kind="stable")  # whole segments first: they need no mask
        for at in range(0, len(order), BLOCK):
            rows = order[at : at + BLOCK]
            mask = None
            if real[rows[-1]] < SEGMENT:
                mask = (np.arange(SEGMENT)[:, None] < real[rows][None, :]).astype(np.float32)[:, :, None]
            p = self.label(np.ascontiguousarray(cells[rows].T), mask)
            if mask is not None:
                p *= mask
            pooled = p.sum(axis=0, dtype=np.float64)
            for lang in range(pooled.shape[1]):
                sums[:, lang] += np.bincount(owner[rows], weights=pooled[:, lang], minlength=len(texts))
        return sums / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def train(segments: list[bytes], labels: list[str], steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> Network | None:
    """Network fitted by Adam on batches that hold each language equally often."""
    langs = sorted(set(labels))
    if not langs:
        return None
    net, rng = Network(langs, seed=seed), np.random.default_rng(seed)
    x = np.zeros((len(segments), SEGMENT), dtype=np.uint8)
    size = np.array([len(s) for s in segments])
    for i, s in enumerate(segments):
        x[i, : len(s)] = np.frombuffer(s, dtype=np.uint8)
    y = np.array([langs.index(v) for v in labels])
    members = [np.flatnonzero(y == k) for k in range(len(langs))]
    params = net.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(own, -(-batch // len(langs))) for own in members])
        mask = (np.arange(SEGMENT)[:, None] < size[pick][None, :]).astype(np.float32)[:, :, None]
        _, grads = net.gradients(np.ascontiguousarray(x[pick].T), mask, y[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.03 * (1 - 0.9 * step / steps)
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return net


def training_segments(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, per_doc: int = SEGMENTS_PER_DOC) -> tuple[list[bytes], list[str]]:
    """Bounded sample of (segment, lang) from ``docs`` (doc_id, text, lang): the first documents of each language by hash order.

    A language's number of documents says below which hash its first ones lie, so that only about ``SPARE`` times as many are ranked.
    """
    hashed = docs.where("lang is not null and text is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    counts = stage(hashed.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    low = (F.col("h").cast("double") + 2.0**63) / 2.0**64 * F.col("n") <= SPARE * docs_per_lang
    few = hashed.join(small_side(counts, BROADCAST_LANGS), "lang").where(low)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = few.select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= docs_per_lang)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "lang")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, langs, ids = [], [], []
            for doc, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                starts = sorted({int(i) for i in np.linspace(0, max(0, len(data) - SEGMENT), per_doc)}) if any(map(str.isalpha, text or "")) else []
                out += [data[s : s + SEGMENT] for s in starts]
                langs += [lang] * len(starts)
                ids += [doc] * len(starts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(langs, pa.string())], names=["doc_id", "data", "lang"])

    rows = chosen.select(F.col("doc_id").cast("long"), "text", "lang").mapInArrow(tidied(run), "doc_id long, data binary, lang string").collect()
    rows = sorted((r["lang"], r["doc_id"], bytes(r["data"])) for r in rows)
    return [r[2] for r in rows], [r[0] for r in rows]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names: list[str] = ["und"] * len(texts)
            scores = [0.0] * len(texts)
            lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if net is not None and lettered:
                p = net.probabilities([texts[i].encode("utf-8", "surrogatepass") for i in lettered])
                best = p.argmax(axis=1)
                for i, k, row in zip(lettered, best, p, strict=True):
                    names[i], scores[i] = net.langs[k], min(1.0, float(row[k]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), schema)


def identify(docs: DataFrame, learn_from) -> DataFrame:
    """Train on the rows of ``docs`` that the column ``learn_from`` allows, then label every row."""
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(learn_from, F.lit(False)).alias("learn"))
    return predict(docs, train(*training_segments(sample.where("learn").drop("learn"))))
