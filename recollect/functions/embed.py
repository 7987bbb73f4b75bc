"""Embedders: a protocol, and a deterministic one that hashes words into a vector.

A model is loaded once in each Python worker. The hashing embedder counts each word in the cell that its MD5 names,
with a sign, and scales the vector to unit length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = re.compile(r"[^\W_]+")


class Embedder(Protocol):
    dims: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    def __init__(self, dims: int = 64):
        self.dims = dims

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for row, text in zip(out, texts, strict=True):
            for word in _WORD.findall((text or "").lower()):
                h = hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()
                row[int(h[:7], 16) % self.dims] += 1 if int(h[7], 16) % 2 == 0 else -1
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norm, out=out, where=norm > 0)


_LOADED: dict[Callable, Embedder] = {}


def embed_udf(loader: Callable[[], Embedder]):
    """Column function: text to vector; blank text has none. ``loader`` runs once in each worker."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(texts: pd.Series) -> pd.Series:
        model = _LOADED.get(loader) or _LOADED.setdefault(loader, loader())
        real = texts.fillna("").str.strip() != ""
        out: list = [None] * len(texts)
        if real.any():
            vectors = np.asarray(model.encode(texts[real].tolist()), dtype=np.float64)
            if not np.isfinite(vectors).all():
                raise ValueError("an embedding is not finite")
            for i, v in zip(np.flatnonzero(real), vectors, strict=True):
                out[i] = v
        return pd.Series(out, index=texts.index, dtype=object)

    return embed


def hash_embedder(dims: int = 64):
    return embed_udf(lambda: HashEmbedder(dims))
