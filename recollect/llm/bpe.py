"""Byte-level BPE encoding by prefix dynamic programming.

For every prefix of a piece exactly one token can be the last one of its BPE encoding. ``PrefixTable`` stores
that token for each prefix: among the vocabulary tokens that end at a position, the valid one is the token
whose start is 0 or whose neighbour - the stored last token of the remaining prefix - would stay apart from it
under BPE. The encoding of any prefix is read backwards from the table, so appending bytes extends the table
and leaves what is stored unchanged, and an edit only rebuilds what follows it. ``EditableText`` does the same for
whole texts: it splits again from a few pieces before an edit until the split falls in with the old one.

Defined cases: null and empty texts have no tokens and decode to nothing; special-token strings are ordinary
text; pieces that are vocabulary entries are one token, as in the public library; very long texts are encoded whole, and very long pieces take time
proportional to their length; repeated rows get equal rows; a null doc_id stays null; an empty table gives no rows; extra columns are ignored, whatever their names; of two
encodings of a piece BPE makes only one, so there are no ties; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import operator
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.runtime import bound_batches, tidied

#: Bounds of what a worker remembers, in bytes of words and pieces, and in pairs; longer ones are encoded anew each time.
CACHE_WORDS = 80 << 20
CACHE_PAIRS = 300_000
CACHE_BYTES = 64
#: What an entry of the memory takes besides its text and ids.
ENTRY_BYTES = 200


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min(((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks with each reachable token's last merge and an automaton over the reachable tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1:
                self.split[rank] = (rank, rank)
            else:
                halves = self._last_merge(token, rank)
                if halves is None:
                    continue  # BPE never builds it; it only stands for a piece equal to it
                self.split[rank] = halves
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        below = {}
        for i in range(len(token)):
            for j in range(i + 2, len(token) + 1):
                r = self.ranks.get(token[i:j])
                if r is not None and (i, j) != (0, len(token)):
                    below[token[i:j]] = r
        parts = _merge(token, below)
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' bytes together leaves them as these two tokens.

        Takes the merges inside both tokens back, latest first, and looks at each moment whether the two parts
        at the boundary would have merged before the merge that was taken back.
        """
        ranks, tokens, split = self.ranks, self.tokens, self.split
        limit = 1 << 60
        while True:
            together = ranks.get(tokens[left] + tokens[right])
            if together is not None and together < limit:
                return False
            one_left, one_right = len(tokens[left]) == 1, len(tokens[right]) == 1
            if one_left and one_right:
                return True
            if one_right or (not one_left and left > right):
                limit, left = left, split[left][1]
            else:  # at equal rank the left one is merged first
                limit, right = right + 1, split[right][0]


def _extend(v: Vocabulary, text: str, last: list[int], old: int) -> None:
    """Store the last token of every prefix of ``text`` (bytes as Latin-1) that is longer than ``old``."""
    known = v.pairs
    # tokens that end in the new bytes start at most the longest token's length before them
    for end, (rank, size) in v.automaton.iter(text, max(0, old - v.longest)) if old else v.automaton.iter(text):
        if end < old or last[end] >= 0:
            continue
        begin = end - size
        if begin < 0:
            last[end] = rank
        elif (before := last[begin]) >= 0:
            pair = before << 20 | rank
            fits = known.get(pair)
            if fits is None:
                if len(known) > CACHE_PAIRS:
                    known.clear()
                fits = known[pair] = v.apart(before, rank)
            if fits:
                last[end] = rank


class PrefixTable:
    """Last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes; nothing stored so far changes."""
        old = len(self.data)
        self.data += data
        self.last += [-1] * len(data)
        _extend(self.vocabulary, self.data.decode("latin-1"), self.last, old)

    def truncate(self, length: int) -> None:
        self.data, self.last = self.data[:length], self.last[:length]

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of data[start:end]; prefixes up to ``start`` keep their entries."""
        rest = self.data[end:]
        self.truncate(start)
        self.append(data + rest)

    def ids(self, length: int | None = None) -> list[int]:
        """Encoding of the first ``length`` bytes (default all)."""
        at, out = len(self.data) if length is None else length, []
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.tokens[token])
        return out[::-1]


def _words(text: str) -> list[str]:
    """The text cut before each single space that stands between two characters that are not white space."""
    parts = text.split(" ")
    words = [parts[0], *[" " + p for p in parts[1:]]]
    if all(map(_STANDS_ALONE, parts)):
        return words
    out: list[str] = []
    joined = True
    for part, word in zip(parts, words, strict=True):
        bare = not part or part[0].isspace()
        if out and (bare or joined):
            out[-1] += word
        else:
            out.append(word)
        joined = not part or part[-1].isspace()
    return out


def _STANDS_ALONE(part: str) -> bool:
    return part != "" and not part[0].isspace() and not part[-1].isspace()


class Memory:
    """Ids (little-endian, 32 bits) by text, in two generations: when the young one is full it becomes the old one, whose used entries move over."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old, self.held = limit // 2, {}, {}, 0

    def get(self, text: str) -> bytes | None:
        found = self.young.get(text)
        if found is None:
            found = self.old.get(text)
            if found is not None:
                self.put(text, found)
        return found

    def put(self, text: str, ids: bytes) -> None:
        self.held += len(text) + len(ids) + ENTRY_BYTES
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[text] = ids


class Encoder:
    """Splits text by a pattern and encodes each piece; remembers short words and pieces.

    ``spaced`` says that the pattern takes a single space between two other characters together with what
    follows it and never matches across such a space's left side. Words can then be looked up whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = False):
        self.vocabulary, self.pattern, self.spaced = Vocabulary(ranks), regex.compile(pattern), spaced
        self.words = Memory(CACHE_WORDS)
        self.table = [self.vocabulary.tokens.get(i, b"") for i in range(max(self.vocabulary.tokens) + 1)]
        self.ids = [struct.pack("<I", i) for i in range(len(self.table))]
        self.sizes = [len(t) for t in self.table]

    def _tokens(self, data: bytes) -> bytes:
        """Ids of one piece, read backwards from its prefix table."""
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return self.ids[whole]
        at = len(data)
        last = [-1] * at
        _extend(self.vocabulary, data.decode("latin-1"), last, 0)
        out, ids, sizes = [], self.ids, self.sizes
        while at:
            token = last[at - 1]
            out.append(ids[token])
            at -= sizes[token]
        out.reverse()
        return b"".join(out)

    def _piece(self, text: str) -> bytes:
        known = self.words.get(text)
        if known is None:
            known = self._tokens(text.encode("utf-8"))
            if len(text) <= CACHE_BYTES:
                self.words.put(text, known)
        return known

    def piece(self, text: str) -> tuple[int, ...]:
        return tuple(memoryview(self._piece(text)).cast("I"))

    def _word(self, word: str) -> bytes:
        """Ids of a word that is not remembered."""
        pieces = self.pattern.findall(word)
        ids = self._tokens(word.encode("utf-8")) if len(pieces) == 1 and len(pieces[0]) == len(word) else b"".join(map(self._piece, pieces))
        if len(word) <= CACHE_BYTES:
            self.words.put(word, ids)
        return ids

    def packed(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.spaced:
            return b"".join(map(self._piece, self.pattern.findall(text)))
        words = _words(text)
        found = list(map(self.words.young.get, words))
        if None in found:
            older = self.words.get
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = older(words[i]) or self._word(words[i])
        return b"".join(found)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        ids = list(ids)
        return b"".join(operator.itemgetter(*ids)(self.table)) if len(ids) > 1 else b"".join(self.table[i] for i in ids)


class EditableText:
    """A text whose encoding follows appends and edits without encoding the rest again."""

    #: Pieces before a change whose match may depend on characters after it (contractions, space runs).
    BACK = 3

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.starts, self.tokens = encoder, "", [], []
        self.replace(0, 0, text)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> int:
        """Put ``text`` in place of text[start:end]; returns how many pieces were encoded anew."""
        new, shift = self.text[:start] + text + self.text[end:], len(text) - (end - start)
        first = max(0, bisect.bisect_right(self.starts, start) - 1 - self.BACK)
        at = self.starts[first] if self.starts else 0
        old = {s + shift: i for i, s in enumerate(self.starts) if s >= end and i >= first}
        starts, tokens, tail = [], [], len(self.starts)
        for m in self.encoder.pattern.finditer(new, at):
            if m.start() >= start + len(text) and m.start() in old:
                tail = old[m.start()]
                break
            starts.append(m.start())
            tokens.append(self.encoder.piece(m.group()))
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[tail:]]
        self.tokens = self.tokens[:first] + tokens + self.tokens[tail:]
        self.text = new
        return len(starts)

    def ids(self) -> list[int]:
        return [i for piece in self.tokens for i in piece]


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str, spaced: bool = False) -> Encoder:
    """One encoder per worker process."""
    return Encoder(load_ranks(path), pattern, spaced)


def encode_documents(docs: DataFrame, path: str, pattern: str, *, spaced: bool = False, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with ``with_ids`` also the ids themselves.

    The vocabulary file must be at ``path`` on every worker, as installed packages are.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern, spaced)
        for batch in batches:
            packed = [own.packed(t) for t in batch.column(1).to_pylist()]
            ids = [np.frombuffer(x, dtype="<u4") for x in packed]
            columns = [
                batch.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                pa.array([hashlib.sha256(own.decode(x.tolist())).hexdigest() for x in ids], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<i4"), pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), T.StructType(fields))
