"""URL filtering by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL ``.`` + host + path (UTF-8 bytes): ``*`` stands for any bytes
other than ``/`` before the first ``/`` of the pattern, and for any bytes after it. The patterns' positions
are packed one after the other into 64-bit words; one Shift-And step per byte moves all patterns of all URLs
of a batch at once, with carries between the words and self-loops at the stars. Rules come in two kinds:
host rules (host, path, verdict), where the longest that fits wins, and glob rules that decide the URLs that
no host rule fits.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and the default
verdict; ties cannot occur between host rules of equal length that fit one URL, since they would be equal;
repeated rows get equal rows; a null page_id stays null; very long URLs cost their own length only; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.runtime import tidied


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}*"


#: Globs of the method itself, for URLs that no host rule fits: tracking and advertising hosts, gambling, pills, adult and spam hosts, and pages without prose.
BLOCK_GLOBS = ("*.ads.*/*", "*.ads-*/*", "*.adserver.*/*", "*.tracker.*/*", "*casino*/*", "*-bets.*/*", "*pills.*/*", "*adult*/*", "*spam*/*", "*/wp-login*", "*/cgi-bin/*", "*/cart/*", "*/checkout/*", "*.exe", "*.zip")

DEFAULT_VERDICT = "allow"

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class WildcardAutomaton:
    """All globs at once. Accepts a pattern if it matches the whole string."""

    def __init__(self, globs: list[str]):
        cells: list[tuple[int, bool, bool]] = []  # byte to consume (-1: end), star before it, star may cross '/'
        self.final: list[int] = []
        first: list[int] = []
        for glob in globs:
            first.append(len(cells))
            star = crosses = False
            for byte in glob.encode("utf-8"):
                if byte == 0x2A:
                    star = True
                    continue
                cells.append((byte, star, crosses))
                crosses, star = crosses or byte == 0x2F, False
            self.final.append(len(cells))
            cells.append((-1, star, crosses))
        self.words = max(1, -(-len(cells) // 64))
        self.step = np.zeros((256, self.words), dtype=np.uint64)  # positions that a byte moves on from
        self.loop = np.zeros((256, self.words), dtype=np.uint64)  # positions that a byte leaves in place
        self.start = np.zeros(self.words, dtype=np.uint64)
        for i in first:
            self.start[i // 64] |= np.uint64(1 << (i % 64))
        for i, (byte, star, crosses) in enumerate(cells):
            bit = np.uint64(1 << (i % 64))
            if byte >= 0:
                self.step[byte, i // 64] |= bit
            if star:
                self.loop[:, i // 64] |= bit
                if not crosses:
                    self.loop[0x2F, i // 64] &= ~bit

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix: text by pattern."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
        data = np.frombuffer(b"".join(texts[i] for i in order), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        live = len(texts)
        for at in range(int(sizes[0]) if len(sizes) else 0):
            while live and sizes[live - 1] <= at:
                live -= 1
            byte = data[offsets[:live] + at]
            now = state[:live]
            moved = now & self.step[byte]
            carry = moved >> top
            moved <<= one
            moved[:, 1:] |= carry[:, :-1]
            moved |= now & self.loop[byte]
            state[:live] = moved
            if not moved.any():
                break
        out = np.zeros((len(texts), len(self.final)), dtype=bool)
        for k, i in enumerate(self.final):
            out[order, k] = (state[:, i // 64] >> np.uint64(i % 64)) & one != 0
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    head, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.encode("utf-8", "surrogatepass").translate(_UPPER).decode("utf-8", "surrogatepass"), slash + path


def judge(pages: DataFrame, rules: list[HostRule], globs: tuple[str, ...] = BLOCK_GLOBS, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url)."""
    rules = sorted(rules, key=lambda r: -len(r.name.encode("utf-8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WildcardAutomaton([r.glob for r in rules] + list(globs))
        names = np.array([*[r.name for r in rules], None], dtype=object)
        verdicts = np.array([*[r.verdict for r in rules], None], dtype=object)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            hit = automaton.match([f".{h}{p}".encode("utf-8", "surrogatepass") for h, p in parts])
            ours = hit[:, : len(rules)]
            which = np.where(ours.any(axis=1), ours.argmax(axis=1) if len(rules) else 0, len(rules))
            own = np.where(hit[:, len(rules) :].any(axis=1), "block", default)
            own[[h == "" and p == "" for h, p in parts]] = default
            verdict = [own[i] if which[i] == len(rules) else verdicts[which[i]] for i in range(len(parts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array(names[which].tolist(), pa.string()), pa.array([str(v) for v in verdict], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    schema = T.StructType([T.StructField("page_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")]])
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).mapInArrow(tidied(run), schema)
