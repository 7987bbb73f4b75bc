"""Parity signatures: short summaries of sets that bound from above how much two sets share.

Every token flips one bit of its set's signature, so the bits in which two signatures differ are at most as many as
the tokens in which the sets differ, and ``overlap <= (n_a + n_b - differing bits) / 2``. A signature of a set of n
tokens has a power of two of at least ``BITS_PER_TOKEN * n`` bits (about a sixteenth of the set itself); folding its halves onto each other gives
the signature of half the width, so that sets of unlike sizes compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LEAST_BITS = 512
BITS_PER_TOKEN = 4


def signature(tokens: np.ndarray) -> bytes:
    """Signature of a set of 64-bit hashes."""
    bits = max(LEAST_BITS, 1 << (BITS_PER_TOKEN * len(tokens) - 1).bit_length() if len(tokens) else 0)
    return np.packbits((np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(table: np.ndarray) -> np.ndarray:
    """Rows of signatures at half their width."""
    half = table.shape[1] // 2
    return table[:, :half] ^ table[:, half:]


def allowed(n_a, n_b, percent: int):
    """Tokens in which sets of these sizes may differ and still link."""
    return n_a + n_b - 2 * -(-percent * (n_a + n_b) // (100 + percent))


def near(n: np.ndarray, signatures: list[bytes], percent: int, meets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, differing bits) of the pairs that may link, for sets by ascending size; ``meets(i, js)`` says which to look at."""
    widths = np.array([len(s) // 8 for s in signatures])
    tables, starts = {}, {}
    for w in np.unique(widths).tolist():  # widths ascend with the sizes
        a, b = np.searchsorted(widths, [w, w + 1]).tolist()
        tables[w], starts[w] = np.frombuffer(b"".join(signatures[a:b]), dtype=np.uint64).reshape(b - a, w), a
    halves = {w: folded(t) for w, t in tables.items()}
    limit = np.searchsorted(n, n * 100 // percent, side="right")
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(n)):
        js = np.arange(i + 1, limit[i])
        js = js[meets(i, js)]
        if not len(js):
            continue
        w = int(widths[i])
        own = tables[w][i - starts[w]]
        for width, by_width in ((w, tables), (2 * w, halves)):
            part = js[widths[js] == width]
            if len(part):
                differ = np.bitwise_count(by_width[width][part - starts[width]] ^ own).sum(axis=1, dtype=np.int64)
                keep = differ <= allowed(n[i], n[part], percent)
                if keep.any():
                    out.append((np.full(int(keep.sum()), i), part[keep], differ[keep]))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def keyed(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """(key, columns) of each key of rows that come sorted by their first ``keys`` columns, all of them integers.

    The other columns come as numpy arrays, binary ones as lists. A key's rows are held together, so keys have to be bounded.
    """
    held: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [a + b if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
        change = np.zeros(len(columns[0]) - 1, dtype=bool)
        for c in columns[:keys]:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(edges, edges[1:], strict=False):
            yield tuple(int(c[a]) for c in columns[:keys]), [c[a:b] for c in columns[keys:]]
        held = [c[edges[-1] :] for c in columns]
    if held is not None:
        yield tuple(int(c[0]) for c in held[:keys]), held[keys:]
