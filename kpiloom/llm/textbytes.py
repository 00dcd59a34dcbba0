"""Vectorised tokenising and hashing of Arrow text columns.

Works on the UTF-8 bytes of many documents at once: a document's words are the maximal runs of bytes other than
space, tab, line feed, vertical tab, form feed and carriage return (all ASCII, so a byte is enough).  A null text has
no words.  Hashes are 64 bits, equal on every machine and in every run; they depend on the bytes alone.

Callers hand in slices of bounded size (``slices``); one document is never cut, so the longest document sets the
memory: about 40 bytes for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    h = h.astype(U, copy=True)
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x632BE59BD9B4E019))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_pow = {"up": np.ones(1, dtype=U), "down": np.ones(1, dtype=U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base and of its inverse modulo 2**64."""
    if len(_pow["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for key, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            p = np.full(size, U(base), dtype=U)
            p[0] = 1
            _pow[key] = np.multiply.accumulate(p)
    return _pow["up"], _pow["down"]


class Bytes:
    """The bytes of some documents, one after the other: ``data``, and ``at`` with their n + 1 borders."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self._sum = data, at, None

    def __len__(self) -> int:
        return len(self.at) - 1

    def lower(self) -> Bytes:
        return Bytes(_LOWER[self.data], self.at)

    def _prefix(self) -> np.ndarray:
        if self._sum is None:
            up, _ = _powers(len(self.data))
            s = np.zeros(len(self.data) + 1, dtype=U)
            np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=s[1:])
            self._sum = s
        return self._sum

    def hash_spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; equal for equal bytes wherever they stand."""
        s = self._prefix()
        _, down = _powers(len(self.data))
        return mix((s[end] - s[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and the n + 1 borders of the documents in the list of words."""
        solid = np.zeros(len(self.data) + 2, dtype=np.int8)
        solid[1:-1] = ~_SPACE[self.data]
        step = np.diff(solid)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        inner = self.at[1:-1]
        cut = inner[(inner > 0) & (inner < len(self.data))]
        cut = np.unique(cut[(solid[cut] == 1) & (solid[cut + 1] == 1)])     # a word may not run into the next document
        if len(cut):
            start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        return start, end, np.searchsorted(start, self.at)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Bytes]]:
    """(first row, end row, bytes) of consecutive rows with at most ``limit`` bytes, or of one row beyond it."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type) and not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    if texts.null_count:
        size = np.where(np.asarray(texts.is_null()), 0, size)
    i = 0
    total = np.concatenate([[0], np.cumsum(size)])
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        at = total[i: j + 1] - total[i]
        if texts.null_count and (off[j] - off[i]) != at[-1]:
            part = np.concatenate([data[off[k]: off[k] + size[k]] for k in range(i, j)])
        else:
            part = data[off[i]: off[i] + at[-1]]
        yield i, j, Bytes(part, at)
        i = j


def ngrams(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words of the whole list (callers leave out those that cross a border)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    h = np.zeros(n, dtype=U)
    for j in range(k):
        h *= U(_ODD)
        h += word_hash[j: j + n]
    return mix(h)


def inside(borders: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the starts 0..n-k have k places in one document, and the document of each place."""
    doc = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    n = len(doc) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=bool), doc
    return doc[:n] == doc[k - 1:], doc


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=h.dtype)
    have, m = 1, h
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < w:
        m = np.minimum(m[: n], m[w - have: w - have + n])
    return m[:n]
