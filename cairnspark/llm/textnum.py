"""Vectorised text primitives over Arrow string batches.

Words, word hashes and word-shingle hashes are computed for a whole block of
documents with numpy, straight from the UTF-8 buffer, so no Python object is
made per word.  Blocks are bounded in bytes (one document at least), which
bounds a worker's memory whatever the batch size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
GOLDEN = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), element-wise."""
    x = x ^ (x >> _U(30))
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


_POS_BITS = 12
_POS = 1 << _POS_BITS
with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    _ODD = _U(0xD6E8FEB86659FD93)
    _POW = np.cumprod(np.concatenate([[_U(1)], np.full(_POS - 1, _ODD)]), dtype=np.uint64)
    _STEP = _POW[-1] * _ODD


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(offs):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block of documents, or runs of the bytes that ``word`` marks.

    ``start``/``end`` are byte positions in ``data``, ``doc`` the row of each
    word, ``first`` the index of each row's first word (length rows + 1).
    A run also ends before the byte positions ``breaks``.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, word: np.ndarray | None = None, breaks: np.ndarray | None = None):
        self.data, self.offs = data, offs
        n = len(data)
        word = ~_SEP[data] if word is None else word
        edge = np.zeros(n + 1, dtype=bool)
        edge[offs[:-1]] = True
        edge[n] = True
        if breaks is not None:
            edge[breaks] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = word[:-1]
        before &= ~edge[:n]
        self.start = np.flatnonzero(word & ~before)
        after = np.zeros(n, dtype=bool)
        after[:-1] = word[1:]
        after &= ~edge[1:]
        self.end = np.flatnonzero(word & ~after) + 1
        self.word = word
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """64-bit hash of each word; A-Z count as a-z if ``lower``."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        a, z = self.start[0], len(self.data)
        seg = self.data[a:z]
        spans = np.diff(np.append(self.start, z))
        pos = np.arange(a, z) - np.repeat(self.start, spans)
        with np.errstate(over="ignore"):
            part = _BYTE[_LOWER[seg] if lower else seg] * _POW[pos & (_POS - 1)]
            if int((self.end - self.start).max()) > _POS:
                hi = np.minimum(pos >> _POS_BITS, int((self.end - self.start).max()) >> _POS_BITS)
                steps = np.cumprod(np.concatenate([[_U(1)], np.full(int(hi.max()), _STEP)]), dtype=np.uint64)
                part *= steps[hi]
            part *= self.word[a:z]
            total = np.add.reduceat(part, self.start - a)
            return mix(total + (self.end - self.start).astype(np.uint64) * GOLDEN)

    def shingles(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``k`` words within a document, and the index of each run's first word.

        A document of fewer words, but one at least, has its whole sequence as one run.
        """
        n = len(hashes)
        counts = np.diff(self.first)
        if n >= k:
            at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        else:
            at = np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            out = np.zeros(len(at), np.uint64)
            for j in range(k):
                out = out * _U(0x9FB21C651E98DF25) + hashes[at + j]
            out = mix(out + _U(k))
            short = np.flatnonzero((counts > 0) & (counts < k))
            if len(short):
                extra = np.empty(len(short), np.uint64)
                for i, d in enumerate(short):
                    v = _U(0)
                    for h in hashes[self.first[d] : self.first[d + 1]]:
                        v = v * _U(0x9FB21C651E98DF25) + h
                    extra[i] = v + _U(0x51ED270B00000000) + _U(int(counts[d]))
                out = np.concatenate([out, mix(extra)])
                at = np.concatenate([at, self.first[short]])
                order = np.argsort(at, kind="stable")
                out, at = out[order], at[order]
        return out, at


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct ``k``-word shingle hashes of each row."""
    words = Words(data, offs)
    hashes, at = words.shingles(words.hashes(), k)
    cut = np.searchsorted(at, words.first)
    return [np.unique(hashes[cut[i] : cut[i + 1]]) for i in range(len(offs) - 1)]


def give_back() -> None:
    """Return freed memory to the system, so that an idle worker holds none."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def rows(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of a batch: first row, last row + 1, the bytes and the row offsets in them."""
    data, offs = as_bytes(batch.column(column))
    for lo, hi in blocks(offs, limit):
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
    give_back()
