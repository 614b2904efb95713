"""Vectorised views of text columns inside Arrow map tasks.

A block is some whole texts as one byte buffer with offsets. Words are
``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes (no multi-byte character holds such a
byte). Hashes are 64-bit polynomials finished with an integer mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD_SPACE = np.zeros(256, dtype=bool)
WORD_SPACE[[32, 9, 10, 11, 12, 13]] = True

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    global _POW, _INV
    if len(_POW) <= n:
        size = max(n + 1, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        for base, name in ((_BASE, "_POW"), (inverse, "_INV")):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _POW, _INV


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ranked = np.sort(values)
    if len(ranked) < 2:
        return ranked
    return ranked[np.concatenate([[True], ranked[1:] != ranked[:-1]])]


def among(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Whether each value stands in the sorted array ``ranked``."""
    if len(ranked) == 0:
        return np.zeros(len(values), dtype=bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values


class Block:
    """Texts ``lo..hi`` of a batch: ``buf`` bytes, ``offs`` (n + 1 offsets into it)."""

    def __init__(self, lo: int, hi: int, buf: np.ndarray, offs: np.ndarray):
        self.lo, self.hi, self.buf, self.offs = lo, hi, buf, offs
        self._sums = None

    def __len__(self) -> int:
        return self.hi - self.lo

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """Number (within the block) of the text that holds each byte position."""
        return np.searchsorted(self.offs, positions, side="right") - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of True bytes; a run never crosses texts."""
        n = len(inside)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.empty(n + 1, dtype=bool)
        cut[0] = cut[n] = True
        np.not_equal(inside[1:], inside[:-1], out=cut[1:n])
        cut[self.offs] = True
        edges = np.flatnonzero(cut)
        keep = inside[edges[:-1]]
        return edges[:-1][keep], edges[1:][keep]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~WORD_SPACE[self.buf])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte span (equal bytes, equal hash)."""
        if self._sums is None:
            pow_, _ = _powers(len(self.buf))
            self._sums = np.zeros(len(self.buf) + 1, dtype=np.uint64)
            np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * pow_[: len(self.buf)], out=self._sums[1:])
        _, inv = _powers(len(self.buf))
        return mix64((self._sums[ends] - self._sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def text_blocks(column: pa.Array, fold: np.ndarray | None = None, max_bytes: int = 2 << 20):
    """Blocks of about ``max_bytes`` over a string column; null is an empty text.

    Every text is whole in one block, however long. ``fold`` maps bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, off_buf, data = column.buffers()
    if n == 0:
        return
    offs = np.frombuffer(off_buf, dtype=width)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        part = raw[offs[lo]: offs[hi]]
        yield Block(lo, hi, part if fold is None else fold[part], offs[lo: hi + 1] - offs[lo])
        lo = hi
