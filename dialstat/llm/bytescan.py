"""Vectorised word scanning over the UTF-8 bytes of an Arrow text column.

A batch of texts is handled as one byte array with row bounds, so finding words, hashing them
and hashing windows of words are a handful of numpy passes and no per-word Python.  Chunks are
cut at row bounds near ``CHUNK_BYTES``; one longer text makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SEED = 0x5EED


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


# Bytes of a word [^\x20\x09-\x0D]+ and, after lower-casing A-Z, of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
SPACED = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = _byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_rng = np.random.default_rng(_SEED)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 5


class _Powers:
    """base**i and its inverse modulo 2**64, kept between batches of a task, never shipped."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __reduce__(self):
        return type(self), ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.up, self.down = (self._run(base, size) for base in (_BASE, pow(_BASE, -1, 2**64)))
        return self.up, self.down

    @staticmethod
    def _run(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row bounds) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) pieces of a column, cut at row bounds."""
    if len(column) == 0:
        return
    raw, bounds = text_bytes(column)
    lo = 0
    while lo < len(bounds) - 1:
        hi = int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(bounds) - 1)
        yield lo, hi, raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def word_spans(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word bounds per row) of the maximal runs of word bytes inside each row."""
    inside = is_word[raw]
    if not len(raw):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(bounds), dtype=np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(raw))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, from one prefix sum of weighted byte values."""
    up, down = _POWERS.upto(len(raw) + 1)
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lowered_words(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word bounds per row) after lower-casing A-Z."""
    low = LOWER[raw]
    starts, ends, per_row = word_spans(low, bounds, is_word)
    return span_hashes(low, starts, ends), per_row


def word_tails(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket number for every word after lower-casing A-Z, from its last two bytes."""
    low = LOWER[raw]
    starts, ends, _ = word_spans(low, bounds, is_word)
    last, before = low[ends - 1].astype(np.int64), low[np.maximum(ends - 2, starts)].astype(np.int64)
    return (last * 131 + before * 31) % buckets


_GRAM = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, dtype=np.uint64), dtype=np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words of one flat array (row bounds are the caller's)."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out += words[j : j + n] * _GRAM[j]
    return mix(out)
