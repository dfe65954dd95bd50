"""Words of texts as numbers, for whole Arrow batches at once.

A word is ``[^\\x20\\x09-\\x0D]+``. Its number is the sum of its bytes' numbers, and a byte's number mixes what the byte
is with its place in the word: no pattern of bytes cancels out, however long the word. Two seeds give 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_PART = 1 << 20  # bytes hashed together


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for an ordered pair."""
    return mix(a * U(0xA24BAED4963EE407) + b * U(0x9FB21C651E98DF25) + U(0x2545F4914F6CDD1D))


def _tables(seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U) * U(0xC2B2AE3D27D4EB4F) + U(seed))


class Words:
    """All words of a batch of texts: where each begins and ends in the bytes, and how many each text has."""

    def __init__(self, text: pa.Array):
        n = len(text)
        wide = pa.types.is_large_string(text.type)
        offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
        data = text.buffers()[2]
        first = int(offsets[0])
        self.flat = np.frombuffer(data, np.uint8)[first : int(offsets[-1])] if data is not None else np.zeros(0, np.uint8)
        begin, end = offsets[:-1] - first, offsets[1:] - first
        black = ~((self.flat == 32) | ((self.flat - np.uint8(9)) < 5))
        opens, closes = black.copy(), black.copy()
        if len(black):
            opens[1:] &= ~black[:-1]
            closes[:-1] &= ~black[1:]
            full = end > begin
            opens[begin[full]] |= black[begin[full]]
            closes[end[full] - 1] |= black[end[full] - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        bounds = np.searchsorted(self.starts, np.r_[begin, len(self.flat)])
        self.counts = np.diff(bounds)
        if text.null_count:  # a NULL holds no bytes, but be sure of it
            missing = np.asarray(text.is_null())
            assert not self.counts[missing].any()
        self.first = bounds[:-1]

    def numbers(self, seed: int = 1, lower: bool = False) -> np.ndarray:
        """The number of each word; with ``lower`` A-Z count as a-z."""
        table = _tables(seed)
        if lower:
            table = table.copy()
            table[65:91] = table[97:123]
        out = np.zeros(len(self.starts), U)
        for low in range(0, len(self.flat), _PART):  # a word may go on in the next part
            high = min(low + _PART, len(self.flat))
            own = slice(int(np.searchsorted(self.ends, low, "right")), int(np.searchsorted(self.starts, high, "left")))
            begin, end = np.maximum(self.starts[own], low), np.minimum(self.ends[own], high)
            if not len(begin):
                continue
            size = end - begin
            first = np.cumsum(size) - size
            at = np.arange(int(size.sum())) + np.repeat(begin - first, size)
            place = (at - np.repeat(self.starts[own], size) + 1).astype(U)
            out[own] += np.add.reduceat(mix(table[self.flat[at]] ^ (place * U(0x9E3779B97F4A7C15))), first)
        length = (self.ends - self.starts).astype(U)
        return mix(out + length * U(0x9E3779B97F4A7C15))

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def rolled(numbers: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` consecutive entries, ordered; empty if there are fewer."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = numbers[:n] * U(0xC2B2AE3D27D4EB4F)
    for k in range(1, width):
        out += numbers[k : n + k]
        out *= U(0xC2B2AE3D27D4EB4F) if k % 2 else U(0x165667B19E3779F9)
        out ^= out >> U(29)
    return mix(out)


def parts(batch: pa.RecordBatch, text: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of about ``size`` bytes of text, so that memory does not follow long texts."""
    column = batch[text]
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto
