"""Words of an Arrow batch of texts as numpy arrays, and rolling hashes over their bytes.

Everything here works on one slice of a batch inside a task.  ``slices`` cuts batches so
that the arrays of one slice stay near ``SLICE_BYTES`` times a small factor; a single
longer text makes a slice of its own.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
# An odd multiplier has an inverse modulo 2**64, so a substring's hash can be moved to offset 0.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Texts(NamedTuple):
    """Concatenated UTF-8 bytes of some texts; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Byte ranges of the words of some texts; text i has words first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of ``batch`` with about ``limit`` bytes of ``column`` each (null is empty)."""
    values = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64, count=values.offset + n + 1)[values.offset :] if n else np.zeros(1, np.int64)
    raw = values.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and len(raw) else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = offsets[at : upto + 1]
        yield batch.slice(at, upto - at), Texts(data[part[0] : part[-1]], part - part[0])
        at = upto


def split(texts: Texts) -> Words:
    """Maximal runs of bytes other than space and 0x09 to 0x0D, never across texts."""
    d, offsets = texts
    gap = (d == 32) | ((d >= 9) & (d <= 13))
    word = ~gap
    before = np.empty(len(d), bool)
    after = np.empty(len(d), bool)
    if len(d):
        before[0], before[1:] = True, gap[:-1]
        after[-1], after[:-1] = True, gap[1:]
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        before[filled] = True
        after[filled[1:] - 1] = True
    start = np.flatnonzero(word & before)
    end = np.flatnonzero(word & after) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def joined(texts: Texts, words: Words) -> tuple[Texts, Words]:
    """The same texts with exactly one space between words and none around them."""
    d, (start, end, first) = texts.data, words
    keep = np.zeros(len(d) + 1, np.int8)
    keep[start] += 1
    keep[end] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    length = end - start
    # One byte more behind each word, but for the last word of a text.
    last = np.zeros(len(start), bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    step = length + ~last
    new_end = np.cumsum(step) - ~last
    new_start = new_end - length
    out = np.full(int(step.sum()), 32, np.uint8)
    place = np.repeat(new_start - np.concatenate(([0], np.cumsum(length)[:-1])) if len(start) else new_start, length) + np.arange(int(length.sum()))
    out[place] = d[keep]
    total = np.concatenate(([0], np.cumsum(step)))
    return Texts(out, total[first]), Words(new_start, new_end, first)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Rolling:
    """Hashes of any byte ranges of ``data`` after one pass over it."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] numbers, then those of the next, and so on."""
    total = int(count.sum())
    skip = np.cumsum(count) - count
    return np.repeat(first - skip, count) + np.arange(total)
