"""Substring dedup with a compressed FM-index per shard (operator 2).

The index of a shard is the Burrows-Wheeler transform of its pieces, kept as a wavelet tree
of packed bits.  All windows are streamed through it at once: backward search takes their
words from the last to the first and narrows each one's range of suffixes, which gives the
matching statistics up to the wanted length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ebbline.llm import repeats
from ebbline.llm import words as W

LENGTH = 13
GRAM = 5


class Bits:
    """Packed bits with counts per 64, for rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletTree:
    """Occurrences of a symbol in front of a place, by the bits of the symbol.

    Each level holds one bit of every symbol, the symbols stably ordered by the bits above.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for k in range(bits - 1, -1, -1):
            bit = (symbols >> k) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in front of each place."""
        begin, at = np.zeros(len(i), np.int64), i.astype(np.int64)
        for k, level, zeros in zip(range(self.bits - 1, -1, -1), self.levels, self.zeros):
            one = ((symbol >> k) & 1).astype(bool)
            ones_begin, ones_at = level.rank(begin), level.rank(at)
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
            at = np.where(one, zeros + ones_at, at - ones_at)
        return at - begin


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; zeros end pieces and differ from each other by place."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    rank = symbols + len(ends)
    rank[ends] = np.arange(len(ends))
    size = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - size] = rank[size:] + 1
        key = rank * (int(rank.max()) + 2) + later
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = s[1:] != s[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        size *= 2
        if rank[order[-1]] == n - 1 or size >= n:
            return order


class FMIndex:
    def __init__(self, symbols: np.ndarray):
        """``symbols`` are at least 1 within pieces and 0 behind each."""
        self.order = suffix_order(symbols)
        self.bwt = WaveletTree(symbols[self.order - 1], max(1, int(symbols.max()).bit_length()))
        self.start = np.concatenate(([0], np.cumsum(np.bincount(symbols))))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes after putting a symbol in front of what was found."""
        return self.start[symbol] + self.bwt.rank(symbol, lo), self.start[symbol] + self.bwt.rank(symbol, hi)

    def search(self, symbols: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with symbols[at:at + length]."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        for k in range(length - 1, -1, -1):
            lo, hi = self.extend(symbols[at + k], lo, hi)
        return lo, hi


def finder(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest document of every ``length``-word window, and windows per piece."""
    texts = W.Texts(data, offsets)
    words = W.split(texts)
    per = np.diff(words.first)
    hashes = W.Rolling(data).of(words.start, words.end)
    _, number = np.unique(hashes, return_inverse=True)
    symbols = np.zeros(len(number) + len(per), np.int64)
    place = np.arange(len(number)) + np.repeat(np.arange(len(per)), per)
    symbols[place] = number + 1
    owner = np.repeat(low, per + 1)
    index = FMIndex(symbols)
    count = per - length + 1
    at = W.ragged(words.first[:-1] + np.arange(len(per)), count)
    lo, hi = index.search(symbols, at, length)
    # Equal windows have equal ranges, and ranges of different windows are apart.
    begins, which = np.unique(lo, return_inverse=True)
    ends = np.zeros(len(begins), np.int64)
    ends[which] = hi
    docs = np.append(owner[index.order], repeats.NO_ID)
    cuts = np.stack([begins, ends], 1).ravel()
    first = np.minimum.reduceat(docs, cuts)[::2] if len(cuts) else docs[:0]
    return first[which], count


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_units, spans, kept): words without those covered by a window of
    ``length`` words that also starts in a document with a smaller id.

    Null texts have no words; see ``repeats.remove`` for null and repeated ids.
    """
    return repeats.remove(docs, repeats.Spec(True, length, gram, finder), id_col=id_col, text_col=text_col)
