"""Suffix-array dedup by bucket-pointer refinement (operator 6).

A shard sorts the suffixes of its pieces into buckets by their first ``Q`` bytes.  Each
suffix keeps a pointer to its bucket, and each bucket the number of bytes its suffixes
share.  A bucket is refined by sorting its suffixes on the pointers of the offset that they
share, and the parts are refined in turn until they share ``length`` bytes; a part of one
suffix is done at once.  Pointers are updated after every refinement, so a bucket that is
refined later sorts on the finer pointers of those before it and advances by all the bytes
that they share.  Neighbours in the sorted order are then compared byte by byte.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ebbline.llm import repeats
from ebbline.llm.words import ragged

LENGTH = 50
GRAM = 16
Q = 8
# Suffixes of the first buckets that are refined together, whole buckets at a time.
BLOCK = 1 << 16


def grams(data: np.ndarray, q: int, behind: int) -> np.ndarray:
    """The first ``q`` bytes of every suffix as one number, and of ``behind`` empty suffixes;
    bytes behind the end count as zero."""
    padded = np.concatenate([data, np.zeros(behind + q, np.uint8)])
    key = np.zeros(len(data) + behind, np.uint64)
    for k in range(q):
        key = (key << np.uint64(8)) | padded[k : k + len(key)].astype(np.uint64)
    return key


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where rows sorted by ``keys`` begin a new group."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _blocks(places: np.ndarray, bucket: np.ndarray) -> list[np.ndarray]:
    """``places`` cut between buckets, into blocks of about BLOCK."""
    head = _heads(bucket) if len(places) else places
    cuts = head[np.unique(head // BLOCK, return_index=True)[1]][1:]
    return [b for b in np.split(places, cuts) if len(b)]


class Buckets:
    """The suffixes in sorted order, the pointer of each to the first place of its bucket,
    and by that place the number of bytes that a bucket's suffixes share."""

    def __init__(self, key: np.ndarray, q: int) -> None:
        # Half the width of places halves what random access reads; a text has fewer bytes.
        self.order = np.argsort(key).astype(np.int32)
        head = _heads(key[self.order])
        size = np.diff(np.append(head, len(key)))
        self.pointer = np.empty(len(key), np.int32)
        self.pointer[self.order] = np.repeat(head.astype(np.int32), size)
        self.shared = np.full(len(key), q, np.int32)
        self.tied = np.flatnonzero(np.repeat(size > 1, size))

    def refine(self, places: np.ndarray, length: int) -> np.ndarray:
        """Split the whole buckets at ``places``; the places of parts that are still tied."""
        n = len(self.order)
        suffix = self.order[places]
        bucket = self.pointer[suffix]
        # All suffixes that begin behind the text are equal: the last stands for them.
        later = self.pointer[np.minimum(suffix + self.shared[bucket], n - 1)]
        order = np.argsort(bucket.astype(np.int64) * n + later)
        suffix, later = suffix[order], later[order]
        head = _heads(bucket, later)
        size = np.diff(np.append(head, len(places)))
        shared = self.shared[bucket[head]] + self.shared[later[head]]
        self.order[places] = suffix
        self.pointer[suffix] = np.repeat(places[head].astype(np.int32), size)
        self.shared[places[head]] = shared
        return places[np.repeat((size > 1) & (shared < length), size)]


def suffix_order(key: np.ndarray, q: int, length: int) -> np.ndarray:
    """The suffixes of ``key`` (see ``grams``) in the order of at least ``length`` bytes."""
    buckets = Buckets(key, q)
    waiting = _blocks(buckets.tied, buckets.pointer[buckets.order[buckets.tied]])[::-1] if q < length else []
    while waiting:
        tied = buckets.refine(waiting.pop(), length)
        if len(tied):
            waiting.append(tied)
    return buckets.order


def finder(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest document of every ``length``-byte window, and windows per piece."""
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    at = ragged(offsets[:-1], count)
    if not len(at):
        return np.zeros(0, np.int64), count
    q = min(Q, length)
    key = grams(data, q, length)
    # Windows do not cross pieces; of the other suffixes only the pointers were needed.
    owner = np.full(len(key), -1, np.int32)
    owner[at] = np.repeat(np.arange(len(count), dtype=np.int32), count)
    order = suffix_order(key, q, length)
    order = order[owner[order] >= 0]
    same = np.arange(1, len(order))
    for k in [*range(0, length - q, q), length - q]:
        same = same[key[order[same] + k] == key[order[same - 1] + k]]
    new = np.ones(len(order), bool)
    new[same] = False
    head = np.flatnonzero(new)
    least = np.minimum.reduceat(low[owner[order]], head)
    first = np.empty(len(key), np.int64)
    first[order] = np.repeat(least, np.diff(np.append(head, len(order))))
    return first[at], count


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_units, spans, kept): texts as UTF-8 bytes without those covered by a
    ``length``-byte string that also starts in a document with a smaller id.

    Null texts are empty; see ``repeats.remove`` for null and repeated ids.
    """
    return repeats.remove(docs, repeats.Spec(False, length, gram, finder), id_col=id_col, text_col=text_col)
