"""Links between the tokens of two tokenizers, counted over the corpus (operator 12).

Both tokenizers cut a text into byte ranges.  Offsets where both cut part it into groups;
every A token of a group is linked to every B token of it.  A pair counts the documents
that hold it linked.  The counting is external:

1. A task encodes slices of some megabytes of text.  Their (pair, document) records are
   dealt by the low bits of the A id, and each part becomes one sorted run of frames
   compressed with zstd.  Runs are written to the shared folder once.
2. Runs of one radix are merged, at most ``FAN_IN`` at a time, by a heap over the last keys
   of their open frames, which adds up the documents of each pair; merged runs are merged
   again until one is left per radix.  Keys are A-major, so the highest count of an A id is
   known where the merge leaves the id.
3. The merged counts meet the runs again: each run looks its pairs up and streams the
   contributions back to the documents of its slice.

A radix holds the pairs of 1/64 of the A vocabulary, so what a task holds is bounded by the
two vocabularies; runs of one radix are dealt over as many tasks as there are slices.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.words import Rolling, Texts, ragged, slices
from ebbline.session import shared_dir

SLICE_BYTES = 6 << 20
RADIX_BITS = 6
RADIXES = 1 << RADIX_BITS
FRAME = 1 << 16
FAN_IN = 64
ENCODE_BLOCK = 1 << 15
_LOW = np.uint64(0xFFFFFFFF)
_SIDE = np.uint64(32)


class Codes(NamedTuple):
    """Token ids of some texts, one after the other, and how many each text has; the bytes
    that each token stands for are ``data[start[i]:start[i + 1]]`` by id."""

    encode: Callable[[list[str]], list[list[int]]]
    data: np.ndarray
    start: np.ndarray


def _vocabulary(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    start = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum([len(t) for t in tokens], out=start[1:])
    return np.frombuffer(b"".join(tokens), np.uint8), start


def byte_level(path: str) -> Codes:
    """A byte-level BPE file of the tokenizers library, special tokens as plain text."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    # The fixed byte alphabet of byte-level files: printable bytes stand for themselves.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    tokens = [b""] * made.get_vocab_size()
    for text, i in made.get_vocab().items():
        tokens[i] = bytes(byte[c] for c in text) if all(c in byte for c in text) else text.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in made.encode_batch_fast(texts, add_special_tokens=False)]

    return Codes(encode, *_vocabulary(tokens))


def pieces(path: str) -> Codes:
    """A piece model; it puts a space in front of a text by itself, so texts come without theirs."""
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(made.get_piece_size()):
        piece = made.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if made.is_byte(i) else piece.replace("▁", " ").encode())
    if any(b" " in t.lstrip(b" ") for t in tokens):
        raise ValueError("a piece holds a space behind another character; chunks would not be independent")

    def encode(texts: list[str]) -> list[list[int]]:
        return made.encode([t[1:] for t in texts], num_threads=1)

    return Codes(encode, *_vocabulary(tokens))


def chunks(texts: Texts) -> np.ndarray:
    """Where the texts can be cut so that every chunk is encoded as it would be in its text.

    Every text starts a chunk, and so does a space between two characters that are no white
    space: both tokenizers let a token begin but never end there.  Bytes that may belong to
    a white-space character beyond ASCII count as white space.
    """
    d, offsets = texts
    n = len(d)
    cut = np.zeros(n, bool)
    if n > 4:
        plain = (d > 32) & (d < 127)
        high = d >= 128
        wide = (d == 0xC2) | ((d >= 0xE1) & (d <= 0xE3))
        at = np.arange(n)
        two, three = np.maximum(at - 2, 0), np.maximum(at - 3, 0)
        before = np.zeros(n, bool)
        # The last byte in front of a space: one of no white-space character of two or three bytes.
        before[1:] = plain[:-1]
        before |= (at > 3) & np.roll(high, 1) & ~wide[two] & ~wide[three]
        after = np.zeros(n, bool)
        after[:-1] = plain[1:] | (high[1:] & ~wide[1:])
        cut = (d == 32) & before & after
    cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(cut)


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Non-negative integers as zstd of their bytes, all lowest bytes first."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


def _frames(*columns: bytes) -> bytes:
    return b"".join(len(c).to_bytes(4, "little") + c for c in columns)


def run_of(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts as frames of at most FRAME keys."""
    out = []
    for a in range(0, len(keys), FRAME):
        k = keys[a : a + FRAME]
        steps = np.concatenate((k[:1], k[1:] - k[:-1]))
        out.append(_frames(pack(steps), pack(counts[a : a + FRAME])))
    return b"".join(out)


def frames_of(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The frames of a run, one after the other."""
    at = 0
    while at < len(run):
        columns = []
        for _ in range(2):
            size = int.from_bytes(run[at : at + 4], "little")
            columns.append(unpack(run[at + 4 : at + 4 + size]))
            at += 4 + size
        yield np.cumsum(columns[0], dtype=np.uint64), columns[1]


def merge(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in order with the sum of their counts, from all runs.

    Every run has one open frame.  The heap holds the last keys of the open frames: up to
    the smallest of them all frames are complete, so that part is added up and told, and
    the frame that it ends is followed by its run's next.
    """
    waiting = [frames_of(r) for r in runs]
    opened: list = [next(w, None) for w in waiting]
    heap = [(int(f[0][-1]), i) for i, f in enumerate(opened) if f is not None]
    heapq.heapify(heap)
    while heap:
        upto = heap[0][0]
        keys, counts = [], []
        for i, f in enumerate(opened):
            if f is None:
                continue
            n = int(np.searchsorted(f[0], np.uint64(upto), "right"))
            if n:
                keys.append(f[0][:n]), counts.append(f[1][:n])
                opened[i] = (f[0][n:], f[1][n:])
        while heap and heap[0][0] == upto:
            _, i = heapq.heappop(heap)
            opened[i] = next(waiting[i], None)
            if opened[i] is not None:
                heapq.heappush(heap, (int(opened[i][0][-1]), i))
        both, added = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(both, kind="stable")
        both, added = both[order], added[order]
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        yield both[first], np.add.reduceat(added, first)


def merged(runs: list[bytes]) -> bytes:
    """One run of all, in full frames."""
    out, keys, counts, held = [], [], [], 0
    for k, c in merge(runs):
        keys.append(k), counts.append(c)
        held += len(k)
        if held >= FRAME:
            out.append(run_of(np.concatenate(keys), np.concatenate(counts)))
            keys, counts, held = [], [], 0
    if held:
        out.append(run_of(np.concatenate(keys), np.concatenate(counts)))
    return b"".join(out)


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every key in A-major order the highest count of its A id."""
    side = keys >> _SIDE
    first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
    return np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))


def _ends(ids: np.ndarray, vocabulary: Codes) -> np.ndarray:
    """Byte offset behind each token, all chunks one after the other."""
    return np.cumsum(vocabulary.start[ids + 1] - vocabulary.start[ids])


def _encoded(codes: Codes, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each has.

    Blocks bound what the libraries hand over as Python objects.
    """
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(texts), ENCODE_BLOCK):
        lists = codes.encode(texts[i : i + ENCODE_BLOCK])
        counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids.append(np.fromiter(chain.from_iterable(lists), np.int32, int(counts[-1].sum())))
    return np.concatenate(ids).astype(np.int64), np.concatenate(counts)


def _bytes_equal(ids: np.ndarray, count: np.ndarray, codes: Codes, raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Per chunk whether the bytes of its tokens are its own."""
    size = codes.start[ids + 1] - codes.start[ids]
    total = np.concatenate(([0], np.cumsum(size)))
    ends = np.concatenate(([0], np.cumsum(count)))
    fits = (total[ends[1:]] - total[ends[:-1]]) == np.diff(edges)
    if fits.all():
        same = codes.data[ragged(codes.start[ids], size)] == raw
        bad = np.concatenate(([0], np.cumsum(~same)))
        return bad[edges[1:]] == bad[edges[:-1]]
    # Compare those of equal length alone.
    inner = np.concatenate(([0], np.cumsum(np.diff(edges)[fits])))
    fits[fits] = _bytes_equal(ids[np.repeat(fits, count)], count[fits], codes, raw[np.repeat(fits, np.diff(edges))], inner)
    return fits


class Aligned(NamedTuple):
    """What each different chunk of a slice gives."""

    good: np.ndarray  # both tokenizers give back its bytes
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    told: list[str]
    first: np.ndarray  # pairs of chunk i: pair[first[i]:first[i + 1]], each ``times`` times
    pair: np.ndarray
    times: np.ndarray


def align(parts: list[bytes], a: Codes, b: Codes) -> Aligned:
    """Tokens, groups and linked pairs of chunks, each of which begins with a space."""
    texts = [p.decode("utf-8") for p in parts]
    raw, edges = _vocabulary(parts)
    ids_a, count_a = _encoded(a, texts)
    ids_b, count_b = _encoded(b, texts)
    del texts
    good = _bytes_equal(ids_a, count_a, a, raw, edges) & _bytes_equal(ids_b, count_b, b, raw, edges)
    if not good.all():
        # Only chunks that both give back have offsets; the others are left without tokens.
        ids_a, count_a = ids_a[np.repeat(good, count_a)], np.where(good, count_a, 0)
        ids_b, count_b = ids_b[np.repeat(good, count_b)], np.where(good, count_b, 0)
    end_a, end_b = _ends(ids_a, a), _ends(ids_b, b)
    cuts = np.intersect1d(end_a, end_b, assume_unique=False)
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    # Groups never cross chunks: the end of a chunk is a cut.
    chunk_end = np.cumsum(np.where(good, np.diff(edges), 0))
    of_chunk = np.searchsorted(chunk_end, cuts)
    n_groups = np.bincount(of_chunk, minlength=len(parts))
    links = in_a * in_b
    n_links = np.bincount(of_chunk, weights=links, minlength=len(parts)).astype(np.int64)
    # The different A ids of a group with the different B ids of it, each so many times.
    left_group, left, left_times = _times(group_a, ids_a)
    right_group, right, right_times = _times(group_b, ids_b)
    width = np.bincount(right_group, minlength=len(cuts))
    reach = width[left_group]
    at = ragged((np.cumsum(width) - width)[left_group], reach)
    chunk = np.repeat(of_chunk[left_group], reach)
    pair = (np.repeat(left, reach).astype(np.uint64) << _SIDE) | right[at].astype(np.uint64)
    times = np.repeat(left_times, reach) * right_times[at]
    order = np.lexsort((pair, chunk))
    pair, chunk, times = pair[order], chunk[order], times[order]
    new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (chunk[1:] != chunk[:-1])))) if len(pair) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    pair, chunk = pair[new], chunk[new]
    return Aligned(
        good, count_a, count_b, n_groups, n_links, _told(ids_a, ids_b, in_a, in_b, n_groups), np.searchsorted(chunk, np.arange(len(parts) + 1)), pair, times
    )


def _times(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, how often) in the order of groups."""
    both, times = np.unique((group.astype(np.int64) << 32) | ids, return_counts=True)
    return both >> 32, both & 0xFFFFFFFF, times


def _told(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` of each chunk, from a block of chunks at a time."""
    out: list[str] = []
    group = np.concatenate(([0], np.cumsum(n_groups)))
    at_a, at_b = np.concatenate(([0], np.cumsum(in_a))), np.concatenate(([0], np.cumsum(in_b)))
    for first in range(0, len(n_groups), ENCODE_BLOCK):
        last = min(first + ENCODE_BLOCK, len(n_groups))
        g, h = int(group[first]), int(group[last])
        a, b = list(map(str, ids_a[at_a[g] : at_a[h]].tolist())), list(map(str, ids_b[at_b[g] : at_b[h]].tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip(in_a[g:h].tolist(), in_b[g:h].tolist()):
            if x == 1 and y == 1:
                groups.append(f"{a[i]}|{b[j]}")
            else:
                groups.append(f"{','.join(a[i : i + x])}|{','.join(b[j : j + y])}")
            i, j = i + x, j + y
        at = 0
        for n in n_groups[first:last].tolist():
            out.append(groups[at] if n == 1 else ";".join(groups[at : at + n]))
            at += n
    return out


def _different(texts: Texts, start: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different chunks, and the number of the one at each place.

    Chunks are told apart by a 64-bit hash and length first; every place is then compared
    with the bytes of its number, and a slice where any differs is compared as bytes.
    """
    d = texts.data
    end = np.append(start[1:], len(d)) if len(start) else start
    rolling = Rolling(d)
    _, first, number = np.unique(rolling.of(start, end), return_index=True, return_inverse=True)
    size = end - start
    if (size[first][number] == size).all() and (d[ragged(start[first][number], size)] == d).all():
        raw = d.tobytes()
        return [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())], number
    raw, known, numbers = d.tobytes(), {}, []
    for s, e in zip(start.tolist(), end.tolist()):
        numbers.append(known.setdefault(raw[s:e], len(known)))
    return list(known), np.array(numbers, np.int64)


class Slice(NamedTuple):
    """Counts of each text, and the (pair, text) records of all."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    pair: np.ndarray
    doc: np.ndarray
    times: np.ndarray


def _sum_by(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[edges[1:]] - total[edges[:-1]]


def align_slice(texts: Texts, a: Codes, b: Codes) -> Slice:
    """Counts and records of the texts, each of which begins with its space (or is empty)."""
    n = len(texts.offsets) - 1
    start = chunks(texts)
    parts, number = _different(texts, start)
    found = align(parts, a, b)
    edges = np.searchsorted(start, texts.offsets)
    bad = _sum_by(~found.good[number], edges) > 0
    doc = np.repeat(np.arange(n), np.diff(edges))
    counts = [np.where(bad, 0, _sum_by(x[number], edges)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
    sha, numbers = [], number.tolist()
    for i, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        told = "" if bad[i] or s == e else ";".join([found.told[c] for c in numbers[s:e]])
        sha.append(hashlib.sha256(told.encode()).hexdigest() if told else "")
    # Different chunks of each document, then their pairs, then equal pairs of a document.
    keep = ~bad[doc]
    both, seen = np.unique(number[keep].astype(np.int64) * n + doc[keep], return_counts=True)
    chunk, holder = both // max(n, 1), both % max(n, 1)
    size = found.first[chunk + 1] - found.first[chunk]
    at = ragged(found.first[chunk], size)
    pairs, number_of = np.unique(found.pair, return_inverse=True)
    key = number_of[at] * n + np.repeat(holder, size)
    times = found.times[at] * np.repeat(seen, size)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    key = key[new]
    return Slice(*counts, sha, pairs[key // max(n, 1)], key % max(n, 1), np.add.reduceat(times, new) if len(new) else times)


def _runs(found: Slice) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, run of pairs with their documents counted, documents and times by pair)."""
    radix = (found.pair >> _SIDE) & np.uint64(RADIXES - 1)
    # Records are in pair order already; a stable sort keeps it within a radix.
    order = np.argsort(radix.astype(np.uint8), kind="stable")
    edges = np.searchsorted(radix[order], np.arange(RADIXES + 1))
    for r, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if e > s:
            mine = order[s:e]
            pair = found.pair[mine]
            new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            yield r, run_of(pair[new], np.diff(np.append(new, len(pair)))), _frames(pack(found.doc[mine]), pack(found.times[mine]))


RUN = "slice string, radix int, pairs binary, docs binary"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _writer(path_a: str, path_b: str, kind: pa.DataType, slice_bytes: int):
    """Rows of runs, and one row (radix -1) of the counts of a slice's texts."""

    def written(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        a, b = byte_level(path_a), pieces(path_b)
        for batch in batches:
            for part, texts in slices(batch, "text", slice_bytes):
                name = uuid.uuid4().hex
                found = align_slice(texts, a, b)
                rows = [(r, pairs, docs) for r, pairs, docs in _runs(found)]
                n = len(rows) + 1
                one = lambda values, t: pa.array([None] * (n - 1) + [values], pa.list_(t))
                yield pa.record_batch(
                    [
                        pa.array([name] * n),
                        pa.array([r[0] for r in rows] + [-1], pa.int32()),
                        pa.array([r[1] for r in rows] + [None], pa.binary()),
                        pa.array([r[2] for r in rows] + [None], pa.binary()),
                        one(part.column("id").to_pylist(), kind),
                        *[one(getattr(found, c), pa.int64()) for c in _COUNTS],
                        one(found.sha, pa.string()),
                    ],
                    ["slice", "radix", "pairs", "docs", "ids", *_COUNTS, "sha"],
                )

    return written


def _each(batches, columns: tuple[str, ...]) -> Iterator[tuple]:
    """Rows one after the other; only one of them is copied at a time."""
    for batch in batches:
        mine = [batch.column(c) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in mine)


def _merger():
    def row(now, runs):
        return pa.record_batch([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([merged(runs)], pa.binary())], ["radix", "part", "pairs"])

    def out(batches):
        now, runs = None, []
        for radix, part, pairs in _each(batches, ("radix", "part", "pairs")):
            if (radix, part) != now:
                if runs:
                    yield row(now, runs)
                now, runs = (radix, part), []
            runs.append(pairs)
        if runs:
            yield row(now, runs)

    return out


def _contributor():
    """Per run what each document of its slice gets from it; the counts of a radix come first."""

    def told(batches):
        now, table = None, None
        for radix, part, name, pairs, docs in _each(batches, ("radix", "part", "slice", "pairs", "docs")):
            if (radix, part) != now:
                now = (radix, part)
                frames = list(frames_of(pairs))
                keys, counts = (np.concatenate([f[i] for f in frames]) for i in range(2))
                table = (keys, counts, highest(keys, counts))
                continue
            best, total = contributions(*table, pairs, docs)
            yield pa.record_batch(
                [pa.array([name]), pa.array([pack(best)], pa.binary()), pa.array([pack(total)], pa.binary())], ["slice", "best", "total"]
            )

    return told


def contributions(keys: np.ndarray, counts: np.ndarray, top: np.ndarray, pairs: bytes, docs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(links whose count is their A id's highest, counts added over links) by document of a slice."""
    size = int.from_bytes(docs[:4], "little")
    doc, times = unpack(docs[4 : 4 + size]).astype(np.int64), unpack(docs[8 + size :])
    frames = list(frames_of(pairs))
    mine, held = (np.concatenate([f[i] for f in frames]) for i in range(2))
    at = np.repeat(np.searchsorted(keys, mine), held.astype(np.int64))
    n = int(doc.max(initial=-1)) + 1
    best, total = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    order = np.argsort(doc, kind="stable")
    doc, times, at = doc[order], times[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    best[doc[new]] = np.add.reduceat(np.where(counts[at] == top[at], times, np.uint64(0)), new)
    total[doc[new]] = np.add.reduceat(counts[at] * times, new)
    return best, total


def _finisher(kind: pa.DataType):
    """Rows of the documents of each slice, with all contributions to them added up."""

    def rows_of(meta, parts):
        ids, *counts, sha = meta
        best, total = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
        for b, t in parts:
            for whole, part in ((best, unpack(b)), (total, unpack(t))):
                whole[: len(part)] += part
        return pa.record_batch(
            [
                pa.array(ids, kind),
                *[pa.array(c, pa.int64()) for c in counts],
                pa.array(best.astype(np.int64)),
                pa.array(total.astype(np.int64)),
                pa.array(sha, pa.string()),
            ],
            ["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"],
        )

    def out(batches):
        now, meta, parts = None, None, []
        for name, best, total, *rest in _each(batches, ("slice", "best", "total", "ids", *_COUNTS, "sha")):
            if name != now:
                if now is not None:
                    yield rows_of(meta, parts)
                now, meta, parts = name, rest, []
            else:
                parts.append((best, total))
        if now is not None:
            yield rows_of(meta, parts)

    return out


def alignment(
    docs: DataFrame,
    *,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    A text is encoded behind one space.  Texts that are null or empty, or that either
    tokenizer does not give back byte by byte, have no tokens: zeros and an empty digest.
    Rows that repeat an id are documents of their own, as are rows without one.  An empty
    table gives no rows.  Both files must be where every executor finds them.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    spaced = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.encode(F.concat(F.lit(" "), text), "UTF-8")).otherwise(F.lit(b""))
    rows = docs.select(F.col(id_col).alias("id"), spaced.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    arrow_kind = _arrow_type(rows.schema["id"].dataType)
    path = f"{shared_dir(spark)}/alignment-{uuid.uuid4().hex}"
    lists = ", ".join(f"{c} array<bigint>" for c in _COUNTS)
    rows.mapInArrow(_writer(byte_level_path, pieces_path, arrow_kind, slice_bytes), f"{RUN}, ids array<{kind}>, {lists}, sha array<string>").write.parquet(path)
    written = spark.read.parquet(path)
    runs, meta = written.filter("radix >= 0"), written.filter("radix < 0")
    # One number: how many slices there are, and so at most how many runs a radix has.
    parts = -(-max(1, meta.count()) // fan_in)
    dealt = lambda n: F.pmod(F.xxhash64("slice"), F.lit(n)).cast("int").alias("part")
    runs = runs.select("slice", "radix", "pairs", "docs", dealt(parts))
    counted, left = runs.select("radix", "part", "pairs"), parts
    while True:
        counted = counted.repartition("radix", "part").sortWithinPartitions("radix", "part").mapInArrow(_merger(), "radix int, part int, pairs binary")
        if left == 1:
            break
        left = -(-left // fan_in)
        counted = counted.withColumn("part", F.pmod("part", F.lit(left)))
    # The merged counts of a radix go to each of the parts that its runs are dealt over.
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    nothing = F.lit(None).cast("binary")
    tables = counted.select(F.lit("").alias("slice"), "radix", "pairs", nothing.alias("docs"), each)
    given = (
        tables.unionByName(runs)
        .repartition("radix", "part")
        .sortWithinPartitions("radix", "part", "slice")
        .mapInArrow(_contributor(), "slice string, best binary, total binary")
    )
    about = ("ids", *_COUNTS, "sha")
    unknown = [F.lit(None).cast(meta.schema[c].dataType).alias(c) for c in about]
    heads = meta.select("slice", nothing.alias("best"), nothing.alias("total"), *about, F.lit(0).alias("late"))
    done = (
        heads.unionByName(given.select("slice", "best", "total", *unknown, F.lit(1).alias("late")))
        .repartition("slice")
        .sortWithinPartitions("slice", "late")
        .mapInArrow(
            _finisher(arrow_kind),
            f"id {kind}, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string",
        )
    )
    return done.withColumnRenamed("id", "doc_id")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
