"""Windows of a fixed length that also start in a document with a smaller id.

Shared by the two substring operators, which bring their own index (``finder``).  Units are
words or bytes; a window is ``length`` units of one document.

1. The anchor of a window is the smallest hash of its ``gram``-unit pieces, so equal
   windows have equal anchors, and neighbouring windows mostly share theirs: a document has
   far fewer anchors than windows.  Anchors found in one document only are dropped.
2. Each run of windows with a repeated anchor is cut out with its text and sent to the shard
   of its anchor.  Equal windows meet there, and nowhere else.
3. A shard's index tells for every window the smallest document it starts in; where that is
   smaller than the row's own, the window is reported as a span.  An anchor with more text
   than ``CHUNK_BYTES`` is not indexed: its windows are sent on by two 64-bit hashes of the
   whole window, and the smallest document of each is found in sorted order.

Full copies of an earlier document are settled by hash before.  What many documents share
within one slice of a partition is settled there: one row of it goes to the shard, and the
others become spans at once.  Thus a passage that a third of all documents hold reaches its
shard about once per slice.  The texts are shuffled once, by id.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm import words as W

NO_ID = (1 << 63) - 1
# Units of distinct pieces that one index is built over.
CHUNK_BYTES = 1 << 21

# finder(data, offsets, smallest document of each piece, length)
#   -> smallest document of every window, piece by piece
Finder = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


class Spec(NamedTuple):
    by_word: bool
    length: int
    gram: int
    finder: Finder


class Units(NamedTuple):
    """Byte ranges of the units of some texts; text i has units first[i]:first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def units(texts: W.Texts, by_word: bool) -> Units:
    if by_word:
        line, words = W.joined(texts, W.split(texts))
        return Units(line.data, words.start, words.end, words.first)
    at = np.arange(len(texts.data))
    return Units(texts.data, at, at + 1, texts.offsets)


def _slide(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        h = np.minimum(h[:-k], h[k:])
        k *= 2
    return h if k == width else np.minimum(h[: len(h) - (width - k)], h[width - k :])


def _runs(u: Units, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, anchor, first window and number of windows of each run of one anchor."""
    n, none = len(u.start), np.zeros(0, np.int64)
    if n < spec.length:
        return none, none.astype(np.int32), none, none
    doc = np.repeat(np.arange(len(u.first) - 1), np.diff(u.first))
    grams = W.Rolling(u.data).of(u.start[: n - spec.gram + 1], u.end[spec.gram - 1 :])
    anchor = (_slide(grams, spec.length - spec.gram + 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    inside = doc[: n - spec.length + 1] == doc[spec.length - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none.astype(np.int32), none, none
    a, d = anchor[at], doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
    head = np.flatnonzero(new)
    return d[head], a[head], at[head], np.diff(np.append(head, len(at)))


# Anchors are dealt by their lowest bits; they are minima, so the highest are mostly zero.  Those
# known to be repeated need no place of their own.
LEAD_BITS = 9
KNOWN_ROWS = 1 << 13


def _packed(lead: np.ndarray, a: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one ``lead`` (sorted) as a list each: ``width`` low bytes of ``a`` and then the bytes
    of ``doc``, all lowest bytes first.  Edges of the lists and their bytes."""
    n = len(a)
    wide = max(1, (int(doc.max(initial=0)).bit_length() + 7) // 8)
    head = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), lead[1:] != lead[:-1])))
    size = np.diff(np.append(head, n))
    place = np.arange(n) + np.repeat(head * (width + wide - 1), size)
    step = np.repeat(size, size)
    out = np.empty(n * (width + wide), np.uint8)
    for k in range(width):
        out[place + k * step] = (a >> np.uint32(8 * k)).astype(np.uint8)
    for k in range(wide):
        out[place + (width + k) * step] = (doc >> np.uint64(8 * k)).astype(np.uint8)
    return np.append(head, n), out


_PACKED = "lead int, n int, base long, packed binary"


def _packed_batch(lead, edges, base, data) -> pa.RecordBatch:
    count = np.diff(edges)
    offsets = edges * (len(data) // max(int(edges[-1]), 1))
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return pa.record_batch(
        [pa.array(lead.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(np.full(len(count), base, np.int64)), packed.cast(pa.binary())],
        ["lead", "n", "base", "packed"],
    )


def _pack_anchors(a: np.ndarray, doc: np.ndarray, known: bool):
    """Rows (lead, n, base, packed) of anchors; ``lead`` is their lowest bits, or below zero if all
    are known to be repeated."""
    if not len(a):
        return
    base = doc.min()
    u, d = a.view(np.uint32), doc.astype(np.uint64) - base.astype(np.uint64)
    if known:
        for i in range(0, len(u), KNOWN_ROWS):
            edges, data = _packed(np.zeros(len(u[i : i + KNOWN_ROWS])), u[i : i + KNOWN_ROWS], d[i : i + KNOWN_ROWS], 4)
            yield _packed_batch(-1 - (u[i : i + 1] & np.uint32(0xFFFF)).astype(np.int64), edges, base, data)
        return
    lead = (u & np.uint32((1 << LEAD_BITS) - 1)).astype(np.uint16)
    # Rows of one document side by side take less space in the shuffle.
    order = np.lexsort((d, lead))
    lead, u, d = lead[order], u[order] >> np.uint32(LEAD_BITS), d[order]
    edges, data = _packed(lead, u, d, 3)
    yield _packed_batch(lead[edges[:-1]], edges, base, data)


def _unpacked(batches):
    """(a, doc) of packed rows; known ones have a negative ``doc`` (-1 - doc)."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            out_a, out_d = [], []
            rows = zip(*(part.column(c).to_pylist() for c in ("lead", "n", "base")), part.column("packed"))
            for lead, n, base, packed in rows:
                planes = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, n)
                width = 4 if lead < 0 else 3
                a = np.zeros(n, np.uint32)
                for k in range(width):
                    a |= planes[k].astype(np.uint32) << np.uint32(8 * k)
                if lead >= 0:
                    a = a << np.uint32(LEAD_BITS) | np.uint32(lead)
                d = np.zeros(n, np.uint64)
                for k in range(len(planes) - width):
                    d |= planes[width + k].astype(np.uint64) << np.uint64(8 * k)
                d = (d + np.int64(base).astype(np.uint64)).view(np.int64)
                out_a.append(a.view(np.int32))
                out_d.append(-1 - d if lead < 0 else d)
            if out_a:
                yield pa.record_batch([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_d))], ["a", "doc"])


def _anchors(spec: Spec):
    """Packed (a, doc): different anchors of each document.

    An anchor that several documents of a slice hold is sent once as it is; for all of
    them it is known to be repeated.
    """

    def found(batches):
        for batch in batches:
            for part, texts in W.slices(batch, "text"):
                doc, anchor, _, _ = _runs(units(texts, spec.by_word), spec)
                ids = part.column("doc").to_numpy()
                key = np.unique((anchor.view(np.uint32).astype(np.uint64) << np.uint64(32)) | doc.astype(np.uint64))
                a = (key >> np.uint64(32)).astype(np.uint32).view(np.int32)
                d = ids[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                again = np.zeros(len(a), bool)
                again[1:] = a[1:] == a[:-1]
                shared = again.copy()
                shared[:-1] |= again[1:]
                # Rows of one id share its anchors, which is no repeat.
                group = np.cumsum(~again) - 1
                low, high = np.full(group[-1] + 1 if len(group) else 0, NO_ID), np.full(group[-1] + 1 if len(group) else 0, -NO_ID)
                np.minimum.at(low, group, d)
                np.maximum.at(high, group, d)
                known = shared & (low < high)[group] if len(a) else shared
                sent = np.flatnonzero(~again)
                yield from _pack_anchors(a[sent], d[sent], False)
                yield from _pack_anchors(a[known], d[known], True)

    return found


def _repeated(batches):
    """Of rows sorted by (a, doc) those whose anchor is known or seen to be repeated."""
    last_a, last_doc, told = None, None, True
    for batch in batches:
        a, d = batch.column("a").to_numpy(), batch.column("doc").to_numpy()
        known = d < 0
        out_a, out_d = [a[known]], [-1 - d[known]]
        a, d = a[~known], d[~known]
        if len(a):
            if last_a is not None:
                a, d = np.concatenate([[last_a], a]).astype(np.int32), np.concatenate([[last_doc], d])
            head = np.ones(len(a), bool)
            head[1:] = a[1:] != a[:-1]
            group = np.cumsum(head) - 1
            first = np.flatnonzero(head)
            final = np.append(first[1:], len(a)) - 1
            many = d[first] != d[final]
            if last_a is not None and told:
                # The row taken over was already given out, so its group is repeated.
                many[0] = True
            keep = many[group]
            told_now = bool(many[-1])
            if last_a is not None and told:
                keep[0] = False
            last_a, last_doc, told = int(a[-1]), int(d[-1]), told_now
            out_a.append(a[keep])
            out_d.append(d[keep])
        yield pa.record_batch([pa.array(np.concatenate(out_a).astype(np.int32)), pa.array(np.concatenate(out_d).astype(np.int64))], ["a", "doc"])


def _pieces(spec: Spec):
    """(a, doc, h, b, e, piece): runs with a repeated anchor, b and e in units.

    A piece that a smaller document of the slice holds too is a span at once: piece null.
    """
    names = ["a", "doc", "h", "b", "e", "piece"]

    def found(batches):
        for batch in batches:
            for part, texts in W.slices(batch, "text"):
                u = units(texts, spec.by_word)
                doc, anchor, at, count = _runs(u, spec)
                wanted = part.column("anchors")
                n_wanted = np.diff(wanted.offsets.to_numpy())
                mine = (np.repeat(np.arange(part.num_rows), n_wanted) << 32) | wanted.flatten().to_numpy().view(np.uint32)
                hit = np.isin((doc << 32) | anchor.view(np.uint32), mine)
                doc, anchor, at, count = doc[hit], anchor[hit], at[hit], count[hit]
                ids = part.column("doc").to_numpy()[doc]
                size = u.end[at + count + spec.length - 2] - u.start[at]
                data = u.data[W.ragged(u.start[at], size)]
                edges = np.concatenate(([0], np.cumsum(size)))
                piece = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
                low = np.zeros(0, np.int64)
                same = np.zeros(0, np.int64)
                if len(at):
                    coded = piece.dictionary_encode()
                    same = coded.indices.to_numpy()
                    low = np.full(len(coded.dictionary), NO_ID)
                    np.minimum.at(low, same, ids)
                settled = low[same] < ids
                # Of pieces of the smallest document one is sent; a repeated row of the
                # same id needs the answer for itself.
                b = at - u.first[doc]
                columns = [anchor, ids, part.column("h").to_numpy()[doc], b, b + count + spec.length - 1]
                yield pa.record_batch(
                    [*(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))),
                     pa.compute.if_else(pa.array(settled), pa.scalar(None, pa.large_binary()), piece).cast(pa.binary())],
                    names,
                )

    return found


def _merged(row: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (row, b, e) of sorted windows ``at`` of ``row``; windows that touch are one."""
    if not len(at):
        return row, at, at
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1)
    head = np.flatnonzero(new)
    final = np.append(head[1:], len(at)) - 1
    return row[head], at[head], at[final] + length


def _index(spec: Spec):
    """Spans (doc, h, b, e) of the pieces of a shard, in chunks of whole anchors.

    Of an anchor that does not fit a chunk the windows are given out, see ``_window_rows``.
    """

    def windows(table: pa.Table):
        yield from _window_rows(spec, table)

    def spans(table: pa.Table):
        table = table.combine_chunks()
        coded = table.column("piece").chunk(0).cast(pa.large_binary()).dictionary_encode()
        doc, h, b = (table.column(c).to_numpy() for c in ("doc", "h", "b"))
        which = coded.indices.to_numpy()
        low = np.full(len(coded.dictionary), NO_ID)
        np.minimum.at(low, which, doc)
        buffers = coded.dictionary.buffers()
        offsets = np.frombuffer(buffers[1], np.int64, len(low) + 1)
        data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
        firsts, count = spec.finder(data, offsets - offsets[0], low, spec.length)
        begin = np.cumsum(count) - count
        row = np.repeat(np.arange(len(doc)), count[which])
        window = W.ragged(np.zeros(len(doc), np.int64), count[which])
        hit = firsts[begin[which][row] + window] < doc[row]
        r, x, y = _merged(row[hit], window[hit], spec.length)
        yield _span_batch(doc[r], h[r], b[r] + x, b[r] + y)

    def handled(table: pa.Table, heavy: int | None):
        if table.num_rows:
            open_ = table.column("a").to_numpy() == heavy if heavy is not None else np.zeros(table.num_rows, bool)
            for mask, of in ((open_, windows), (~open_, spans)):
                if mask.any():
                    yield from of(table.filter(pa.array(mask)))

    def found(batches):
        waiting, size, heavy = [], 0, None
        for batch in batches:
            settled = batch.column("piece").is_null().to_numpy(zero_copy_only=False)
            if settled.any():
                done = batch.filter(pa.array(settled))
                yield _span_batch(*(done.column(c).to_numpy() for c in ("doc", "h", "b", "e")))
                batch = batch.filter(pa.array(~settled))
            for part, pieces in W.slices(batch, "piece", CHUNK_BYTES):
                waiting.append(part)
                size += len(pieces.data)
                if size < CHUNK_BYTES:
                    continue
                table = pa.Table.from_batches(waiting)
                anchor = table.column("a").to_numpy()
                cut = int(np.flatnonzero(anchor == anchor[-1])[0])
                rest = table.slice(cut)
                size = pa.compute.sum(pa.compute.binary_length(rest.column("piece"))).as_py()
                yield from handled(table.slice(0, cut), heavy)
                waiting = rest.to_batches()
                if size >= CHUNK_BYTES:
                    heavy = int(anchor[-1])
                if heavy == anchor[-1]:
                    yield from handled(rest, heavy)
                    waiting, size = [], 0
        if waiting:
            yield from handled(pa.Table.from_batches(waiting), heavy)

    return found


# A second hash of a window is over bytes renamed by this table.
_RENAMED = np.random.default_rng(5).permutation(256).astype(np.uint8)


def _window_rows(spec: Spec, table: pa.Table):
    """Windows of pieces as (doc, h, b, e, w1, w2), w1 and w2 hashes of the window.

    Where a smaller document of the table holds the window the row is a span: w1 null.
    """
    batch = table.combine_chunks().to_batches()[0]
    for part, texts in W.slices(batch, "piece"):
        u = units(texts, spec.by_word)
        count = np.diff(u.first) - spec.length + 1
        at = W.ragged(u.first[:-1], count)
        row = np.repeat(np.arange(part.num_rows), count)
        ends = u.end[at + spec.length - 1]
        w1, w2 = (W.Rolling(d).of(u.start[at], ends).view(np.int64) for d in (u.data, _RENAMED[u.data]))
        doc, h, b = (part.column(c).to_numpy()[row] for c in ("doc", "h", "b"))
        b = b + at - u.first[row]
        order = np.lexsort((doc, w2, w1))
        same = np.zeros(len(order), bool)
        same[1:] = (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
        least = doc[order][np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else doc
        settled = np.zeros(len(order), bool)
        settled[order] = least < doc[order]
        r, x, y = _merged(row[settled], (at - u.first[row])[settled], spec.length)
        begin = part.column("b").to_numpy()[r]
        yield _span_batch(part.column("doc").to_numpy()[r], part.column("h").to_numpy()[r], begin + x, begin + y)
        go = ~settled
        yield _span_batch(doc[go], h[go], b[go], b[go] + spec.length, w1[go], w2[go])


def _smallest(batches):
    """Spans of rows sorted by (w1, w2, doc): those of windows that a smaller document has."""
    last = None
    for batch in batches:
        opened = batch.column("w1").is_valid().to_numpy(zero_copy_only=False)
        whole = batch.filter(pa.array(~opened))
        if whole.num_rows:
            yield pa.record_batch(whole.columns[:4], whole.schema.names[:4])
        batch = batch.filter(pa.array(opened))
        if not batch.num_rows:
            continue
        doc, w1, w2 = (batch.column(c).to_numpy() for c in ("doc", "w1", "w2"))
        new = np.ones(len(doc), bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        least = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        if last is not None:
            group = np.cumsum(new) == 1
            if (w1[0], w2[0]) == last[:2]:
                least = np.where(group, last[2], least)
        last = (w1[-1], w2[-1], least[-1])
        hit = batch.filter(pa.array(least < doc))
        yield pa.record_batch(hit.columns[:4], hit.schema.names[:4])


def _span_batch(doc, h, b, e, w1=None, w2=None) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
    whole = [pa.array(np.asarray(c), t) for c, t in zip((doc, h, b, e), kinds)]
    hashes = [pa.nulls(len(whole[0]), pa.int64()) if w is None else pa.array(w, pa.int64()) for w in (w1, w2)]
    return pa.record_batch([*whole, *hashes], ["doc", "h", "b", "e", "w1", "w2"])


def _applied(spec: Spec):
    """Kept text, number of units and spans of each document."""

    def done(batches):
        for batch in batches:
            for part, texts in W.slices(batch, "text"):
                u = units(texts, spec.by_word)
                n_units = np.diff(u.first)
                copied = part.column("copied").to_numpy(zero_copy_only=False)
                listed = part.column("spans")
                flat = listed.flatten()
                per = np.diff(listed.offsets.to_numpy())
                owner = np.repeat(np.arange(part.num_rows), per)
                own_h = part.column("h").to_numpy()[owner]
                b, e, h = (flat.field(c).to_numpy() for c in ("b", "e", "h"))
                mine = h == own_h
                owner, b, e = owner[mine], b[mine].astype(np.int64), e[mine].astype(np.int64)
                whole = np.flatnonzero(copied & (n_units >= spec.length))
                change = np.zeros(len(u.start) + 1, np.int64)
                np.add.at(change, u.first[:-1][owner] + b, 1)
                np.add.at(change, u.first[:-1][owner] + e, -1)
                np.add.at(change, u.first[whole], 1)
                np.add.at(change, u.first[whole + 1], -1)
                gone = np.cumsum(change[:-1]) > 0
                yield _kept_batch(part, u, gone, spec)

    return done


def _kept_batch(part: pa.RecordBatch, u: Units, gone: np.ndarray, spec: Spec) -> pa.RecordBatch:
    doc = np.repeat(np.arange(part.num_rows), np.diff(u.first))
    stay = ~gone
    if spec.by_word:
        # Each kept word with one byte, a space, behind it; the last one of a text goes.
        size = (u.end - u.start + 1) * stay
        data = np.append(u.data, np.uint8(32))[W.ragged(u.start[stay], size[stay])]
        total = np.bincount(doc, size, part.num_rows).astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(total)))
        data[edges[1:][total > 0] - 1] = 32
        trim = np.ones(len(data), bool)
        trim[edges[1:][total > 0] - 1] = False
        data = data[trim]
        total = total - (total > 0)
    else:
        data = u.data[stay]
        total = np.bincount(doc, stay, part.num_rows).astype(np.int64)
    edges = np.concatenate(([0], np.cumsum(total)))
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    filled = u.first[:-1][u.first[1:] > u.first[:-1]]
    edge[filled] = gone[filled]
    stop = gone.copy()
    stop[:-1] &= ~gone[1:]
    last = u.first[1:][u.first[1:] > u.first[:-1]] - 1
    stop[last] = gone[last]
    b, e = np.flatnonzero(edge), np.flatnonzero(stop) + 1
    ids = part.column("doc").to_numpy()
    per = np.bincount(doc[b], minlength=part.num_rows)
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32()),
        pa.StructArray.from_arrays([pa.array((b - u.first[doc[b]]).astype(np.int32)), pa.array((e - u.first[doc[b]]).astype(np.int32))], ["b", "e"]),
    )
    return pa.record_batch(
        [pa.array(ids, mask=ids == NO_ID), pa.array(np.diff(u.first)), spans, kept.cast(pa.binary())],
        ["doc_id", "n_units", "spans", "kept"],
    )


def _two(high: str, low: str) -> Column:
    """Two ints as one long, which takes less of a shuffle."""
    return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(F.col(low).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))


def _high(col: str) -> Column:
    return F.shiftright(col, 32).cast("int")


def _low(col: str) -> Column:
    # A cast to int keeps the low 32 bits, but fails on more in ANSI mode.
    return F.shiftright(F.shiftleft(F.col(col), 32), 32).cast("int")


def remove(docs: DataFrame, spec: Spec, *, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_units, spans, kept) for every row: spans (b, e) of removed units, sorted
    and apart, and the bytes of what is left (words joined by one space).

    Null texts are empty.  A row without an id counts as later than all others (and the
    largest long is returned as no id).  Rows of
    one id are not earlier than each other.
    """
    base = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("h", F.hash("text"))
    # All three uses of the texts ask for the same columns, so they share one shuffle.
    # Texts that an earlier document has as a whole.
    seen = base.select("doc", "h", F.xxhash64("text").alias("x"), F.octet_length("text").alias("size"))
    earliest = seen.groupBy("x", "h", "size").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    copies = (
        seen.join(earliest.select("x", "h", "size", "first"), ["x", "h", "size"])
        .filter("doc > first")
        .groupBy("doc")
        .agg(F.collect_set("h").alias("copies"))
    )
    texts = (
        base.repartition("doc")
        .join(copies.hint("shuffle_hash"), "doc", "left")
        .withColumn("copied", F.coalesce(F.array_contains("copies", F.col("h")), F.lit(False)))
        .drop("copies")
    )
    firsts = texts.filter(~F.col("copied"))
    # Grouped where they are placed: lists of a few rows before the shuffle would take more of it.
    wanted = (
        firsts.select("doc", "text")
        .mapInArrow(_anchors(spec), _PACKED)
        .repartition("lead")
        .mapInArrow(_unpacked, "a int, doc long")
        .sortWithinPartitions("a", "doc")
        .mapInArrow(_repeated, "a int, doc long")
        .repartition("doc")
        .groupBy("doc")
        .agg(F.collect_list("a").alias("anchors"))
    )
    pieces = (
        firsts.join(wanted.hint("shuffle_hash"), "doc")
        .select("doc", "h", "text", "anchors")
        .mapInArrow(_pieces(spec), "a int, doc long, h int, b int, e int, piece binary")
        .select(_two("a", "h").alias("ah"), "doc", _two("b", "e").alias("be"), "piece")
    )
    a = _high("ah")
    shard = F.when(F.col("piece").isNull(), F.xxhash64("doc", "be")).otherwise(a.cast("long"))
    spans = (
        pieces.repartition(shard)
        .select(a.alias("a"), "doc", _low("ah").alias("h"), _high("be").alias("b"), _low("be").alias("e"), "piece")
        .sortWithinPartitions("a")
        .mapInArrow(_index(spec), "doc long, h int, b int, e int, w1 long, w2 long")
        .repartition(F.coalesce("w1", F.xxhash64("doc", "b")))
        .sortWithinPartitions("w1", "w2", "doc")
        .mapInArrow(_smallest, "doc long, h int, b int, e int")
        .select("doc", "h", _two("b", "e").alias("be"))
        .repartition("doc")
        .select("doc", "h", _high("be").alias("b"), _low("be").alias("e"))
        .groupBy("doc")
        .agg(F.collect_list(F.struct("h", "b", "e")).alias("spans"))
    )
    none = F.array().cast("array<struct<h:int,b:int,e:int>>")
    return (
        texts.join(spans.hint("shuffle_hash"), "doc", "left")
        .select("doc", "text", "h", "copied", F.coalesce("spans", none).alias("spans"))
        .mapInArrow(_applied(spec), "doc_id long, n_units long, spans array<struct<b:int,e:int>>, kept binary")
    )
