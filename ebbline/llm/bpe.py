"""Byte-level BPE encoding and decoding with Spark expressions (operator 1).

Texts are split into words where they stand.  Each task then gathers slices of at most
``SLICE_WORDS`` words (one longer text is a slice of its own) and writes a slice as its
distinct words and, per row, their positions.  Distinct words of at most ``SHORT_BYTES``
bytes are merged there as the columns of a matrix, one merge of each word a step.  ``fold``
folds ranked merges over the byte array of each longer one: each step merges the pair of the
lowest rank.  The ranks are one literal, the only one that encoding has, whose size is that
of the vocabulary.  The ids of a text are those of its words.  Nothing is shuffled, counted
or collected.

Decoding looks up each id's bytes in a literal and concatenates them; a byte is there the
Latin-1 character of its value.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ebbline.llm.words import ragged

SLICE_WORDS = 1 << 20
# Words of at most this many bytes are merged side by side, so many at a time, in matrices of
# these heights.
SHORT_BYTES = 32
HEIGHTS = (4, 8, 16, SHORT_BYTES)
SHORT_BLOCK = 1 << 15
# Bits of a piece, and of a place in a word.  Words of more than NEAR_BYTES bytes are held as
# strings, the piece of rank r being the code point FIRST + r.
BITS = 18
PLACE = 6
NONE = 1 << BITS
EMPTY = 1 << 3 * BITS
NEAR_BYTES = (1 << PLACE) - 2
FIRST = 0x20000
MOST = NONE - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file of lines "base64 rank"; read on the driver, from the installed package."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two pieces that merging by rank leaves before ``token`` is whole."""
    p = [token[i : i + 1] for i in range(len(token))]
    while len(p) > 2:
        rank, at = min((ranks.get(p[i] + p[i + 1], len(ranks) << 8), i) for i in range(len(p) - 1))
        if rank >= ranks[token]:
            return None
        p[at : at + 2] = [p[at] + p[at + 1]]
    return p[0], p[1]


def _prime(n: int) -> int:
    """The smallest prime of at least ``n``."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _rank_map(merges: dict[int, int]) -> tuple[list[int], int, int]:
    """Entries ``pair << BITS | merged``, each at one of two places: its pair modulo two primes.

    An entry without a place takes another's, which then moves to its other place.
    """
    first = _prime(5 * len(merges) // 2 + 2)
    while True:
        second = _prime(first + 1)
        table = [EMPTY] * second
        for pair in merges:
            entry, at = pair << BITS | merges[pair], pair % first
            for _ in range(500):
                table[at], entry = entry, table[at]
                if entry == EMPTY:
                    break
                at = (entry >> BITS) % (second if at == (entry >> BITS) % first else first)
            else:
                break
        else:
            return table, first, second
        first = _prime(2 * first)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once.

    Taking the element of a transformed array would work out the type of all of ``then`` anew
    for each value; folding nothing does not.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, then)


class Merges(NamedTuple):
    """The rank map, and the id of each byte; ``end`` is no piece and merges with none."""

    table: np.ndarray
    first: int
    second: int
    byte: np.ndarray
    end: int

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What the pieces merge to, NONE if they do not; see ``Codec._merged``."""
        pair = a.astype(np.int64) << BITS | b
        left = [self.table[pair % p] ^ (pair << BITS) for p in (self.first, self.second)]
        return np.minimum(np.minimum(*left), NONE).astype(np.int32)


def _merged_columns(pieces: np.ndarray, merges: Merges) -> np.ndarray:
    """The ids of words that stand as columns of bytes' ids, with ``end`` below them.

    A step merges the first pair of the lowest rank of each word; only its neighbours change.
    """
    done = pieces.copy()
    column = np.arange(pieces.shape[1])
    place = np.arange(len(pieces), dtype=np.int32)[:, None]
    ranks = merges.of(pieces[:-1], pieces[1:])
    while True:
        least = (ranks << PLACE | place[:-1]).min(axis=0)
        open_ = least < NONE << PLACE
        if not open_.all():
            done[:, column[~open_]] = pieces[:, ~open_]
            pieces, ranks, column, least = pieces[:, open_], ranks[:, open_], column[open_], least[open_]
        if not len(column):
            return done
        at = least & ((1 << PLACE) - 1)
        mine = np.arange(len(column))
        pieces[:-1] = np.where(place[:-1] > at, pieces[1:], pieces[:-1])
        pieces[-1] = merges.end
        pieces[at, mine] = least >> PLACE
        ranks[:-1] = np.where(place[:-2] > at, ranks[1:], ranks[:-1])
        ranks[-1] = NONE
        # The last place never begins a pair after a merge.
        here = np.minimum(at, len(ranks) - 1)
        ranks[here, mine] = merges.of(pieces[here, mine], pieces[here + 1, mine])
        before = np.maximum(at - 1, 0)
        ranks[before, mine] = merges.of(pieces[before, mine], pieces[before + 1, mine])


def short_ids(words: pa.Array, merges: Merges) -> pa.Array:
    """Ids of each word of 1 to SHORT_BYTES bytes, null for the others."""
    held = words.cast(pa.large_binary())
    n = len(held)
    offsets = np.frombuffer(held.buffers()[1], np.int64, held.offset + n + 1)[held.offset :] if n else np.zeros(1, np.int64)
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8) if n else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    short = (size > 0) & (size <= SHORT_BYTES)
    counts, parts = np.zeros(n, np.int64), []
    low = 0
    for height in HEIGHTS:
        of_height = np.flatnonzero(short & (size > low) & (size <= height))
        low = height
        for i in range(0, len(of_height), SHORT_BLOCK):
            block = of_height[i : i + SHORT_BLOCK]
            at = np.arange(height)[:, None]
            there = at < size[block]
            # One row more, so that every piece has a next one.
            pieces = np.full((height + 1, len(block)), merges.end, np.int32)
            pieces[:-1][there] = merges.byte[data[(offsets[block] + at)[there]]]
            ids = _merged_columns(pieces, merges).T
            is_piece = ids != merges.end
            counts[block] = is_piece.sum(axis=1)
            parts.append((block, ids[is_piece]))
    ends = np.concatenate(([0], np.cumsum(counts)))
    flat = np.empty(ends[-1], np.int32)
    for block, ids in parts:
        flat[ragged(ends[block], counts[block])] = ids
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
    return pc.if_else(pa.array(short), lists, pa.scalar(None, lists.type))


def _slices(columns: list[str], most: int, merges: Merges, fields: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows with a list ``_words`` to slices (words, short, rows with the list ``_at``).

    ``short`` are the ids of words that are short; a word is null where they stand.
    """

    def told(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        lists = table["_words"].combine_chunks()
        coded = pc.dictionary_encode(lists.flatten())
        at = pa.ListArray.from_arrays(pc.subtract(lists.offsets, lists.offsets[0]), coded.indices)
        kept = [table[c].combine_chunks() for c in columns]
        rows = pa.StructArray.from_arrays([*kept, at], [*columns, "_at"])
        short = short_ids(coded.dictionary, merges)
        words = pc.if_else(short.is_null(), coded.dictionary, pa.scalar(None, coded.dictionary.type))
        one = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (words, short, rows)]
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(one, fields)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sizes = pc.list_value_length(batch["_words"]).to_pylist()
            start = 0
            for i, n in enumerate(sizes):
                # An empty text counts as a word, so that rows are bounded too.
                if size and size + n + 1 > most:
                    yield told([*held, batch.slice(start, i - start)])
                    held, size, start = [], 0, i
                size += n + 1
            if start < len(sizes):
                held.append(batch.slice(start))
        if held:
            yield told(held)

    return run


class Codec:
    """Literals of one vocabulary; ``pattern`` splits texts into words.

    Java's regex engine reads the pattern, with Unicode classes.  A vocabulary has all 256
    bytes, and each longer token is the merge of two tokens of lower rank, as training by
    pair counts gives it; anything else is refused, as are more than ``MOST`` tokens.  A
    merge then never makes a pair of lower rank than its own, so that all pairs of one rank
    can be merged in one step.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.size = len(ranks)
        if sorted(ranks.values()) != list(range(self.size)) or self.size > MOST:
            raise ValueError(f"ranks are not 0, 1, 2, ... below {MOST}")
        pieces = [""] * self.size
        merges = {}
        for token, rank in ranks.items():
            pieces[rank] = token.decode("latin-1")
            if len(token) > 1:
                pair = _last_merge(token, ranks)
                if pair is None:
                    raise ValueError(f"no two tokens of lower rank merge to {token!r}")
                merges[ranks[pair[0]] << BITS | ranks[pair[1]]] = rank
        self.pattern = f"(?U){pattern}"
        table, self.first, self.second = _rank_map(merges)
        byte = [ranks[bytes([b])] for b in range(256)]
        self.short = Merges(np.array(table, np.int64), self.first, self.second, np.array(byte, np.int32), self.size)
        self.merges = F.from_json(F.lit(json.dumps(table)), "array<bigint>")
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
        self.bytes = F.from_json(F.lit(json.dumps(byte)), "array<bigint>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def _merged(self, pair: Column, merges: Column) -> Column:
        """The piece that two pieces ``a << BITS | b`` merge to, NONE if they do not.

        The entry of this pair leaves the merged piece when the pair is taken off by
        exclusive or; any other entry leaves more.
        """
        left = [F.get(merges, pair % p).bitwiseXOR(F.shiftleft(pair, BITS)) for p in (self.first, self.second)]
        return F.least(*left, F.lit(NONE).cast("bigint"))

    def _fold_near(self, start: Column, merges: Column) -> Column:
        """State: a number for each piece, of what it and the next merge to, itself, and zero bits.

        With its place in the zero bits the least number tells where it stands.  A step merges
        the first pair of the lowest rank; only its neighbours change.  An end of the word is
        a piece too; the first becomes -1 when nothing is left to merge.
        """
        end = F.lit((NONE << BITS | self.size) << PLACE)

        def piece(e: Column) -> Column:
            return F.shiftright(e, PLACE).bitwiseAND(F.lit(NONE - 1))

        def numbers(a: Column, b: Column) -> Column:
            pairs = F.zip_with(a, b, lambda a, b: F.shiftleft(a, BITS).bitwiseOR(b))
            return F.transform(
                pairs, lambda p: F.shiftleft(F.shiftleft(self._merged(p, merges), BITS).bitwiseOR(F.shiftright(p, BITS)), PLACE)
            )

        def rest(s: Column, n: Column) -> Column:
            return F.slice(s, n, F.size(s))

        def merge(s: Column, low: Column) -> Column:
            def at(i: Column) -> Column:
                to = F.shiftright(low, BITS + PLACE)
                new = numbers(F.array(piece(F.get(s, i - 1)), to), F.array(to, piece(F.get(s, i + 2))))
                return F.flatten(F.array(F.slice(s, F.lit(1), i - 1), new, rest(s, i + 3)))

            place = low.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")
            done = F.flatten(F.array(F.array(F.lit(-1).cast("bigint")), rest(s, F.lit(2))))
            return F.when(low < F.lit(NONE << BITS + PLACE), let(place, at)).otherwise(done)

        def step(s: Column, _: Column) -> Column:
            least = F.array_min(F.transform(s, lambda e, i: e.bitwiseOR(i.cast("bigint"))))
            return F.when(F.get(s, F.lit(0)) < 0, s).otherwise(let(least, lambda low: merge(s, low)))

        def ids(s: Column) -> Column:
            return F.transform(F.slice(s, F.lit(2), F.size(s) - 2), lambda e: piece(e).cast("int"))

        edge = F.array(F.lit(self.size).cast("bigint"))
        pairs = numbers(F.concat(edge, start), F.concat(start, edge))
        return F.aggregate(F.sequence(F.lit(1), F.size(start)), F.concat(pairs, F.array(end)), step, ids)

    def _fold_far(self, start: Column, merges: Column) -> Column:
        """State: the pieces as characters and whether a pair can still merge.

        A step merges the pair of the lowest rank wherever it stands, from left to right.
        """

        def char(piece: Column) -> Column:
            return F.decode(F.unhex(F.lpad(F.hex(piece + FIRST), 8, "0")), "UTF-32")

        def piece(c: Column) -> Column:
            return (F.ascii(c) - FIRST).cast("bigint")

        def pair(a: Column, b: Column) -> Column:
            merged = self._merged(F.shiftleft(piece(a), BITS).bitwiseOR(piece(b)), merges)
            return let(merged, lambda m: F.when(m < NONE, F.struct(m.alias("to"), F.concat(a, b).alias("pair"))))

        def step(state: Column, _: Column) -> Column:
            s = state["s"]
            stop = F.struct(s.alias("s"), F.lit(False).alias("more"))
            pairs = let(F.split(s, ""), lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), pair))

            def merge(low: Column) -> Column:
                return F.struct(F.replace(s, low["pair"], char(low["to"])).alias("s"), F.lit(True).alias("more"))

            found = let(F.array_min(pairs), lambda low: F.when(low.isNull(), stop).otherwise(merge(low)))
            return F.when(state["more"], found).otherwise(state)

        text = F.array_join(F.transform(start, char), "")
        steps = F.sequence(F.lit(1), F.greatest(F.size(start) - 1, F.lit(1)))
        zero = F.struct(text.alias("s"), F.lit(True).alias("more"))
        return F.aggregate(steps, zero, step, lambda state: F.transform(F.split(state["s"], ""), lambda c: piece(c).cast("int")))

    def fold(self, word: Column, merges: Column) -> Column:
        """Ids of a word that is not empty, as an array of integers."""
        latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        start = let(self.bytes, lambda ids: F.transform(F.split(latin, ""), lambda c: F.get(ids, F.ascii(c))))
        near = let(start, lambda p: self._fold_near(p, merges))
        far = let(start, lambda p: self._fold_far(p, merges))
        return F.when(F.octet_length(word) <= NEAR_BYTES, near).otherwise(far)

    def folded(self, words: Column, short: Column) -> Column:
        """Ids of each of an array of words, ``short`` where they are known."""
        return let(self.merges, lambda m: F.zip_with(short, words, lambda ids, w: F.coalesce(ids, self.fold(w, m))))

    def encoded(
        self, rows: DataFrame, text_col: str, ids_col: str, *, slice_words: int = SLICE_WORDS, keep_text: bool = True
    ) -> DataFrame:
        """``rows`` with the ids of a text column as an array of integers; null texts have null.

        Without ``keep_text`` the texts come back empty, and slices hold their words only.
        """
        words = F.coalesce(self.words(F.col(text_col)), F.array().cast("array<string>"))
        split = rows.withColumn("_words", words)
        if not keep_text:
            split = split.withColumn(text_col, F.when(F.col(text_col).isNotNull(), ""))
        row = T.StructType([*rows.schema.fields, T.StructField("_at", T.ArrayType(T.IntegerType()))])
        ids = T.ArrayType(T.ArrayType(T.IntegerType()))
        out = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("short", ids), T.StructField("rows", T.ArrayType(row))])
        slices = split.mapInArrow(_slices(rows.columns, slice_words, self.short, to_arrow_schema(out)), out)

        def ids_of(row: Column, ids: Column) -> Column:
            found = F.flatten(F.transform(row["_at"], lambda at: F.get(ids, at)))
            return F.struct(*[row[c].alias(c) for c in rows.columns], F.when(row[text_col].isNotNull(), found).alias(ids_col))

        return slices.select(F.inline(let(self.folded(F.col("words"), F.col("short")), lambda ids: F.transform("rows", lambda r: ids_of(r, ids)))))

    def decode(self, ids: Column) -> Column:
        """The bytes of an array of ids; null if an id is not in the vocabulary."""
        held = let(self.pieces, lambda p: F.transform(ids, lambda i: F.get(p, i)))
        known = (F.size(ids) == 0) | ((F.array_min(ids) >= 0) & (F.array_max(ids) < self.size))
        return F.when(known, F.encode(F.array_join(held, ""), "ISO-8859-1"))


def encode_decode(docs: DataFrame, codec: Codec, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row: the ids of the text and the bytes they decode to.

    Null texts count as empty and have no ids.  Null and repeated ids keep their rows.
    The cost of a word of more than ``NEAR_BYTES`` bytes grows with its number of different
    merges times its length.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return codec.encoded(texts, "text", "ids", keep_text=False).select("doc_id", "ids", codec.decode(F.col("ids")).alias("decoded"))
