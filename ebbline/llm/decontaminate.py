"""Benchmark decontamination by winnowing (operator 7), in DataFrame functions only.

Of every ``SPAN - GRAM + 1`` neighbouring hashes of ``GRAM`` words the smallest is kept, in
documents and in benchmark items alike.  A shared span of ``SPAN`` words contains the same
hashes on both sides, so it shares a kept hash at the same distance from its start.  Equal
kept hashes give (text, item, offset); the words along that offset are then compared and
every run of at least ``SPAN`` equal words, or of the whole of a shorter item, is a hit.

Words have A-Z lower-cased only, for hashes and for what is compared afterwards: other
letters, such as a capital sigma, lower-case differently by what follows them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 10
GRAM = 5
# Fingerprints of this many item positions, 16 bytes each, may be broadcast.
BROADCAST_ROWS = 1 << 20
# Fixed by the definition of a word; the second takes texts whose A-Z is not yet lowered.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def plain_words(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(WORD), F.lit(0))


def _hashes(text: Column) -> Column:
    return F.transform(plain_words(text), lambda w: F.xxhash64(w))


def _grams(words: Column, n: int) -> Column:
    """Hash of the ``n`` words from each position on."""
    last = F.size(words) - n
    grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(last >= 0, grams).otherwise(F.array().cast("array<bigint>"))


def _winnowed(words: Column) -> Column:
    """Array of (h, at): hashes that are the smallest of some window, ties included.

    A window's minimum stands at p when the largest of the minima of all windows over p
    is the hash at p.
    """
    w = SPAN - GRAM + 1

    def minima(h: Column) -> Column:
        last = F.size(h) - w
        least = F.transform(F.sequence(F.lit(0), last), lambda i: F.least(*[F.get(h, i + k) for k in range(w)]))
        return F.when(last >= 0, least).otherwise(F.array().cast("array<bigint>"))

    def kept(h: Column, m: Column) -> Column:
        # Positions outside the array are null, which greatest() leaves out.
        marked = F.transform(
            h,
            lambda x, i: F.when(x == F.greatest(*[F.get(m, i - k) for k in range(w)]), F.struct(x.alias("h"), i.alias("at"))),
        )
        return F.filter(marked, lambda s: s.isNotNull())

    return let(_grams(words, GRAM), lambda h: let(minima(h), lambda m: kept(h, m)))


def _short(words: Column, n: int) -> Column:
    """Array of (h, at) of every ``n`` words; h is apart from that of other lengths."""
    return F.transform(_grams(words, n), lambda h, i: F.struct(h.bitwiseXOR(F.lit(n).cast("bigint")).alias("h"), i.alias("at")))


def _marks(text: Column, lengths: list[int]) -> Column:
    """Array of (h, at): kept hashes and every window of the lengths of short items.

    The words are split and hashed once for all of them.
    """
    return let(_hashes(text), lambda words: F.concat(_winnowed(words), *[_short(words, n) for n in lengths]))


def _bounded(items: DataFrame) -> DataFrame:
    """Broadcast what has been counted to be small; leave the rest to the planner."""
    return F.broadcast(items) if items.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else items


def _candidates(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item, offset) for all kept hashes that texts and items share."""
    size = F.size(plain_words(F.col("text")))
    sized = items.withColumn("n", size).filter("n > 0")
    # Shorter items are one window each; at most SPAN - 1 lengths come to the driver.
    lengths = sorted(n for (n,) in sized.filter(F.col("n") < SPAN).select("n").distinct().collect())
    whole = F.array().cast("array<struct<h:bigint,at:int>>")
    for n in lengths:
        whole = F.when(F.col("n") == n, _short(_hashes(F.col("text")), n)).otherwise(whole)
    marks = F.when(F.col("n") >= SPAN, _winnowed(_hashes(F.col("text")))).otherwise(whole)
    wanted = sized.select("item", F.inline(marks)).withColumnRenamed("at", "item_at")
    found = texts.select("key", F.inline(_marks(F.col("text"), lengths)))
    return found.join(_bounded(wanted), "h").select("key", "item", (F.col("at") - F.col("item_at")).alias("offset")).distinct()


def _runs(words: Column, item: Column, offset: Column) -> Column:
    """Array of (b, e): word ranges of the text that windows of the item cover."""
    need = F.least(F.lit(SPAN), F.size(item))

    def step(s: Column, i: Column) -> Column:
        # get() gives null outside the text; i runs one past the item to close the last run.
        same = F.coalesce((i < F.size(item)) & (F.get(words, offset + i) == F.get(item, i)) & (offset + i >= 0), F.lit(False))
        done = F.when(
            s["run"] >= need, F.concat(s["out"], F.array(F.struct((offset + i - s["run"]).alias("b"), (offset + i).alias("e"))))
        ).otherwise(s["out"])
        return F.when(same, F.struct((s["run"] + 1).alias("run"), s["out"].alias("out"))).otherwise(
            F.struct(F.lit(0).alias("run"), done.alias("out"))
        )

    start = F.struct(F.lit(0).alias("run"), F.array().cast("array<struct<b:int,e:int>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item)), start, step, lambda s: s["out"])


def hits(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(key, words, ranges, n_hit, items) for every different text with a hit.

    ``key`` is ``text_key`` of the text, so copies are compared once.  ``ranges`` are word
    ranges (b, e) that windows cover, sorted, possibly overlapping; ``n_hit`` counts the
    words in them, ``items`` are the ids of items with an occurring window as strings,
    sorted; ``words`` are the text's words.  An item whose id is null has the id "".
    """
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    items = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    ).filter("text <> ''").distinct()
    items = items.select("item_id", "text", F.struct("item_id", "text").alias("item"))
    found = _candidates(texts, items)
    placed = (
        found.groupBy("key")
        .agg(F.collect_list(F.struct("item", "offset")).alias("found"))
        .join(texts, "key")
        .dropDuplicates(["key"])
    )

    def against(words: Column) -> Column:
        """One struct of the words and the items with ranges, none without any."""
        ranged = F.transform(
            "found",
            lambda f: F.struct(
                f["item"]["item_id"].alias("item_id"),
                let(plain_words(f["item"]["text"]), lambda item: _runs(words, item, f["offset"])).alias("ranges"),
            ),
        )
        hit = F.struct(words.alias("words"), F.filter(ranged, lambda f: F.size(f["ranges"]) > 0).alias("found"))
        return F.filter(F.array(hit), lambda h: F.size(h["found"]) > 0)

    # A generator takes its input once; a filter would be pushed below it and take it again.
    compared = placed.select("key", F.inline(let(plain_words(F.col("text")), against)))
    at = F.flatten(F.transform("ranges", lambda r: F.sequence(r["b"], r["e"] - 1)))
    return (
        compared.withColumn("ranges", F.array_sort(F.array_distinct(F.flatten("found.ranges"))))
        .withColumn("n_hit", F.size(F.array_distinct(at)).cast("long"))
        .select("key", "words", "ranges", "n_hit", F.array_sort(F.array_distinct("found.item_id")).alias("items"))
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of ``docs``.

    Null texts have no words; null and repeated ids keep their rows; items without words
    are ignored.  Two items with one id count as one.
    """
    found = hits(docs, items, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words")
    )
    return rows.join(found.select("key", "n_hit", "items"), "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
