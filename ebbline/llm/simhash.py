"""SimHash near-duplicates by multi-index hashing (operator 9).

A fingerprint has one bit per position that more than half of the XXH64 hashes of the
text's 3-word shingles set.  Two fingerprints that differ in at most ``distance`` bits
agree, in at least one of ``segments`` segments, up to ``distance // segments`` bits.  So
each fingerprint is entered once per segment under the segment's value, and looks up the
small Hamming ball around its own value; what it meets is verified over all 64 bits.
Equal fingerprints are one entry, whatever the number of documents.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.graph import components
from ebbline.session import freeze

BITS = 64
SEED = 42
BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of one text; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = end - np.fromiter(map(len, words), np.int64, len(words))
    width = min(width, len(words))
    start, end = start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(start), BLOCK):
        part = zip(start[at : at + BLOCK], end[at : at + BLOCK])
        h = np.array([digest(line[a:b], SEED) for a, b in part], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fingerprint) for every row; A-Z count as a-z, words end at white space.

    Null and empty texts, and texts of white space only, have fingerprint 0.  Null ids and
    repeated ids keep their rows.
    """

    def hashed(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", width) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, fingerprint long")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    edges = [BITS * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _value(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1) if width < 64 else F.lit(-1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ball(k: int, value: Column, width: int, radius: int) -> Column:
    """What a fingerprint looks up in segment ``k``: values at most ``radius`` bits away."""
    flips = [c for r in range(radius + 1) for c in combinations(range(width), r)]
    masks = F.array(*[
        F.struct(F.lit(_signed(sum(1 << b for b in c))).cast("long").alias("mask"), F.lit(_signed(1 << c[0]) if c else 0).cast("long").alias("low"))
        for c in flips
    ])
    masks = F.filter(masks, lambda m: value.bitwiseAND(m["low"]) == 0)
    return F.transform(
        masks,
        lambda m: F.struct(F.lit(k).alias("k"), value.bitwiseXOR(m["mask"]).alias("at"), (m["mask"] == 0).alias("same")),
    )


def links(prints: DataFrame, *, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (u, v) of different values of ``fingerprint`` at most ``distance`` bits apart.

    A pair that several segments find comes several times.  Of two values whose segments
    differ, only the one with a zero at the lowest differing bit looks the other up.
    """
    fp = F.col("fp")
    distinct = prints.select(F.col("fingerprint").alias("fp")).distinct()
    entries, probes = [], []
    for k, (shift, width) in enumerate(_segments(segments)):
        value = _value(fp, shift, width)
        entries.append(F.struct(F.lit(k).alias("k"), value.alias("at")))
        probes.append(_ball(k, value, width, distance // segments))
    table = distinct.select(fp.alias("v"), F.explode(F.array(*entries)).alias("e")).select("v", "e.k", "e.at")
    probe = distinct.select(fp.alias("u"), F.explode(F.concat(*probes)).alias("e")).select("u", "e.k", "e.at", "e.same")
    return (
        probe.join(table, ["k", "at"])
        .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)
        .filter((F.col("u") < F.col("v")) | (~F.col("same") & (F.col("u") != F.col("v"))))
        .select("u", "v")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = 3,
    segments: int = 2,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, links) for every row of ``docs``.

    Two documents are linked when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest id reachable over links, the document's own included.
    ``links`` counts the other fingerprints within that distance.  Rows with a null id keep
    a row and never give a component its id (null where no id can be reached).  An empty
    table gives an empty result.
    """
    prints = freeze(fingerprints(docs, id_col=id_col, text_col=text_col, width=width))
    pairs = freeze(links(prints, distance=distance, segments=segments).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    roots = components(pairs)
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    classes = (
        prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first"))
        .join(roots, "node", "left")
        .join(ends, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "root").select(F.col("node").alias("fingerprint"), "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id", "links")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
