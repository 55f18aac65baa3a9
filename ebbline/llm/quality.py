"""Quality classifier: Naive Bayes support vectors (operator 5).

N-gram indicators are scaled by the log-count ratio of the two classes; a linear hinge-loss
model over them is fitted by dual coordinate descent (Wang and Manning, 2012; Hsieh et al.,
2008), and its margin is turned into a probability on held-back folds.  Only the text is an
input.  Training uses at most ``train_rows`` labelled rows, drawn by a hash of the id; the
scored table has no bound.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ebbline.llm import words as W

HASH_BITS = 18
TRAIN_ROWS = 8_000
FOLDS = 3


class Model(NamedTuple):
    """Probability of label 1 = 1 / (1 + exp(-(slope * margin + shift)))."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float


def _byte_classes() -> np.ndarray:
    """Letters by case, digits and bytes above ASCII as one class each; the rest as they are."""
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = ord("a")
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("0") : ord("9") + 1] = ord("0")
    kind[128:] = ord("a")
    return kind


def _shapes(texts: W.Texts, words: W.Words) -> np.ndarray:
    """One hash per word of its byte classes with runs written once."""
    kind = _byte_classes()[texts.data]
    keep = np.zeros(len(kind) + 1, np.int8)
    keep[words.start] += 1
    keep[words.end] -= 1
    inside = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[words.start] = True
    kept = inside & new
    at = np.concatenate(([0], np.cumsum(kept)))
    return W.Rolling(kind[kept]).of(at[words.start], at[words.end])


def features(texts: W.Texts, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram indicators as (text number, feature number), sorted.

    Words one and two at a time, word shapes one to three at a time, and for each word
    whether one of the three words before it was the same.
    """
    words = W.split(texts)
    n = len(words.start)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    place = np.arange(n) - words.first[:-1][doc] if n else np.zeros(0, np.int64)
    h = W.Rolling(texts.data).of(words.start, words.end)
    s = _shapes(texts, words)
    again = np.zeros(n, np.uint64)
    for back in (3, 2, 1):
        same = (place[back:] >= back) & (h[back:] == h[: n - back])
        again[back:][same] = back
    s = W.mix(s + again * np.uint64(0x9E3779B97F4A7C15))
    found = []

    def add(tag: int, hashes: np.ndarray, at: np.ndarray) -> None:
        number = W.mix(hashes + np.uint64(tag * 0x632BE5AB)) >> np.uint64(64 - bits)
        found.append((doc[at].astype(np.uint64) << np.uint64(bits)) | number)

    everywhere = np.arange(n)
    add(1, h, everywhere)
    add(2, s, everywhere)
    two = np.flatnonzero(place >= 1)
    add(3, h[two] * np.uint64(3) + h[two - 1], two)
    add(4, s[two] * np.uint64(3) + s[two - 1], two)
    three = np.flatnonzero(place >= 2)
    add(5, (s[three] * np.uint64(3) + s[three - 1]) * np.uint64(3) + s[three - 2], three)
    keys = np.unique(np.concatenate(found)) if n else np.zeros(0, np.uint64)
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    """log of the share of each indicator in label 1 over its share in label 0."""
    out = []
    for label in (1, 0):
        mine = [r for r, v in zip(rows, y) if v == label]
        c = smooth + np.bincount(np.concatenate(mine) if mine else np.zeros(0, np.int64), minlength=size)
        out.append(c / c.sum())
    return np.log(out[0] / out[1])


def _values(row: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Scaled indicators of one text, of length 1 as a vector."""
    x = ratio[row]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm > 0 else x


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, *, cost: float, rounds: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss, one dual variable at a time.

    The bias is a feature of value 1.  The cost of a row is shared out so that both labels
    weigh the same.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    share = {v: len(y) / (2 * max(1, int((y == v).sum()))) for v in (0, 1)}
    top = np.array([cost * share[int(v)] for v in y])
    w, b = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float((v * v).sum()) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v, t = rows[i], values[i], sign[i]
            slope = t * (w[r] @ v + b) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), top[i])
            step = (new - alpha[i]) * t
            if step:
                alpha[i] = new
                w[r] += step * v
                b += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, b


def _sigmoid_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on the smoothed targets of Platt."""
    ones, zeros = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g, q = p - target, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(g * margin).sum(), g.sum()])
        hess = np.array([[(q * margin * margin).sum() + 1e-6, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit_rows(rows: list[np.ndarray], y: np.ndarray, size: int, *, cost: float = 1.0, rounds: int = 12, folds: int = FOLDS) -> Model:
    """Fit on all rows; slope and shift come from margins of rows left out in turn.

    Without rows of both labels the probability is the share of label 1 (one half without
    any row).
    """
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Model(np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))

    def one(train: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        mine = [rows[i] for i in train]
        ratio = log_count_ratio(mine, y[train], size)
        w, b = descend(mine, [_values(r, ratio) for r in mine], y[train], size, cost=cost, rounds=rounds, seed=7)
        return w * ratio, b, ratio

    fold = np.arange(len(y)) % folds
    margin, inside = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in range(folds):
        train = np.flatnonzero(fold != k)
        if len(set(y[train].tolist())) < 2:
            continue
        w, b, ratio = one(train)
        for i in np.flatnonzero(fold == k):
            norm = np.sqrt((ratio[rows[i]] ** 2).sum())
            margin[i], inside[i] = w[rows[i]].sum() / (norm or 1.0) + b, True
    w, b, ratio = one(np.arange(len(y)))
    slope, shift = _sigmoid_fit(margin[inside], y[inside]) if inside.any() and len(set(y[inside].tolist())) > 1 else (1.0, 0.0)
    # Both what is summed and what it is divided by are needed: weight and squared ratio.
    return Model(np.stack([w, ratio * ratio]).astype(np.float32), b, slope, shift)


def margins(model: Model, texts: W.Texts, bits: int) -> np.ndarray:
    n = len(texts.offsets) - 1
    doc, number = features(texts, bits)
    if model.weight.ndim == 1:
        return np.zeros(n)
    total = np.bincount(doc, model.weight[0][number], n)
    norm = np.sqrt(np.bincount(doc, model.weight[1][number], n))
    return total / np.where(norm > 0, norm, 1.0) + model.bias


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from: CRC32 of the id as text, modulo 4, is 2.

    False for a null id.
    """
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
    bits: int = HASH_BITS,
) -> Model:
    """Fit on at most ``train_rows`` labelled rows that are not held out.

    The rows are those with the smallest hash of their id.  Null ids and labels other than
    0 and 1 are left out; an id with both labels counts as 0; repeated documents of an id
    count once.  The only thing sent to the driver is the model.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def hashed(batches):
        for batch in batches:
            for part, t in W.slices(batch, "text"):
                doc, number = features(t, bits)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                rows = [number[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.record_batch([part.column("doc_id"), part.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "row"])

    # At most train_rows rows of two numbers are broadcast.
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .mapInArrow(hashed, "doc_id long, label int, row binary")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("row").alias("row"))
    )

    def fitted(batches):
        got = sorted((d, y, r) for b in batches for d, y, r in zip(*(c.to_pylist() for c in b.columns)))
        # Neighbouring ids may be alike: the folds follow the order of a hash.
        order = np.argsort(W.mix(np.array([d for d, _, _ in got], np.int64).view(np.uint64)), kind="stable")
        x = [np.frombuffer(got[i][2], "<i4").astype(np.int64) for i in order]
        m = fit_rows(x, np.array([got[i][1] for i in order], np.int64), 1 << bits)
        yield pa.record_batch(
            [pa.array([m.weight.astype("<f4").tobytes()], pa.binary()), *(pa.array([v]) for v in (m.bias, m.slope, m.shift))],
            ["weight", "bias", "slope", "shift"],
        )

    # One task sees the bounded sample only.
    got = rows.coalesce(1).mapInArrow(fitted, "weight binary, bias double, slope double, shift double").first()
    if got is None:
        return fit_rows([], np.zeros(0, np.int64), 1 << bits)
    weight = np.frombuffer(bytes(got["weight"]), "<f4")
    weight = weight.reshape(2, -1) if len(weight) == 2 << bits else weight
    return Model(weight, got["bias"], got["slope"], got["shift"])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", bits: int = HASH_BITS) -> DataFrame:
    """(doc_id, score) for every row; null and empty texts get the score of no features."""
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_score(scored, model, text_col="text", bits=bits).select("doc_id", "score")


def with_score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score", bits: int = HASH_BITS) -> DataFrame:
    """``docs`` with one more column; a column of that name is replaced."""
    kept = docs.drop(score_col)
    spec = [*kept.schema.fields]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    name = text_col

    def scored(batches):
        m = Model(*sent.value)
        for batch in batches:
            for part, t in W.slices(batch, name):
                z = np.clip(m.slope * margins(m, t, bits) + m.shift, -35, 35)
                yield pa.record_batch([*part.columns, pa.array(1 / (1 + np.exp(-z)))], [*part.schema.names, score_col])

    return kept.mapInArrow(scored, StructType([*spec, StructField(score_col, DoubleType())]))
