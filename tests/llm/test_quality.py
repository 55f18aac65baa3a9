import zlib

import numpy as np
from pyspark.sql import functions as F

from ebbline.llm import quality
from ebbline.llm import words as W
from tests.llm.conftest import SF


def texts(*values):
    raw = [v.encode() for v in values]
    return W.Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))


def test_held_out_labels_are_predicted(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(a.weight, b.weight) and a[1:] == b[1:]


def test_held_out_rule(spark):
    rows = spark.range(50).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_edge_cases(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    empty = quality.train(nothing, none)
    assert [r.score for r in quality.score(edge, empty).collect()] == [0.5] * edge.count()
    odd = spark.createDataFrame([(1, 1), (1, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    one_label = quality.train(edge, odd)
    assert all(r.score > 0.99 for r in quality.score(edge, one_label).collect())
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(12)] + [(5, 0)], "doc_id long, quality int")
    model = quality.train(edge, labels)
    scored = quality.with_score(edge, model, score_col="n_chars")
    assert scored.columns.count("n_chars") == 1
    assert all(0 <= r.n_chars <= 1 for r in scored.collect())
    assert quality.score(nothing, model).count() == 0


def test_log_count_ratio_and_descent():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    y = np.array([1, 1, 0, 0])
    ratio = quality.log_count_ratio(rows, y, 4)
    assert np.allclose(ratio, [np.log(3), -np.log(3), 0, 0])
    w, b = quality.descend(rows, [ratio[r] for r in rows], y, 4, cost=10.0, rounds=200, seed=1)
    margin = np.array([w[r] @ ratio[r] + b for r in rows])
    assert np.allclose(margin * np.where(y == 1, 1, -1), 1, atol=1e-2)


def test_features_do_not_cross_texts():
    doc, number = quality.features(texts("a b", "", "c"))
    assert sorted(set(doc.tolist())) == [0, 2]
    alone = quality.features(texts("c"))[1]
    assert set(alone.tolist()) == set(number[doc == 2].tolist())


def test_words_of_a_batch():
    t = texts(" a  bc", "", "\tdé\n", "e")
    w = W.split(t)
    assert [bytes(t.data[a:b]).decode() for a, b in zip(w.start, w.end)] == ["a", "bc", "dé", "e"]
    assert w.first.tolist() == [0, 2, 2, 3, 4]
    line, _ = W.joined(t, w)
    assert [bytes(line.data[a:b]).decode() for a, b in zip(line.offsets, line.offsets[1:])] == ["a bc", "", "dé", "e"]
