"""The stages against plain versions of what each decides, and each on odd rows."""

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ebbline.llm import bpe, quality
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import brute
from tests.llm.test_pii import plain as personal
from tests.llm.test_simhash import classes
from tests.llm.test_simhash import plain as fingerprint


def test_whole_run(spark, sample):
    model = quality.train(sample, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(sample, model).collect() if r.score >= pipeline.GOOD}
    rows = {r.doc_id: r.text for r in sample.collect() if r.doc_id in good}
    firsts = classes({d: fingerprint(t) for d, t in rows.items()})
    rows = {d: t for d, t in rows.items() if firsts[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, _, hit, _ in brute(list(rows.items()), items) if not hit}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    assert set(got) == clean and len(got) > 50
    for d, r in got.items():
        text = library.decode(r.ids)
        assert r.round_trip and r.n_tokens == len(r.ids) and r.ids == library.encode_ordinary(text)
        assert not personal(text)
        if not personal(rows[d]):
            assert text == rows[d] or "[" in text


@pytest.fixture(scope="module")
def sf(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(5, 1), (11, 0), (8, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "naïve café — ünïcode\u00a0words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_on_odd_rows(spark, edge, nothing, sf):
    for name, stage in pipeline.STAGES:
        out = stage(spark, edge, sf)
        assert out.count() <= edge.count()
        assert stage(spark, nothing, sf).count() == 0
        if name != "encode":
            assert out.columns == list(pipeline.COLUMNS)


def test_what_stages_decide(spark, edge, sf):
    stages = dict(pipeline.STAGES)
    left = [r.doc_id for r in stages["near_duplicates"](spark, edge, sf).collect()]
    assert sorted(d for d in left if d is not None) == [0, 3, 4, 5, 8, 9, 10, 11] and left.count(None) == 1
    assert 8 not in {r.doc_id for r in stages["decontamination"](spark, edge, sf).collect()}
    told = edge.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" me@here.org")))
    assert all(r.text.endswith(" [EMAIL]") and r.n_chars == len(r.text) for r in stages["personal_data"](spark, told, sf).collect())
