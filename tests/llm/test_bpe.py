import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.llm import bpe
from ebbline.llm.queries import byte_codec


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_codec()


def check(df, codec, library):
    rows = bpe.encode_decode(df, codec).collect()
    texts = {(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()}
    for r in rows:
        text = bytes(r.decoded).decode()
        assert (r.doc_id, text) in texts
        assert r.ids == library.encode_ordinary(text)
    return len(rows)


def test_edge_cases(edge, codec, library):
    assert check(edge, codec, library) == edge.count()


def test_sample(sample, codec, library):
    assert check(sample, codec, library) == sample.count()


def test_empty_table(nothing, codec):
    assert bpe.encode_decode(nothing, codec).count() == 0


def test_slices_change_nothing(edge, codec, library):
    rows = edge.select("doc_id", "text", "word").coalesce(1)
    for most in (1, 3, 100):
        got = codec.encoded(rows, "text", "ids", slice_words=most).collect()
        assert len(got) == edge.count() and got[0].__fields__ == ["doc_id", "text", "word", "ids"]
        assert all(r.ids == (None if r.text is None else library.encode_ordinary(r.text)) for r in got)


def test_a_word_is_folded_once_a_slice(spark, codec):
    """Whatever the copies, a slice holds its distinct words and positions only."""
    rows = spark.range(1000).select(F.lit("one two two one").alias("text")).coalesce(1)
    plan = codec.encoded(rows, "text", "ids")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence") == 2 and "Exchange" not in plan
    assert codec.encoded(rows, "text", "ids").distinct().count() == 1


def test_long_words(spark, codec, library):
    """Words about the length from which they are held as strings, and far longer ones."""
    texts = ["ab" * n for n in (30, 31, 32, 33, 5000)] + ["a" * n for n in (61, 62, 63, 64, 20000)] + ["é🙂" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert check(df, codec, library) == len(texts)


def test_short_words_are_merged_side_by_side(codec, library):
    """All but words of more bytes come without a fold, equal to the library's."""
    texts = ["a" * n for n in range(1, 35)] + ["the", "naïve", "日本語テキスト", "🙂🙂", "\u0000", "", "aabab" * 6, "walking", "x" * 31 + "é"]
    got = bpe.short_ids(pa.array(texts), codec.short).to_pylist()
    for text, ids in zip(texts, got):
        raw = text.encode()
        assert ids == (library._encode_single_piece(raw) if 0 < len(raw) <= bpe.SHORT_BYTES else None)
    assert bpe.short_ids(pa.array([], pa.string()), codec.short).to_pylist() == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30))
def test_any_text(spark, codec, library, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert check(df, codec, library) == len(texts)


def test_unknown_id_decodes_to_null(spark, codec):
    df = spark.createDataFrame([([10**6],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(codec.decode(F.col("ids"))).collect()] == [None, bytearray(b"")]


def test_other_vocabulary(spark, edge):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert check(edge, bpe.Codec(ranks, public_tokenizers.PATTERN), library) == edge.count()


def test_refuses_what_it_cannot_merge():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256}
    with pytest.raises(ValueError):
        bpe.Codec(ranks, ".")


def test_slices_are_small_and_may_leave_texts_behind(edge, codec):
    assert bpe.SLICE_WORDS <= 1 << 20
    rows = edge.select("doc_id", "text").coalesce(1)
    kept, left = (codec.encoded(rows, "text", "ids", keep_text=k).collect() for k in (True, False))
    assert [(r.doc_id, r.ids) for r in kept] == [(r.doc_id, r.ids) for r in left]
    assert all(r.text == (None if k.text is None else "") for k, r in zip(kept, left))
