"""Token alignment against a plain version that encodes whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ebbline.llm import alignment
from ebbline.llm.queries import QUERIES
from ebbline.llm.words import Texts
from tests.llm.conftest import EDGE_TEXTS, SF

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def alphabet():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def tokens(libraries, text):
    """(id, bytes) of both sides for a whole text, or None where bytes differ."""
    a, b = libraries
    byte = alphabet()
    enc = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(byte[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
        return None
    return left, right


def groups_of(left, right):
    def ends(side):
        out, at = [], 0
        for i, raw in side:
            at += len(raw)
            out.append((at, i))
        return out

    x, y = ends(left), ends(right)
    cuts = sorted({e for e, _ in x} & {e for e, _ in y})
    out, low = [], 0
    for c in cuts:
        out.append(([i for e, i in x if low < e <= c], [i for e, i in y if low < e <= c]))
        low = c
    return out


def plain(libraries, rows):
    held, docs, cache = {}, [], {}
    for k, (_, text) in enumerate(rows):
        if text not in cache:
            found = tokens(libraries, text) if text else None
            cache[text] = (found, groups_of(*found) if found else [])
        found, groups = cache[text]
        links = [(a, b) for x, y in groups for a in x for b in y]
        docs.append((found, groups, links))
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (i, _), (found, groups, links) in zip(rows, docs):
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (i, len(found[0]) if found else 0, len(found[1]) if found else 0, len(groups), len(links),
             sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(told.encode()).hexdigest() if found else "")
        )
    return sorted(out, key=str)


def run(spark, rows, parts=3, **how):
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "slice", "radix", "sha", "n_a")})
    found = alignment.alignment(frame.repartition(parts), byte_level_path=A, pieces_path=B, **how)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


HARD = [
    "<|endoftext|> and </s> <s> <unk> <0x41> [INST]",
    "two  spaces and   three, a tab\tand\nlines \r\n  end ",
    " leading", "trailing ", " ", "\n", "\t x", "  ",
    "▁ is a piece sign", "word▁inside a word",
    "nbsp here   there 　wide　  em  line \u0085next\u0085   ogham",
    "ﬁ ligature Å Å é é naïve … — “quoted” l’été",
    "日本語 テキスト です 한국어 текст по-русски ελληνικά",
    "🙂🙂 👨‍👩‍👧 flags 🇩🇪 end", "don't we'll they've I'm 12345 3.14 1,000",
    "\u0000 null \u0001 bytes \u007f", "zero​width ﻿bom", "a" * 1001, "=" * 333 + " " + "-" * 500, "ab " * 300 + "é " * 200,
]


def test_equals_whole_texts(spark, libraries):
    rng = random.Random(2)
    bits = ["the", " ", " ", "  ", "é", "été", "\n", "a", "'s", "token", "1", "23", "日本", "🙂", " ", " ", "▁", ".", ",", "-", "naïve", "\t", "’", "ß", "x" * 30]
    texts = EDGE_TEXTS + HARD + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(3, "repeated id"), (3, "repeated id"), (None, "no id at all")]
    want = plain(libraries, rows)
    assert run(spark, rows) == want
    # Many small slices, merged two at a time over several levels, give the same.
    assert run(spark, rows, parts=6, slice_bytes=200, fan_in=2) == want


def test_long_texts_and_empty_table(spark, libraries):
    rows = [(1, "word " * 30_000 + "end"), (2, "a" * 100_000), (3, "word end")]
    found = {r[0]: r for r in run(spark, rows)}
    assert found[1][1] == len(libraries[0].encode(" " + rows[0][1], add_special_tokens=False).ids)
    assert found[1][2] == len(libraries[1].encode(rows[0][1]))
    assert found[2][2] == len(libraries[1].encode(rows[1][1])) and found[3][3] > 0
    assert run(spark, []) == []
    assert [r[1:] for r in run(spark, [(1, None), (2, "")])] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_merge_adds_up_sorted_runs(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 7)
    rng = np.random.default_rng(0)
    runs, want = [], {}
    for size in (0, 1, 50, 200, 333):
        keys = np.unique(rng.integers(0, 1 << 44, size).astype(np.uint64) >> np.uint64(36) << np.uint64(30))
        counts = rng.integers(1, 1000, len(keys)).astype(np.uint64)
        runs.append(alignment.run_of(keys, counts))
        for k, c in zip(keys.tolist(), counts.tolist()):
            want[k] = want.get(k, 0) + c
    both = [x for k, c in alignment.frames_of(alignment.merged(runs)) for x in zip(k.tolist(), c.tolist())]
    assert both == sorted(want.items())
    keys = np.array([1 << 32, (1 << 32) + 5, 2 << 32], np.uint64)
    assert alignment.highest(keys, np.array([3, 9, 4], np.uint64)).tolist() == [9, 9, 4]


def test_chunks_never_start_beside_white_space():
    texts = [" a b", " a  b", "   b", " é ü", " a  b", "", " x "]
    raw = [t.encode() for t in texts]
    edges = np.cumsum([0] + [len(r) for r in raw])
    start = alignment.chunks(Texts(np.frombuffer(b"".join(raw), np.uint8), edges))
    cut = [[int(s - a) for s in start if a <= s < b] for a, b in zip(edges, edges[1:])]
    assert cut == [[0, 2], [0], [0], [0, 3], [0], [], [0]]


def test_query_equals_whole_texts(spark, libraries, sample_rows):
    found = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, SF).collect()), key=str)
    assert found == plain(libraries, sample_rows)
