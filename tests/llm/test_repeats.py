"""Both substring operators against a dictionary of all windows."""

import random

import numpy as np
import pytest

from ebbline.llm import fm_index, repeats, suffix_array

LATE = repeats.NO_ID


def brute(rows, split, length):
    first = {}
    for doc, text in rows:
        u = split(text)
        doc = LATE if doc is None else doc
        for s in range(len(u) - length + 1):
            k = tuple(u[s : s + length])
            first[k] = min(first.get(k, LATE), doc)
    out = []
    for doc, text in rows:
        u = split(text)
        gone = set()
        for s in range(len(u) - length + 1):
            if first[tuple(u[s : s + length])] < (LATE if doc is None else doc):
                gone.update(range(s, s + length))
        out.append((doc, len(u), len(gone), [x for i, x in enumerate(u) if i not in gone]))
    return out


def outcome(df, join):
    return sorted(
        ((r.doc_id, r.n_units, sum(s.e - s.b for s in r.spans), bytes(r.kept)) for r in df.collect()), key=repr
    )


def expected(rows, split, length, join):
    return sorted(((d, n, g, join(k)) for d, n, g, k in brute(rows, split, length)), key=repr)


def by_words(rows):
    return [(d, (t or "").encode()) for d, t in rows]


WORDS = (lambda t: t.split(), b" ".join)
BYTES = (lambda t: t, bytes)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def made(seed):
    """Documents pasted together from shared passages, with repeats inside."""
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(12)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(5, 30))] for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.6 else [r.choice(vocabulary) for _ in range(r.randint(1, 20))] for _ in range(r.randint(0, 6))]
        rows.append((i, " ".join(w for p in parts for w in p)))
    rows += [rows[3], (None, rows[4][1]), (5, "other " + rows[6][1]), (70, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk", [repeats.CHUNK_BYTES, 400])
def test_made_rows(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    rows = made(seed)
    df = frame(spark, rows).repartition(4)
    assert outcome(fm_index.dedup(df), None) == expected(by_words(rows), WORDS[0], 13, WORDS[1])
    assert outcome(suffix_array.dedup(df), None) == expected(by_words(rows), BYTES[0], 50, BYTES[1])


def test_other_lengths(spark):
    rows = made(5)
    df = frame(spark, rows)
    assert outcome(fm_index.dedup(df, length=6, gram=2), None) == expected(by_words(rows), WORDS[0], 6, WORDS[1])
    assert outcome(suffix_array.dedup(df, length=16, gram=7), None) == expected(by_words(rows), BYTES[0], 16, BYTES[1])


def test_edge_cases(edge, edge_rows):
    rows = by_words([(r[0], r[1]) for r in edge_rows])
    assert outcome(fm_index.dedup(edge), None) == expected(rows, WORDS[0], 13, WORDS[1])
    assert outcome(suffix_array.dedup(edge), None) == expected(rows, BYTES[0], 50, BYTES[1])


def test_sample(sample, sample_rows):
    rows = by_words(sample_rows)
    assert outcome(fm_index.dedup(sample), None) == expected(rows, WORDS[0], 13, WORDS[1])
    assert outcome(suffix_array.dedup(sample), None) == expected(rows, BYTES[0], 50, BYTES[1])


def test_empty_table(nothing):
    assert fm_index.dedup(nothing).count() == suffix_array.dedup(nothing).count() == 0


def test_spans_are_apart(sample):
    for r in suffix_array.dedup(sample).collect():
        assert all(a.e < b.b for a, b in zip(r.spans, r.spans[1:]))


def test_backward_search_finds_all_places():
    import numpy as np

    rng = np.random.default_rng(3)
    symbols = rng.integers(1, 4, 300)
    symbols[::37] = 0
    symbols[-1] = 0
    index = fm_index.FMIndex(symbols)
    at = np.arange(1, 290)
    at = at[[not (symbols[a : a + 4] == 0).any() for a in at]]
    lo, hi = index.search(symbols, at, 4)
    for a, x, y in zip(at, lo, hi):
        places = [i for i in range(297) if (symbols[i : i + 4] == symbols[a : a + 4]).all()]
        assert sorted(index.order[x:y].tolist()) == places


@pytest.mark.parametrize("module,split,length,join", [(fm_index, *WORDS[:1], 13, WORDS[1]), (suffix_array, *BYTES[:1], 50, BYTES[1])])
def test_one_anchor_never_fills_an_index(spark, module, split, length, join, monkeypatch):
    # A shared phrase shorter than a window, followed by text of each document's own; some share more.
    phrase = "all rights reserved under the license of this notice and its terms"
    rows = [(i, "%s doc%d has words of its own number %d and so on" % (phrase, i // (1 + (i % 10 == 0)), i % 97)) for i in range(400)]
    finder, largest = module.finder, 4000

    def bounded(data, offsets, low, n):
        assert len(data) < 3 * largest
        return finder(data, offsets, low, n)

    monkeypatch.setattr(module, "finder", bounded)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", largest)
    df = frame(spark, rows).repartition(20)
    assert outcome(module.dedup(df), None) == expected(by_words(rows), split, length, join)


def plain_windows(data, offsets, low, length):
    """Smallest document of every window by a dictionary, and windows per piece."""
    pieces = [bytes(data[a:b]) for a, b in zip(offsets, offsets[1:])]
    windows = [[p[s : s + length] for s in range(len(p) - length + 1)] for p in pieces]
    least = {}
    for doc, own in zip(low.tolist(), windows):
        for w in own:
            least[w] = min(least.get(w, LATE), doc)
    return [least[w] for own in windows for w in own], [len(own) for own in windows]


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_refined_buckets_against_a_dictionary(block, monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffix_array, "BLOCK", block)
    rng = np.random.default_rng(block)
    for _ in range(150):
        length, k = int(rng.choice([1, 3, 8, 9, 17, 50])), int(rng.integers(1, 8))
        # Some pieces are shorter than a window; few symbols and periods tie long; zeros are bytes too.
        sizes = rng.integers(max(length - 2, 0), length + int(rng.choice([1, 20, 200])), k)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        data = rng.integers(0, int(rng.choice([1, 2, 3, 250])), offsets[-1]).astype(np.uint8)
        if len(data) and rng.random() < 0.4:
            data = np.resize(data[: int(rng.integers(1, 30))], len(data))
        low = rng.integers(0, 100, k)
        first, count = suffix_array.finder(data, offsets, low, length)
        assert (first.tolist(), count.tolist()) == plain_windows(data, offsets, low, length)


def test_only_tied_buckets_are_refined():
    import numpy as np

    rng = np.random.default_rng(9)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    data[3000:3200] = data[100:300]
    q, length = suffix_array.Q, 50
    buckets = suffix_array.Buckets(suffix_array.grams(data, q, length), q)
    text = bytes(data) + bytes(2 * length)
    waiting, seen = [buckets.tied], 0
    while waiting:
        places = waiting.pop()
        suffix = buckets.order[places]
        bucket = buckets.pointer[suffix]
        sizes = np.unique(bucket, return_counts=True)[1]
        assert sizes.min() > 1
        assert buckets.shared[bucket].max() < length
        for s, t in zip(suffix[1:][bucket[1:] == bucket[:-1]], suffix[:-1][bucket[1:] == bucket[:-1]]):
            n = int(buckets.shared[buckets.pointer[s]])
            assert text[s : s + n] == text[t : t + n]
        seen += len(places)
        rest = buckets.refine(places, length)
        if len(rest):
            waiting.append(rest)
    # The copied passage and the empty suffixes are tied, nearly nothing else is.
    assert 0 < seen < 2500
    assert [text[s : s + length] for s in buckets.order] == sorted(text[s : s + length] for s in range(len(data) + length))


def test_pointers_of_earlier_buckets_are_reused(monkeypatch):
    import numpy as np

    # With updates, a later bucket advances by more than its own first bytes.
    rng = np.random.default_rng(4)
    unit = rng.integers(97, 123, 400).astype(np.uint8)
    key = suffix_array.grams(np.concatenate([unit, unit]), 8, 50)
    rounds = {}
    for block in (1, 1 << 16):
        monkeypatch.setattr(suffix_array, "BLOCK", block)
        n, refine = [], suffix_array.Buckets.refine
        monkeypatch.setattr(suffix_array.Buckets, "refine", lambda self, p, length: n.append(len(p)) or refine(self, p, length))
        suffix_array.suffix_order(key, 8, 50)
        monkeypatch.setattr(suffix_array.Buckets, "refine", refine)
        rounds[block] = sum(n)
    assert rounds[1] < rounds[1 << 16]


def test_packed_anchors_come_back():
    """Any ids and anchors, in less than half of the 12 bytes of a row where ids are near each other."""
    r = np.random.default_rng(4)
    for n, low, high in ((1, 0, 5), (9, -(2**62), 2**62), (30000, 10**6, 10**6 + 5000), (20000, repeats.NO_ID - 9, repeats.NO_ID)):
        a, doc = r.integers(-(2**31), 2**31, n).astype(np.int32), r.integers(low, high, n)
        for known in (False, True):
            packed = list(repeats._pack_anchors(a, doc, known))
            rows = [x for b in repeats._unpacked(packed) for x in zip(b.column("a").to_pylist(), b.column("doc").to_pylist())]
            want = zip(a.tolist(), (-1 - doc if known else doc).tolist())
            assert sorted(rows) == sorted(want)
            assert sum(b.column("n").to_numpy().sum() for b in packed) == n
    a, doc = r.integers(-(2**31), 2**31, 30000).astype(np.int32), r.integers(10**6, 10**6 + 5000, 30000)
    (one,) = repeats._pack_anchors(a, doc, False)
    assert one.column("packed").nbytes < 6 * 30000 and one.num_rows == 1 << repeats.LEAD_BITS
    assert not list(repeats._pack_anchors(a[:0], doc[:0], False))
