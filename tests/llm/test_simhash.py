import random

import xxhash

from ebbline.llm import graph, simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    parent = {p: p for p in set(prints.values())}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(parent)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(a ^ b).count("1") <= 3:
                parent[top(a)] = top(b)
    best = {}
    for doc, p in prints.items():
        best[top(p)] = min(best.get(top(p), doc), doc)
    return {doc: best[top(p)] for doc, p in prints.items()}


def test_sample(sample, sample_rows):
    prints = {d: plain(t) for d, t in sample_rows}
    want = classes(prints)
    rows = simhash.near_duplicates(sample).collect()
    assert len(rows) == len(prints)
    for r in rows:
        assert r.fingerprint % (1 << 64) == prints[r.doc_id]
        assert r.component_id == want[r.doc_id]


def test_edge_cases(edge, edge_rows):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == 0
    assert by_id[0].component_id == by_id[2].component_id == 0
    assert by_id[7].component_id == by_id[None].component_id == 5


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


def test_links_find_every_pair(spark):
    r = random.Random(4)
    values = set()
    for _ in range(40):
        x = r.getrandbits(64)
        values.add(x)
        for _ in range(6):
            y = x
            for b in r.sample(range(64), r.randint(1, 5)):
                y ^= 1 << b
            values.add(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "doc_id long, fingerprint long")
    for distance, segments in ((3, 2), (3, 4), (2, 1)):
        got = {tuple(sorted((u, v))) for u, v in simhash.links(df, distance=distance, segments=segments).collect()}
        want = {tuple(sorted((signed(a), signed(b)))) for a in values for b in values if a < b and bin(a ^ b).count("1") <= distance}
        assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 100 for i in range(100, 161)} | {5: 5} | {i: 5 for i in range(200, 260)}


def test_shuffled_chain(spark):
    names = list(range(300))
    random.Random(2).shuffle(names)
    got = dict(graph.components(spark.createDataFrame(list(zip(names, names[1:])), "u long, v long")).collect())
    assert got == {n: 0 for n in names}
