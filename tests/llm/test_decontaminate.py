import random
import re

from pyspark.sql import functions as F

from ebbline.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                k = tuple(w[s : s + n])
                if k in windows:
                    hit.update(range(s, s + n))
                    found |= windows[k]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def check(spark, docs, items):
    d = docs if not isinstance(docs, list) else spark.createDataFrame(docs, "doc_id long, text string")
    rows = [(r[0], r[1]) for r in d.collect()] if not isinstance(docs, list) else docs
    i = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items)) for r in decontaminate.contamination(d, i).collect()), key=repr)
    want = brute(rows, items)
    assert got == want
    return want


def test_made_rows(spark):
    r = random.Random(1)
    vocabulary = ["a", "B", "c", "É", "é", "x9"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 6, 9, 10, 11, 14, 40])))) for i in range(12)]
    items += [(20, None), (21, "..."), (22, "ha " * 30), (22, "x9"), (None, "lone words of an item")]
    docs = []
    for i in range(50):
        parts = [r.choice(items)[1] or "" if r.random() < 0.4 else " ".join(r.choice(vocabulary) for _ in range(15)) for _ in range(4)]
        docs.append((i, ", ".join(parts)))
    docs += [(60, None), (61, ""), (62, "HA " * 100), (1, docs[1][1]), (None, docs[2][1]), (2, "lone words of an item")]
    assert sum(n for _, _, n, _ in check(spark, docs, items)) > 100


def test_edge_cases(spark, edge):
    check(spark, edge, [(1, "the same line of text with enough words to make a window"), (2, "one"), (3, None)])


def test_empty_tables(spark, edge, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(nothing, items).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(edge, items).collect())


def test_kept_hashes_of_a_shared_span_agree(spark):
    """Both sides keep a common hash for every shared window of ten words."""
    r = random.Random(3)
    span = " ".join(str(r.randint(0, 50)) for _ in range(10))
    docs = [(i, " ".join(str(r.randint(0, 50)) for _ in range(r.randint(0, 9))) + " " + span + " " + str(i)) for i in range(40)]
    want = check(spark, docs, [(1, f"before {span} after")])
    assert all(n == 10 for _, _, n, _ in want)


def test_larger_benchmarks_are_joined(spark, edge, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    check(spark, edge, [(1, "the same line of text with enough words to make a window"), (2, "one")])


def test_no_python_in_the_plan(spark, edge):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    plan = decontaminate.contamination(edge, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_capital_sigma_before_other_punctuation(spark):
    names = ["ΟΔΟΣ", "ΛΟΓΟΣ", "ΝΟΜΟΣ", "ΤΟΠΟΣ", "ΧΡΟΝΟΣ", "ΚΟΣΜΟΣ"] * 2
    check(spark, [(1, "a b " + ".".join(names) + ".c"), (2, " ".join(names))], [(7, " ".join(names)), (8, ".".join(names[:4]))])


def test_a_text_is_split_once_for_all_its_candidates(spark, sample):
    """In the plan of the comparison the text's words are one pattern match, outside the loops."""
    items = spark.createDataFrame([("a", "one two three four five six seven eight nine ten")], "item_id string, text string")
    plan = decontaminate.hits(sample, items)._jdf.queryExecution().optimizedPlan().toString()
    compare = next(line for line in plan.splitlines() if "Generate inline" in line)
    assert compare.count("regexp_extract_all") == 2  # the text's words and the item's


def test_texts_are_split_once_for_items_of_all_lengths(spark, sample):
    """Short items of several lengths and long ones are looked up in one pass over the texts."""
    items = [("a", "one two three four five six seven eight nine ten"), ("b", "one"), ("c", "one two three"), ("d", "four five six seven")]
    items = spark.createDataFrame(items, "item_id string, text string")
    plan = decontaminate._candidates(sample.selectExpr("doc_id AS key", "text"), items.select(F.col("item_id").alias("item"), "text"))
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Relation [" in line or "FileScan" in line for line in lines) == 1
