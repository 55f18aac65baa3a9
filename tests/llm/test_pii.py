import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.llm import pii


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0


def digits(t):
    return re.sub("[^0-9]", "", t)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
    ("card", r"[0-9]([\x20\-]?[0-9])+", lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= len(digits(t)) <= 15),
]


def plain(text):
    return [(k, m.start(), m.end()) for k, p, ok in RULES for m in re.finditer(p, text or "") if ok(m[0])]


def base(row):
    return [(s.kind, s.b, s.e) for s in row.spans if s.base]


TRICKY = [
    "a@b.cd@e.f a@b.c_d@e.f x@y @a.b a@.b a..b@c-.d-",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.01 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111 1111  1111 1111 5-5-0-0",
    "+1 (988) 555-2485, +12345678 +1234567 +1 (((( +1234567890123456",
    "🙂🙂 +49 30 901820 ünï a@b.de 4111111111111111 10.0.0.255",
    "9" * 5000 + " 1 2 3 4 " * 800 + "a" * 5000 + "@x.y",
]


def test_base_spans(spark, sample, sample_rows):
    rows = [*sample_rows, *[(10**6 + i, t) for i, t in enumerate(TRICKY)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert base(r) == plain(texts[r.doc_id])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="1245@.+ -()ab", max_size=40), min_size=1, max_size=40))
def test_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("text", pii.base_spans(F.col("text")).alias("spans")).collect():
        assert base(r) == plain(r.text)


def test_edge_cases(edge, nothing):
    rows = pii.personal_data(edge).collect()
    assert len(rows) == edge.count() and all(r.spans == [] for r in rows)
    assert pii.personal_data(nothing).count() == 0


def test_voters_decide_on_proposed_spans(spark):
    """Of two digit strings that no strict pattern takes, context and format tell them apart."""
    known = [(i, f"word call me at +1 ({200 + i}) 555-2{100 + i} or phone {i}") for i in range(60)]
    known += [(100 + i, f"order number {3000000000 + 7919 * i}x and then more") for i in range(60)]
    asked = [(300, "my phone (415) 555-0199 is on"), (301, "order number 4155550199x is on")]
    df = spark.createDataFrame(known + asked, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.b, s.e) for s in r.spans if not s.base] for r in pii.personal_data(df, accept=0.5).collect()}
    assert got[301] == []
    assert all(got[100 + i] == [] for i in range(60))


def test_good_candidates_are_found_at_the_default(spark):
    known = [(i, f"word call me at +1 ({200 + i}) 555-2{100 + i} or phone {i}") for i in range(60)]
    known += [(100 + i, f"order number {3000000000 + 7919 * i}x and then more") for i in range(60)]
    known += [(400 + i, f"my phone ({200 + i}) 555-0{100 + i} is on") for i in range(60)]
    asked = [(300, "my phone (415) 555-0199 is on"), (301, "order number 4155550199x is on"), (302, "my phone 0044 415 555 0199 is on")]
    df = spark.createDataFrame(known + asked, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.b, s.e) for s in r.spans if not s.base] for r in pii.personal_data(df).collect()}
    assert got[300] == [("phone", 9, 23)] and got[302] == [("phone", 9, 26)]
    assert got[301] == []


def test_calling_codes_vote(spark):
    texts = ["+1 415 555 0199", "0044 415 555 0199", "+999 415 555 0199", "(415) 555-0199"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    span = F.struct(F.lit("phone").alias("kind"), F.lit(0).alias("b"), F.length("text").alias("e"), F.col("text").alias("txt"), F.lit(False).alias("base"))
    got = df.select("i", pii.votes(F.col("text"), span)["gazetteer"].alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [1, 1, -1, 0]


def test_reliabilities_follow_the_votes():
    good, bad = (1, 1, 1, 1, 1), (-1, -1, -1, 1, -1)
    right, p, share = pii._estimate([(good, 500), (bad, 500)])
    assert p[0] > 0.99 and p[1] < 0.01 and abs(share - 0.5) < 0.02
    assert right[0] > 0.95 and right[3] < 0.6


def test_masking(spark):
    text = "a@b.cd and +1 (988) 555-2485, a@b.cd."
    df = spark.createDataFrame([(text,), ("plain",)], "text string")
    spans = pii.base_spans(F.col("text"))
    assert [r[0] for r in df.select(pii.masked(F.col("text"), spans)).collect()] == ["[EMAIL] and [PHONE], [EMAIL].", "plain"]


def test_no_python_in_the_plan(edge):
    plan = pii.personal_data(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_patterns_run_once_per_text(spark, sample):
    """Four strict and four loose patterns, each once."""
    model = pii.fit(sample)
    plan = sample.select(pii.find(model, F.col("text")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 8
