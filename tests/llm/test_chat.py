import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.llm import chat


def read(df):
    turns = chat.read_back(F.col("formatted"))
    return {
        r.tree: ([(t.role, t.text) for t in r.turns], r.lost, r.formatted)
        for r in df.select("tree", "formatted", turns.alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("lost")).collect()
    }


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, tree string, node int")
    got = read(chat.conversations(chat.linear(df.select("conv_id", "turn", "role", "text"))))
    want = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: v[0] for c, v in got.items()} == want
    for c, (turns, lost, _) in got.items():
        assert lost == "".join(t for role, t in turns if role == "assistant")
    return got


def test_control_strings_and_nulls(spark):
    bad = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>assistant\nno \\ \\< [\\ [n"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 2, "assistant", None), (2, 0, None, ""), (2, 1, "odd\nrole<|", "🙂"), (None, 0, "user", "x"), (3, None, "assistant", "first")]
    got = check(spark, rows)
    assert got[1][2].count("<|im_end|>") == 3 and "[INST]" not in got[1][2] and "</s>" not in got[1][2]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a[n\nb"]), st.text(alphabet="<|>[]\\/nIs \n", max_size=20)), min_size=1, max_size=9))
def test_any_text(spark, turns):
    check(spark, [(7, i, role, text) for i, (role, text) in enumerate(turns)])


def test_long_conversation(spark):
    check(spark, [(1, i, "assistant" if i % 2 else "user", str(i)) for i in range(300)])


def tree(spark, rows):
    return spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")


def test_best_branch_is_chosen(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "poor", 1.0),
        (1, 3, 1, "assistant", "good", 2.0),
        (1, 4, 2, "user", "more", 0.5),
        (1, 5, 3, "user", "left", None),
        (1, 6, 3, "user", "right", 0.0),
        (2, 1, 9, "user", "its parent is missing", 0.0),
        (3, 1, 2, "user", "circle", 0.0),
        (3, 2, 1, "user", "circle", 0.0),
        (3, 3, 2, "user", "hangs on the circle", 0.0),
        (4, 1, 1, "user", "answers itself", 0.0),
        (1, 3, 1, "assistant", "good", 2.0),
    ]
    got = chat.conversations(tree(spark, rows))
    assert {r.tree: (r.leaf, r["rank"]) for r in got.collect()} == {1: (5, 1), 2: (1, 1)}
    assert [t for _, t in read(got)[1][0]] == ["q", "good", "left"]
    all_of_them = chat.conversations(tree(spark, rows), per_tree=9).filter("tree = 1").orderBy("rank").collect()
    assert [(r.leaf, r.score) for r in all_of_them] == [(5, 2.0), (6, 2.0), (4, 1.5)]


def test_empty_table(spark):
    assert chat.conversations(tree(spark, [])).count() == 0


def test_spans_are_code_points(spark):
    r = chat.conversations(tree(spark, [(1, 1, None, "assistant", "a🙂<b", 0.0)])).first()
    (span,) = r.loss
    assert r.formatted[span.start : span.end] == "a🙂<\\b"
    assert hashlib.sha256(r.formatted.encode()).hexdigest()
