import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, h int, spans string"

EDGE_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "two words",
    "the same line of text with enough words to make a window of thirteen words or more in it",
    "the same line of text with enough words to make a window of thirteen words or more in it",
    "THE SAME line of text with enough words to make a window of thirteen words or more in it",
    "Naïve café — ünïcode words 🙂🙂 and 日本語テキスト repeated " * 6,
    "a" * 3000,
    "ha " * 500,
    "x" + " y" * 400 + "\u0000\u0001 end",
]


@pytest.fixture(scope="session")
def edge_rows():
    rows = [(i, t, None, "s", None, "w", 1, "z") for i, t in enumerate(EDGE_TEXTS)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, EDGE_TEXTS[5], "en", None, 3, None, None, None))  # no id
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """Small frame with nulls, ties, copies, long words and columns of clashing names."""
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sample_rows(sample):
    return [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
