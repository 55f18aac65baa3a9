"""From raw documents to token ids in five stages, each on all rows its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import decontaminate, pii, quality, simhash
from ebbline.llm.queries import byte_codec, table
from ebbline.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
GOOD = 0.7


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least GOOD; the others go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs.select(*COLUMNS), model, score_col="_score").filter(F.col("_score") >= GOOD).drop("_score")


def keep_first_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Rows that repeat an id are one document: the first by text.  Rows without an id take
    no part and stay.
    """
    found = simhash.near_duplicates(docs)
    firsts = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rest = [c for c in COLUMNS if c != "doc_id"]
    kept = (
        docs.select(*COLUMNS)
        .join(firsts, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select("doc_id", "row.*")
    )
    return kept.unionByName(docs.select(*COLUMNS).filter("doc_id IS NULL"))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; the others go."""
    found = decontaminate.hits(docs, table(spark, sf_dir, "benchmark"))
    keyed = docs.select(*COLUMNS, decontaminate.text_key(F.col("text")).alias("_key"))
    return keyed.join(found.select(F.col("key").alias("_key")), "_key", "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data written as its kind in brackets; n_chars follows the text."""
    model = pii.fit(docs)
    text = F.col("text")
    masked = docs.select(*COLUMNS).withColumn("text", pii.masked(text, pii.find(model, text)))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and whether they decode to its text."""
    codec = byte_codec()
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(*COLUMNS).withColumn("text", text)
    return codec.encoded(texts, "text", "ids").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.coalesce(codec.decode(F.col("ids")) == F.encode("text", "UTF-8"), F.lit(False)).alias("round_trip"),
    )


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_first_copy),
    ("decontamination", keep_uncontaminated),
    ("personal_data", mask_personal_data),
    ("encode", encode),
]

# A trained classifier and merges by rank are not SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder and read again."""
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
