"""Registered queries of the operators in this folder, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import (
    alignment,
    bpe,
    chat,
    decontaminate,
    fm_index,
    pii,
    pivots,
    pseudo_likelihood,
    quality,
    secret_scan,
    simhash,
    suffix_array,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_codec(path: str | None = None) -> bpe.Codec:
    """The public byte-level vocabulary, or another rank file."""
    return bpe.Codec(bpe.read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(table(spark, sf_dir, "documents"), byte_codec())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _removed(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["e"] - s["b"]))


@query
def op2_substring_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_units").alias("n_words"), _removed("spans").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        _removed("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(pii.of_kind(base, k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.told(base), 256).alias("base_sha256"),
        pii.told(F.col("spans")).alias("spans"),
    )


@query
def op4_topk_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, k=5, is_query=F.col("vec_id") % 50 == 0)


SQL["op4_topk_ball_tree"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5
"""


@query
def op5_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op7_winnowing_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS words
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0
), dw AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS words
  FROM d, (SELECT DISTINCT n FROM iw), unnest(range(1, len(w) - n + 2)) AS t(s) WHERE len(w) >= n
), hit AS (
  SELECT r, s, n, item_id FROM dw JOIN iw USING (n, words)
), counted AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hit)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (r) LEFT JOIN named USING (r)
"""


@query
def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.train_and_score(docs)


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id", "links"
    )


@query
def op10_chat_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.sql(
        "SELECT CAST(-1 AS BIGINT) conv_id, CAST(i AS BIGINT) turn, IF(i = 0, 'user', 'assistant') role,"
        " '</s>[INST] ok [/INST]' text FROM VALUES 0, 1 AS t(i)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    told = chat.conversations(chat.linear(rows))
    turns, lost = chat.read_back(F.col("formatted")), chat.learned_text(F.col("formatted"), F.col("loss"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op10_chat_reply_trees"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(i)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(24 + length(regexp_replace(replace(role, chr(10), 'xx'), '([\\<\[])', '__', 'g')) + length(regexp_replace(text, '([\\<\[])', '__', 'g'))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


@query
def op11_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.cluster(table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int) -> str:
    """Assignment and update of each round, one after the other."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""near{r} AS MATERIALIZED (
  SELECT row, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT x.row, p.c, CAST(sum((x.x - p.x) * (x.x - p.x)) AS BIGINT) AS d FROM x JOIN p{r} p USING (i) GROUP BY x.row, p.c
  ) GROUP BY row
)""")
        if r < rounds:
            out.append(f"""p{r + 1} AS MATERIALIZED (
  SELECT p.c, p.i, CAST(coalesce((m.s - (m.s % m.n + m.n) % m.n) // m.n, p.x) AS BIGINT) AS x
  FROM p{r} p LEFT JOIN (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM near{r} JOIN x USING (row) GROUP BY c, i
  ) m USING (c, i)
)""")
    return ",\n".join(out)


SQL["op11_laesa_clusters"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, w FROM (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = {pivots.DIMS}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  )
), x AS MATERIALIZED (
  SELECT row, i, w[i] AS x FROM v, range(1, {pivots.DIMS} + 1) t(i)
), p0 AS MATERIALIZED (
  SELECT c, i, w[i] AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), w) - 1 AS c, w FROM v QUALIFY c < {pivots.CLUSTERS}
  ), range(1, {pivots.DIMS} + 1) t(i)
), {_rounds_sql(pivots.ROUNDS)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{pivots.ROUNDS} JOIN v USING (row)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM p{pivots.ROUNDS} GROUP BY c) USING (c)
"""


@query
def op13_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(pii.of_kind(base, k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.told(base), 256).alias("base_sha256"),
        secret_scan.told(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["verdict"] == "example")).cast("long").alias("n_example"),
    )


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(
        table(spark, sf_dir, "documents"),
        byte_level_path=public_tokenizers.path("byte_bpe_50k.json"),
        pieces_path=public_tokenizers.path("piece_bpe_32k.model"),
    )
