"""Reading and writing tables (IO1-IO9, IO12, IO13)."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table, or files when ``name`` is a path (IO1, IO2).

    Zone-less timestamps are read as they are.
    """
    if "/" in name:
        return spark.read.format(fmt).load(name)
    return spark.table(name)


def run_sql(
    spark: SparkSession,
    query: str,
    tables: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """SQL text with ``{table}`` for DataFrames and ``:name`` for values (IO3).

    Values are bound, never formatted into the text.
    """
    return spark.sql(query, args=dict(params or {}), **dict(tables or {}))


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Raise when there is no row; reads at most one (IO12)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def read_increment(
    spark: SparkSession,
    name: str,
    *,
    date_col: str = "compute_date",
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """Rows of a date-partitioned table in [since, until]; both open by default (IO13).

    Training reads the whole history, scoring one day; the filter prunes partitions.
    """
    df = read_table(spark, name)
    if since is not None:
        df = df.filter(F.col(date_col) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(date_col) <= F.lit(until))
    return df


def _save(writer, target: str) -> None:
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def exists(spark: SparkSession, target: str) -> bool:
    if "/" not in target:
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
        return True
    except AnalysisException as error:
        # Anything but a missing path or an empty folder is the caller's to see.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _in_order(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """``df`` in the column order of an existing table; columns it lacks are an error."""
    extra = sorted(set(df.columns) - set(columns))
    if extra:
        raise ValueError(f"{target} has no columns {extra}")
    return df.select(*columns)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def overwrite(df: DataFrame, target: str, partition_by: tuple[str, ...] = ()) -> int:
    """Replace the whole table (IO4); the row count comes with the same write (IO5)."""
    counted, seen = _counted(df)
    writer = counted.write.mode("overwrite")
    if "/" in target:
        # For a catalog table the option would stay with the table and undo later upserts.
        writer = writer.option("partitionOverwriteMode", "static")
    _save(writer.partitionBy(*partition_by) if partition_by else writer, target)
    return seen.get["rows"]


def append(df: DataFrame, target: str) -> int:
    """Append rows, in the column order of the table when it exists (IO9).

    Columns that the table does not have are an error.
    """
    spark = df.sparkSession
    if exists(spark, target):
        df = _in_order(df, read_table(spark, target).columns, target)
    counted, seen = _counted(df)
    _save(counted.write.mode("append"), target)
    return seen.get["rows"]


def upsert_batch(df: DataFrame, target: str, batch_col: str = "score_batch_id", *, batches: Sequence[str] = ()) -> int:
    """Replace the batches named in ``batches`` and those in ``df``, keep all others (IO7, IO8).

    A batch that is named and has no rows is gone afterwards.  Under a path, rows are added
    as a write of their own, and one small file appended to the log then says which write
    holds each batch.  Readers (``read_batches``) see a write when its log file is there, so
    never a part of it; a failed or repeated run leaves the rows of its last whole write.
    A catalog table is partitioned by batch and overwritten by dynamic partitions.
    """
    spark = df.sparkSession
    if "/" not in target:
        return _upsert_table(df, target, batch_col, batches)
    data, log = f"{target}/data", f"{target}/log"
    if exists(spark, log):
        columns = [c for c in read_table(spark, data).columns if c != "write_id"]
        df = _in_order(df, columns, target)
        sequence = read_table(spark, log).agg(F.max("sequence")).first()[0] + 1
    else:
        if exists(spark, target):
            raise ValueError(f"{target} holds another table")
        # The columns of the table, also while it has no rows.
        df.limit(0).write.mode("overwrite").parquet(f"{data}/write_id=none")
        sequence = 0
    write = f"w-{uuid.uuid4().hex}"
    counted, seen = _counted(df)
    counted.withColumn("write_id", F.lit(write)).write.mode("append").partitionBy("write_id").parquet(data)
    rows = seen.get["rows"]
    named = spark.createDataFrame([(b,) for b in batches], "batch string")
    if rows:
        named = named.unionByName(read_table(spark, f"{data}/write_id={write}").select(F.col(batch_col).cast("string").alias("batch")))
    entry = named.distinct().withColumns({"write_id": F.lit(write), "sequence": F.lit(sequence).cast("long")})
    entry.coalesce(1).write.mode("append").parquet(log)
    return rows


def read_batches(spark: SparkSession, target: str, batch_col: str = "score_batch_id") -> DataFrame:
    """The rows of every batch as its last whole write left them.

    The log is read now (one row per batch reaches the driver), so later writes do not
    change what the result holds.
    """
    if "/" not in target:
        return read_table(spark, target)
    last = F.max_by("write_id", F.struct("sequence", "write_id")).alias("write_id")
    live = read_table(spark, f"{target}/log").groupBy("batch").agg(last).collect()
    held = spark.createDataFrame([(r.batch, r.write_id) for r in live], "_batch string, _write string")
    rows = read_table(spark, f"{target}/data")
    # The first condition prunes folders.
    on = (F.col("write_id") == F.col("_write")) & F.col(batch_col).cast("string").eqNullSafe(F.col("_batch"))
    return rows.filter(F.col("write_id").isin(sorted({r.write_id for r in live}))).join(held, on, "left_semi").drop("write_id")


def _upsert_table(df: DataFrame, target: str, batch_col: str, batches: Sequence[str]) -> int:
    spark = df.sparkSession
    if not exists(spark, target):
        return overwrite(df, target, (batch_col,))
    # insertInto writes by position, so the order of the target is the contract.
    seen = Observation()
    named = [F.count_if(F.col(batch_col).cast("string") == b).alias(f"batch{i}") for i, b in enumerate(batches)]
    counted = _in_order(df, read_table(spark, target).columns, target).observe(seen, F.count(F.lit(1)).alias("rows"), *named)
    # Table inserts take the mode from the session.
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        counted.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    for i, b in enumerate(batches):
        if seen.get[f"batch{i}"] == 0:
            value = b.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({batch_col} = '{value}')")
    return seen.get["rows"]


def read_baseline(spark: SparkSession, name: str) -> DataFrame:
    """Baseline statistics: feature, mean, std (IO10)."""
    schema = T.StructType(
        [
            T.StructField("feature", T.StringType()),
            T.StructField("mean", T.DoubleType()),
            T.StructField("std", T.DoubleType()),
        ]
    )
    return read_table(spark, name).select(*[F.col(f.name).cast(f.dataType) for f in schema])
