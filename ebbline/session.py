"""Session settings and the shared folder that lineage is cut into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split the oversized shuffle partition even if that costs
    # one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are designed for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder stands in for it in local mode only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="ebbline-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


# Shuffle files go when the query that made them ends, not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Kept:
    """Frames written to a folder of their own within the shared one and read from there.

    In a ``with`` block, calling it with a frame writes the frame and gives the written rows.
    What was shuffled for it is dropped at once, so the steps of a long job are not on disk
    together.  The folder goes at the end of the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.count = spark, f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Kept:
        self.before = self.spark.conf.get(DROP_SHUFFLES, None)
        self.spark.conf.set(DROP_SHUFFLES, "true")
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        if self.before is None:
            self.spark.conf.unset(DROP_SHUFFLES)
        else:
            self.spark.conf.set(DROP_SHUFFLES, self.before)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that later reads see the same rows
    in the same buckets, also after an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
