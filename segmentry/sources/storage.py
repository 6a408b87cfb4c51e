"""Cutting lineage and writing tables on the shared file system."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Spark's setting that an execution removes its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="segmentry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/segmentry/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    The result survives the loss of executors, is computed once however many
    branches read it, and keeps column pruning and file statistics. Zstandard
    holds sorted numbers and texts in less of the shared disk than the default.
    Nothing reads the shuffles of the write once it has ended, so its files go at
    once and not when the driver next collects garbage.
    """
    path = new_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Named tables under one root. An overwrite writes a new version and readers
    move to it when it is complete, so a table can be rewritten from itself."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or new_path(spark, "tables")).rstrip("/")

    def _versions(self, name: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [entry.getPath() for entry in fs.listStatus(path)]
        done = [p for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("-")[1]) for p in done)

    def path(self, name: str) -> str:
        """Where the current version lies."""
        versions = self._versions(name)
        if not versions:
            raise KeyError(name)
        return f"{self.root}/{name}/v-{versions[-1]:06d}"

    def overwrite(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        versions = self._versions(name)
        version = versions[-1] + 1 if versions else 0
        # A version without its success mark is left over from a failed write.
        writer = df.write.mode("overwrite").partitionBy(*partition_by or [])
        writer.parquet(f"{self.root}/{name}/v-{version:06d}")
        return self.read(name, df.schema)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("append").parquet(self.path(name))
        return self.read(name)

    def truncate(self, name: str) -> DataFrame:
        schema = self.read(name).schema
        return self.overwrite(name, self.spark.createDataFrame([], schema))

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))
