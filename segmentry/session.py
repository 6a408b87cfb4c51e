"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps timestamp arithmetic equal to the timestamps without zone in the
# tables; adaptive execution coalesces small shuffles and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# For a large cluster: start wide, so that a shuffle partition of the largest
# aggregation fits into executor memory; adaptive execution merges small ones.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def session(app: str = "segmentry", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; the master is left to the cluster unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
