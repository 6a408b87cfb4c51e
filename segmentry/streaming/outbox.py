"""Incremental delivery of staged audiences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmentry.plans.activation import pending

KEY_COLUMNS = ["customer_id", "campaign_name", "preferred_channel"]


def deliver(audiences: DataFrame, path: str) -> None:
    """Write newly staged pending rows as JSON per channel, once each.

    ``audiences`` is a stream. The batch number names the folder and the folder
    is overwritten, so a repeated batch is not sent twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("preferred_channel").json(
            f"{path}/out/batch={batch_id}"
        )

    (
        pending(audiences).writeStream
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    )


def delivered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Everything handed over so far."""
    return spark.read.schema(schema).option("basePath", f"{path}/out").json(f"{path}/out")
