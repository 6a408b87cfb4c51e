"""Weekly campaign counts kept up to date as delivery events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentry.sources.storage import new_path

KEYS = ["period", "campaign_id", "channel"]
VALUES = ["sends", "opens", "clicks", "conversions"]


def arriving(spark: SparkSession, folder: str, table: str, schema: StructType) -> DataFrame:
    """A Parquet table as a stream, whether it is a folder of part files or one file.

    The source watches a folder: the table's own, and for a single file the one around it.
    """
    reader = spark.readStream.schema(schema)
    files = spark.read.parquet(f"{folder}/{table}.parquet").inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{table}.parquet"):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return reader.parquet(f"{folder}/{table}.parquet")


def weekly_counts(campaign_events: DataFrame) -> DataFrame:
    """Counts per campaign, channel and week, of a batch of events."""
    def of(kind: str):
        return F.count_if(F.col("event_type") == kind)

    week = F.trunc(F.to_date("event_timestamp"), "week")
    return campaign_events.groupBy(week.alias("period"), "campaign_id", "channel").agg(
        of("send").alias("sends"), of("open").alias("opens"), of("click").alias("clicks"),
        of("convert").alias("conversions"),
    )


def run(campaign_events: DataFrame, path: str) -> None:
    """Process what has arrived and write the counts of each micro-batch.

    Counts add up over batches, so no state is kept, no week is ever closed
    and events may come late by any time. A batch overwrites its own folder, so a
    batch that is repeated after a failure leaves one copy.
    """
    def write(arrived: DataFrame, batch_id: int) -> None:
        weekly_counts(arrived).write.mode("overwrite").parquet(f"{path}/weeks/batch={batch_id}")

    (
        campaign_events.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    """The counts of every week: the sums over all batches."""
    rows = spark.read.option("basePath", f"{path}/weeks").parquet(f"{path}/weeks")
    return rows.groupBy(*KEYS).agg(*[F.sum(v).alias(v) for v in VALUES])


def weekly_state(campaign_events: DataFrame) -> DataFrame:
    """Drain the stream into a new folder and read the result."""
    spark = campaign_events.sparkSession
    path = new_path(spark, "weekly")
    run(campaign_events, path)
    return current(spark, path)
