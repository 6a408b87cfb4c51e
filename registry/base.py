"""How a query and the SQL it is checked against are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, FloatType, IntegerType, ShortType

from segmentry.plans import profile, segments
from segmentry.sources import bindings
from segmentry.sources.bindings import AS_OF, load
from segmentry.sources.storage import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """The tables of one folder in the shape of the data model."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.dir, name)

    @cached_property
    def customers(self) -> DataFrame:
        return bindings.customers(self.spark, self.dir)

    @cached_property
    def events(self) -> DataFrame:
        return bindings.events(self.spark, self.dir)

    @cached_property
    def campaign_events(self) -> DataFrame:
        return bindings.campaign_events(self.spark, self.dir)

    @cached_property
    def paid_media(self) -> DataFrame:
        return bindings.paid_media(self.spark, self.dir)

    @cached_property
    def library(self) -> DataFrame:
        return bindings.library(self.spark, self.dir)

    @cached_property
    def categories(self) -> DataFrame:
        return bindings.categories(self.spark, self.dir)

    @cached_property
    def profiles(self) -> DataFrame:
        return profile.customer_360(
            self.customers, self.events, self.campaign_events, AS_OF
        )

    @cached_property
    def stored_profiles(self) -> DataFrame:
        """The profile as a written table, for queries that read it more than once."""
        return materialise(self.profiles, "customer-360")

    # Smallest segment of the registered queries; small, as the test tables are.
    min_size = 3

    @cached_property
    def segments(self) -> DataFrame:
        """Micro-segments of the stored profile."""
        return segments.micro_segments(self.stored_profiles, self.min_size)


def publish(df: DataFrame) -> DataFrame:
    """Plain types for comparison: whole numbers as bigint, fixed-point and float as double."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DecimalType, FloatType)):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (IntegerType, ShortType, ByteType)):
            column = column.cast("bigint").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(key: str, sql: str | None = None):
    """Register ``build(data)`` under ``key``, with the SQL of the same result."""

    def register(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return publish(build(Data(spark, sf_dir)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
