"""Purchase and engagement metrics of a moving year, refreshed from new events alone.

The raw events of a batch are reduced once to one row per customer and day and
kept as a folder of its own (``days``). A refresh then needs no older raw event:

* sums and counts of the year are those of the last refresh, plus the batch, minus
  the days that have left the year since;
* an active day counts when its customer has no earlier row of that day;
* the last purchase or activity lapses when it has left the year, as nothing later
  was there; the first purchase is taken from the days of the customers whose
  first purchase has left the year.

All four parts are rows of one union that a single aggregation by customer adds
up, combined before the shuffle. Days are laid out by month, so that expired days
and late days read only their months. Late events (of any earlier day) and events
dated after the clock enter like others; events older than the year are left out.

A batch is a folder named by the caller: writing it again replaces it, so a
repeated refresh adds nothing twice. ``compacted`` merges the folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.plans import profile
from segmentry.sources.storage import materialise, new_path

MONTH = profile.MONTH
COUNTS = [c for c in [*profile.PURCHASE_COLUMNS, *profile.ENGAGEMENT_COLUMNS] if "_count_" in c] + [
    "total_events_12m", "page_views_12m", "training_logs_12m", "goals_set_12m", "reviews_written_12m", "size_exchanges_12m"]
# spent: sum of purchase amounts; amounts: purchases with an amount; addends: what a sum of amounts adds, zeros included.
ADDED = [*COUNTS, "spent", "amounts", "addends"]
TIMES = {"first_purchase_date": F.min, "last_purchase_date": F.max, "last_activity_date": F.max}


@dataclass(frozen=True)
class State:
    """The refresh of ``as_of``: the year's totals per customer, and the folder of daily rows."""

    totals: DataFrame
    folder: str
    as_of: datetime


def _midnight(as_of: datetime) -> Column:
    """First moment of the year before ``as_of``; whole days only, as days are what leaves the year."""
    if as_of != datetime(as_of.year, as_of.month, as_of.day):
        raise ValueError("the clock of an incremental refresh is a midnight")
    return X.ntz(as_of) - F.expr("INTERVAL 1 YEAR")


def _sums(columns: list[str], sign: int = 1) -> list[Column]:
    return [(F.sum(c) * sign).alias(c) for c in columns]


def daily(events: DataFrame) -> DataFrame:
    """One row per customer and day: counts, sums, first and last times."""
    counted = {**profile.purchase_metrics(), **{
        c: e for c, e in profile.engagement_metrics(datetime(2000, 1, 1)).items() if c != "active_days_12m"}}
    bought = F.col("event_type") == "purchase"
    return events.withColumn("amount", profile.purchase_amount()).groupBy(
        "customer_id", F.to_date("event_timestamp").alias("day")).agg(
        *[counted[c].alias(c) for c in [*COUNTS, *TIMES]],
        F.coalesce(F.sum(F.when(bought, F.col("amount"))), F.lit(0)).cast(X.MONEY).alias("spent"), F.count("amount").alias("amounts"),
        F.count_if(~bought | F.col("amount").isNotNull() | F.col("event_type").isNull()).alias("addends")).withColumn(
        MONTH, F.trunc("day", "month"))


def _write(rows: DataFrame, folder: str, batch: str) -> DataFrame:
    path = f"{folder}/batch={batch}"
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _days(spark: SparkSession, like: DataFrame, folder: str) -> DataFrame:
    """All daily rows; ``batch`` names their folder."""
    return spark.read.schema(like.schema.add("batch", "string")).parquet(folder)


def start(events: DataFrame, as_of: datetime, batch: str = "first", folder: str | None = None) -> State:
    """The state of a first, full read of the events."""
    folder = folder or new_path(events.sparkSession, "days")
    days = _write(daily(events.filter(F.col("event_timestamp") >= _midnight(as_of))), folder, batch)
    totals = days.groupBy("customer_id").agg(
        *_sums(ADDED), *[f(c).alias(c) for c, f in TIMES.items()], F.count_distinct("day").alias("active_days_12m"))
    return State(materialise(totals, "year_totals"), folder, as_of)


def advance(state: State, events: DataFrame, as_of: datetime, batch: str) -> State:
    """The state at a later clock, after the new events that are in no earlier batch."""
    if as_of < state.as_of:
        raise ValueError("the clock does not go back")
    spark = events.sparkSession
    since = _midnight(as_of)
    first_day = since.cast("date")
    new = _write(daily(events.filter(F.col("event_timestamp") >= since)), state.folder, batch)
    old = _days(spark, new, state.folder).filter(F.col("batch") != batch)
    within = (F.col("day") >= first_day) & (F.col(MONTH) >= F.trunc(first_day, "month"))
    # The months of the batch are few; as literals they prune the folders.
    months = [r[0] for r in new.select(MONTH).distinct().collect()]
    known = old.filter(within & F.col(MONTH).isin(months)).select("customer_id", "day")
    left = (F.col("day") < first_day) & (F.col("day") >= _midnight(state.as_of).cast("date"))
    expired = old.filter(left & (F.col(MONTH) <= F.trunc(first_day, "month")) & (
        F.col(MONTH) >= F.trunc(_midnight(state.as_of).cast("date"), "month")))
    lapsed = state.totals.filter(F.col("first_purchase_date") < since).select("customer_id")
    nothing = [F.lit(None).cast("timestamp_ntz").alias(c) for c in TIMES]
    parts = [
        state.totals.select("customer_id", *ADDED, "active_days_12m", *[F.when(F.col(c) >= since, F.col(c)).alias(c) for c in TIMES]),
        new.groupBy("customer_id").agg(*_sums(ADDED), F.lit(0).cast("bigint").alias("active_days_12m"), *[f(c).alias(c) for c, f in TIMES.items()]),
        new.select("customer_id", "day").join(known, ["customer_id", "day"], "left_anti").groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("active_days_12m")),
        expired.groupBy("customer_id").agg(*_sums(ADDED, -1), (-F.count_distinct("day")).alias("active_days_12m"), *nothing),
        old.filter(within & F.col("first_purchase_date").isNotNull()).select("customer_id", "first_purchase_date").join(
            lapsed, "customer_id", "left_semi"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    totals = union.groupBy("customer_id").agg(
        *_sums([*ADDED, "active_days_12m"]), *[f(c).alias(c) for c, f in TIMES.items()]).filter(F.col("total_events_12m") > 0)
    return State(materialise(totals, "year_totals"), state.folder, as_of)


def compacted(state: State, batch: str) -> State:
    """The same state with one row per customer and day of the year in one new folder."""
    spark = state.totals.sparkSession
    days = spark.read.option("basePath", state.folder).parquet(state.folder)
    rows = days.filter(F.col("day") >= _midnight(state.as_of).cast("date")).groupBy("customer_id", "day").agg(
        *_sums(ADDED), *[f(c).alias(c) for c, f in TIMES.items()]).withColumns({
        "spent": F.col("spent").cast(X.MONEY), MONTH: F.trunc("day", "month")})
    folder = new_path(spark, "days")
    _write(rows, folder, batch)
    return State(state.totals, folder, state.as_of)


def metrics(state: State) -> DataFrame:
    """What ``profile.event_metrics`` gives at the state's clock."""
    spent = F.when(F.col("addends") > 0, F.col("spent"))
    derived = {"total_spend_12m": spent, "avg_order_value": F.when(F.col("amounts") > 0, F.col("spent").cast("double") / F.col("amounts"))}
    return state.totals.select("customer_id", *[
        derived[c].alias(c) if c in derived else F.col(c) for c in [*profile.PURCHASE_COLUMNS, *profile.ENGAGEMENT_COLUMNS]])
