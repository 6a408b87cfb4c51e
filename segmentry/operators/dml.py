"""Changes to tables, as DataFrames: upsert, delete, partial insert, new ids.

Plain Parquet has no row-level changes; each function gives the table's next
content, which ``Tables.overwrite`` writes as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.operators import rank


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Update ``update`` where the key exists, insert the whole row where it does not.

    The job fails if ``source`` repeats a key (see :func:`latest`). A matched row
    takes the source's value even if that value is NULL.
    """
    fresh = source.groupBy(*keys).agg(F.first(F.struct(*source.columns)).alias("_new"), F.count(F.lit(1)).alias("_n"))
    once = F.assert_true(F.col("_n") == 1, F.lit("the source of an upsert repeats a key")).isNull()
    fresh = fresh.filter(once).drop("_n")
    kept = target.select(*keys, F.struct(*target.columns).alias("_old"))
    joined = kept.join(fresh, keys, "full")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        new = F.col(f"_new.{name}") if name in source.columns else F.lit(None)
        old = F.col(f"_old.{name}")
        matched = new if name in update else old
        columns.append(
            F.when(both, matched).when(F.col("_new").isNotNull(), new).otherwise(old).alias(name)
        )
    return joined.select(*columns)


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row per key. An aggregation, so copies of one key combine before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    # A row without an order counts as earlier than any with one.
    by = F.struct(order.isNotNull().alias("known"), order.alias("order"))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Rows the predicate does not hold for; an undecided (NULL) predicate keeps the row."""
    return table.filter(~F.coalesce(predicate, F.lit(False)))


def with_new_ids(rows: DataFrame, name: str, order: list[Column], after: int = 0) -> DataFrame:
    """Number new rows from ``after + 1`` on, without a gap."""
    numbered = rank.row_numbers(rows, name, order)
    return numbered.withColumn(name, F.col(name) + F.lit(after))
