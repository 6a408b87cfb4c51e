"""Best rows, over all rows or per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Best ``k`` rows. Each task keeps ``k`` rows; nothing is sorted as a whole."""
    return df.orderBy(*order).limit(k)


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], k: int, name: str = "position",
    salt: Column | None = None, salts: int = 32,
) -> DataFrame:
    """Best ``k`` rows per group, numbered.

    Each group is first reduced in ``salts`` parts, by the hash of ``salt`` (by
    default of the whole row), then as a whole: for any ``k``, a group with a third
    of all rows is spread over tasks.
    """
    part = F.pmod(F.xxhash64(salt) if salt is not None else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
    parts = Window.partitionBy(*groups, "_part").orderBy(*order)
    reduced = (
        df.select("*", part.alias("_part"))
        .withColumn("_in_part", F.row_number().over(parts))
        .filter(F.col("_in_part") <= k)
        .drop("_part", "_in_part")
    )
    best = Window.partitionBy(*groups).orderBy(*order)
    return reduced.withColumn(name, F.row_number().over(best)).filter(F.col(name) <= k)
