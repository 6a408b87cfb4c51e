"""Global ranks without sending all rows through one task.

A window without ``PARTITION BY`` runs in a single task. Here the rows are
range-partitioned by the sort keys and sorted inside each partition; a row's
global rank is its place in its partition plus the number of rows in the lower
partitions. Those numbers are a table with one row for each partition, joined
back; the number of partitions is a session setting. There is one form for
every size.

Keys are columns sorted ascending with NULLs first; use :func:`descending` and
:func:`nulls_last` for other orders. The last key must be unique: ranks are
then the same on every run, and a value that very many rows share is spread
over several partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentry.operators import quantiles
from segmentry.sources.storage import materialise

# monotonically_increasing_id keeps the row's place in the low 33 bits.
_PLACE_BITS = 33


def descending(number: Column) -> Column:
    """Largest first, NULLs first."""
    return -number


def nulls_last(column: Column) -> Column:
    """Smallest first, NULLs last."""
    return F.struct(column.isNull().alias("absent"), column.alias("value"))


def row_numbers(df: DataFrame, name: str, keys: list[Column], total: str | None = None, written: bool = False) -> DataFrame:
    """Add ``name``: 1, 2, 3, … over all rows in key order; ``total`` names a column for the row count.

    The rows are written once before they are sampled for the ranges (unless
    ``df`` is ``written`` already) and once in order, so that every pass sees the
    same rows and partitions whatever happens to the executors.
    """
    df = df if written else materialise(df, "unranked")
    placed = materialise(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    # A window over one row for each partition.
    before = sizes.select(
        "_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counted = placed.select("*", part).join(before, "_part")
    more = [F.col("_total").alias(total)] if total else []
    return counted.select(*[F.col(f"`{c}`") for c in df.columns if c != name], (F.col("_before") + place + 1).alias(name), *more)


def _sorted_boundaries(df: DataFrame, keys: list[Column], n_tiles: int) -> list[Column]:
    """Literals of the keys of the last row of every tile but the last, by ranking the keys (for texts and floats)."""
    narrow = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    columns = [F.col(c) for c in narrow.columns]
    ranked = row_numbers(narrow, "rank", columns, total="total")
    # The first tiles take the remainder: tile t ends at t * size + min(t, extra).
    ends = F.array(*[F.expr(f"{t} * (total div {n_tiles}) + least({t}, total % {n_tiles})") for t in range(1, n_tiles)])
    # At most one row per boundary comes back, as text to keep its exact value.
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    found = (
        ranked.filter(F.array_contains(ends, F.col("rank"))).orderBy("rank")
        .select(F.to_json(F.struct(*columns), options).alias("key")).collect()
    )
    schema = StructType(narrow.schema.fields)
    return [F.from_json(F.lit(r["key"]), schema, options) for r in found]


def tiles(df: DataFrame, specs: dict[str, list[Column]], n_tiles: int) -> DataFrame:
    """Add one ``NTILE(n_tiles)`` column per entry of ``specs`` (name → keys).

    The boundary keys of all entries are found together by histogram refinement
    over the narrow keys, which are written once; nothing is sorted. The wide rows
    stay as they are: each compares its own key with the boundaries, so that a
    reader of few columns computes only those. Texts and floats are ranked instead.
    """
    numbers = {name: quantiles.whole_numbers(df, keys) for name, keys in specs.items()}
    columns = {name: [f"{name}_{i}" for i in range(len(found))] for name, found in numbers.items() if found}
    ends: dict[str, list[tuple[int, ...]]] = {}
    if columns:
        narrow = df.select(*[c.alias(alias) for name in columns for c, alias in zip(numbers[name], columns[name], strict=True)])
        ends = quantiles.boundaries(materialise(narrow, "tile_keys"), columns, n_tiles)
    labels = {}
    for name, keys in specs.items():
        label = F.lit(1)
        if name in ends:
            own = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(numbers[name])])
            rows = ", ".join("struct(" + ", ".join(f"CAST({x} AS BIGINT) AS k{i}" for i, x in enumerate(end)) + ")" for end in ends[name])
            label = F.size(F.filter(F.expr(f"array({rows})"), lambda end: end < own)) + 1 if rows else label  # noqa: B023
        else:
            own = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
            for boundary in _sorted_boundaries(df, keys, n_tiles):
                label = label + (own > boundary).cast("int")
        labels[name] = label
    return df.withColumns(labels)
