"""Writes that keep a table's declared constraints.

Every row is judged while it is written: a value that its column's type cannot
hold, a missing value of a required column, a text over its length, a key that
comes twice. Good rows are appended to the table, the others go to a reject table
with the list of their faults and their row as text, and the counts of each fault are
observed in that same write. Parquet itself keeps none of these rules.

The judged rows are staged once, so that both tables are cut from the same rows
whatever happens to the executors; nothing is written to the table if more rows
are bad than allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from segmentry.sources.schemas import TableSchema
from segmentry.sources.storage import new_path


class TooManyRejects(ValueError):
    """More bad rows than the write allows; nothing was appended."""


@dataclass(frozen=True)
class Written:
    """Rows appended, rows rejected, and how often each fault was found."""

    rows: int
    rejected: int
    faults: dict[str, int]


def _faults(schema: TableSchema, rows: DataFrame) -> dict[str, Column]:
    found = {}
    for name, kind in schema.columns.items():
        given = F.col(f"`{name}`") if name in rows.columns else None
        if given is not None:
            found[f"{name}: type"] = given.isNotNull() & given.try_cast(kind).isNull()
        if name in schema.required:
            found[f"{name}: missing"] = given.isNull() if given is not None else F.lit(schema.defaults.get(name) is None)
        if given is not None and name in schema.lengths:
            found[f"{name}: length"] = F.length(given.try_cast("string")) > schema.lengths[name]
    return found


def judged(rows: DataFrame, schema: TableSchema, key: list[str] | None = None) -> DataFrame:
    """The rows with the table's columns and types, their ``_faults`` and, if there are any, ``_row``: the row as given, as JSON.

    ``key``: columns whose values may come once only in these rows; all rows of a repeated key are faulty.
    Columns that the table lacks are dropped; absent ones take their default, else NULL.
    """
    faults = _faults(schema, rows)
    if key:
        # Counted apart from the rows, so that a hot key weighs on no task.
        names = [f"_k{i}" for i in range(len(key))]
        counts = rows.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(key, names, strict=True)]).agg(
            F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n").withColumn("_twice", F.lit(True))
        same = F.lit(True)
        for k, n in zip(key, names, strict=True):
            same = same & rows[k].eqNullSafe(counts[n])
        faults[f"{', '.join(key)}: repeated"] = F.coalesce(F.col("_twice"), F.lit(False))
        rows = rows.join(counts, same, "left")
    listed = F.array_compact(F.array(*[F.when(bad, F.lit(fault)) for fault, bad in faults.items()]))
    given = [c for c in rows.columns if not c.startswith(("_k", "_twice"))]
    columns = [
        (F.col(f"`{n}`").try_cast(kind) if n in rows.columns else F.lit(schema.defaults.get(n)).cast(kind)).alias(n)
        for n, kind in schema.columns.items()]
    return rows.select(*columns, listed.alias("_faults"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in given])).alias("_given")).withColumn(
        "_row", F.when(F.size("_faults") > 0, F.col("_given"))).drop("_given")


def write(
    rows: DataFrame, schema: TableSchema, path: str, rejects: str, key: list[str] | None = None, most_rejected: int | None = None,
) -> Written:
    """Append the good rows to the Parquet table at ``path`` and the bad ones to ``rejects`` (columns faults, row)."""
    checked = judged(rows, schema, key)
    names = list(_faults(schema, rows)) + ([f"{', '.join(key)}: repeated"] if key else [])
    seen = Observation()
    bad = F.size("_faults") > 0
    counts = [F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"), *[
        F.count_if(F.array_contains("_faults", name)).alias(f"f{i}") for i, name in enumerate(names)]]
    staged = new_path(rows.sparkSession, "checked")
    checked.observe(seen, *counts).write.parquet(staged)
    found = seen.get
    out = Written(found["rows"], found["rejected"], {n: found[f"f{i}"] for i, n in enumerate(names) if found[f"f{i}"]})
    again = rows.sparkSession.read.schema(checked.schema).parquet(staged)
    if out.rejected:
        again.filter(bad).select(F.col("_faults").alias("faults"), F.col("_row").alias("row")).write.mode("append").parquet(rejects)
    if most_rejected is not None and out.rejected > most_rejected:
        raise TooManyRejects(f"{out.rejected} rows rejected: {out.faults}")
    again.filter(~bad).select(*schema.columns).write.mode("append").parquet(path)
    return out
