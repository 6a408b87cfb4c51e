"""Full refresh of the derived tables, parents before children."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.sources.storage import Tables


@dataclass(frozen=True)
class Derived:
    """A materialised table: how to compute it from the tables it depends on."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    after: tuple[str, ...] = ()


def refresh(tables: Tables, wanted: list[Derived]) -> dict[str, DataFrame]:
    """Rewrite each table once, in dependency order.

    A child reads the written parent, so the parent's plan runs a single time.
    """
    done: dict[str, DataFrame] = {}
    waiting = list(wanted)
    while waiting:
        ready = [d for d in waiting if all(a in done for a in d.after)]
        if not ready:
            raise ValueError("circular dependency: " + ", ".join(d.name for d in waiting))
        for derived in ready:
            done[derived.name] = tables.overwrite(derived.name, derived.build(done))
            waiting.remove(derived)
    return done


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as one frame, for an audit."""
    out = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out
