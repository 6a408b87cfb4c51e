"""Exact boundary keys of equal tiles without sorting, by histogram refinement.

Every key is a list of whole numbers. One pass counts the rows of all keys in
equal ranges of the first number that still differs; only the ranges that hold a
boundary are looked at again, in finer steps, until they hold few rows or one
key. A pass is one aggregation with a few thousand groups, combined before the
shuffle; no pass sorts or moves rows, whatever the number of rows that share a
value. Each pass divides a range by ``STEPS``, so their number grows with the
digits of the keys, not with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS = 1024
FEW = 1024


class Range(NamedTuple):
    """Rows of one key whose numbers lie within bounds; bounds after the first open number only inform."""

    name: str
    bounds: tuple[tuple[int, int], ...]
    rows: int

    @property
    def open(self) -> int | None:
        """The first number that still differs."""
        return next((i for i, (low, high) in enumerate(self.bounds) if low < high), None)

    @property
    def step(self) -> int:
        low, high = self.bounds[self.open]
        return -(-(high - low + 1) // STEPS)

    def holds(self, columns: Sequence[str]) -> str:
        """The condition that a row belongs to the range."""
        last = len(columns) if self.open is None else self.open + 1
        return " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in zip(columns[:last], self.bounds[:last], strict=True))


def whole_numbers(df: DataFrame, keys: list[Column]) -> list[Column] | None:
    """The keys as bigint columns of the same order without NULLs; None if there are texts, floats or long decimals."""
    out: list[Column] = []

    def add(value: Column, kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(add(value[field.name], field.dataType) for field in kind.fields)
        if isinstance(kind, T.DecimalType) and kind.precision <= 18:
            number = (value * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")
        elif isinstance(kind, T.DateType):
            number = F.unix_date(value).cast("bigint")
        elif isinstance(kind, T.TimestampNTZType):
            number = F.unix_micros(value.cast("timestamp"))
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            number = value.cast("bigint")
        else:
            return False
        # NULLs first.
        out.extend([value.isNotNull().cast("bigint"), F.coalesce(number, F.lit(0).cast("bigint"))])
        return True

    kinds = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).schema
    return out if all(add(k, f.dataType) for k, f in zip(keys, kinds, strict=True)) else None


def _bounds(columns: list[str]) -> list[str]:
    return [f"{f}({c}) AS {f}_{c}" for c in columns for f in ("min", "max")]


def _hits(numbers: DataFrame, keys: dict[str, list[str]], ranges: list[Range], parts: bool) -> DataFrame:
    """A row for each range that a row of ``numbers`` lies in: the range's place, its part and the key's numbers x_0, x_1, …"""
    width = max(map(len, keys.values()))
    found = []
    for i, r in enumerate(ranges):
        own = [*keys[r.name], *["0L"] * (width - len(keys[r.name]))]
        # ``div`` rounds towards zero, which keeps the order.
        part = f"{keys[r.name][r.open]} div {r.step}" if parts else "0L"
        row = ", ".join([f"{i} AS range", f"{part} AS part", *[f"{c} AS x_{j}" for j, c in enumerate(own)]])
        found.append(f"CASE WHEN {r.holds(keys[r.name])} THEN struct({row}) END")
    return numbers.selectExpr(f"inline(filter(array({', '.join(found)}), h -> h IS NOT NULL))")


def _refined(numbers: DataFrame, keys: dict[str, list[str]], ranges: list[Range]) -> dict[Range, list[Range]]:
    """The filled parts of each range, in order, by one pass over the rows."""
    width = max(map(len, keys.values()))
    counts = [F.expr(c) for c in ("count(1) AS rows", *_bounds([f"x_{j}" for j in range(width)]))]
    found = _hits(numbers, keys, ranges, parts=True).groupBy("range", "part").agg(*counts)
    out: dict[Range, list[Range]] = {r: [] for r in ranges}
    for i, _, rows, *bounds in sorted(found.collect()):
        r = ranges[i]
        out[r].append(Range(r.name, tuple(zip(bounds[::2], bounds[1::2], strict=True))[: len(r.bounds)], rows))
    return out


def _exact(numbers: DataFrame, keys: dict[str, list[str]], ranges: list[Range]) -> dict[Range, list[tuple[int, ...]]]:
    """The sorted keys of ranges of few rows."""
    out: dict[Range, list[tuple[int, ...]]] = {r: [] for r in ranges}
    for i, _, *numbers_ in _hits(numbers, keys, ranges, parts=False).collect():
        out[ranges[i]].append(tuple(numbers_[: len(ranges[i].bounds)]))
    return {r: sorted(found) for r, found in out.items()}


def boundaries(numbers: DataFrame, keys: dict[str, list[str]], n_tiles: int) -> dict[str, list[tuple[int, ...]]]:
    """For each key (name → its bigint columns in ``numbers``) the last key of every tile but the last.

    The driver holds at most ``STEPS`` counts or ``FEW`` rows for each boundary.
    """
    whole = numbers.selectExpr("count(1) AS rows", *[b for columns in keys.values() for b in _bounds(columns)]).first()
    total = whole["rows"]
    # The first tiles take the remainder; an empty tile has no boundary of its own.
    ends = [t * (total // n_tiles) + min(t, total % n_tiles) for t in range(1, n_tiles)]
    wanted: dict[tuple[str, int], tuple[Range, int]] = {
        (name, t): (Range(name, tuple((whole[f"min_{c}"], whole[f"max_{c}"]) for c in columns), total), end)
        for name, columns in keys.items() for t, end in enumerate(ends) if 0 < end < total}
    while coarse := list(dict.fromkeys(r for r, _ in wanted.values() if r.open is not None and r.rows > FEW)):
        parts = _refined(numbers, keys, coarse)
        for key, (r, place) in wanted.items():
            for part in parts.get(r, ()):
                if place <= part.rows:
                    wanted[key] = (part, place)
                    break
                place -= part.rows
    small = list(dict.fromkeys(r for r, _ in wanted.values() if r.open is not None))
    rows = _exact(numbers, keys, small) if small else {}
    out: dict[str, list[tuple[int, ...]]] = {name: [] for name in keys}
    for (name, _), (r, place) in sorted(wanted.items(), key=lambda x: x[0]):
        out[name].append(rows[r][place - 1] if r in rows else tuple(low for low, _ in r.bounds))
    return out
