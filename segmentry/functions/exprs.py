"""Scalar expressions. All are built-in functions, so they stay inside code generation."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
EXACT = "decimal(28,8)"


def dec(text: str) -> Column:
    """A fixed-point literal; weights are exact, so sums do not depend on row order."""
    return F.lit(Decimal(text))


def ntz(moment: datetime) -> Column:
    """A literal without time zone. Comparing with it keeps the filter pushable to Parquet."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day(moment: datetime) -> Column:
    return F.lit(moment.date().isoformat()).cast("date")


def round_to(value: Column, digits: int) -> Column:
    """Round half up to a fixed-point number with ``digits`` decimals.

    Rounding a double directly depends on its binary form (2.675 has none);
    going through a decimal gives the same digit on every engine, and later
    sums of the result do not depend on row order.
    """
    return F.round(value.cast(EXACT), digits).cast(f"decimal({20 + digits},{digits})")


def safe_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``numerator / denominator`` rounded, and 0 where the denominator is 0 or NULL."""
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, round_to(ratio, digits)).otherwise(F.lit(0).cast("int"))


def mean(value: Column) -> Column:
    """Average of a fixed-point column as a double: exact sum, then one division."""
    return F.sum(value).cast("double") / F.count(value)


def _strict(pick, columns: tuple[Column, ...]) -> Column:
    missing = columns[0].isNull()
    for column in columns[1:]:
        missing = missing | column.isNull()
    return F.when(~missing, pick(*columns))


def strict_greatest(*columns: Column) -> Column:
    """``greatest`` that is NULL when any argument is NULL (Spark's skips NULLs)."""
    return _strict(F.greatest, columns)


def strict_least(*columns: Column) -> Column:
    """``least`` that is NULL when any argument is NULL (Spark's skips NULLs)."""
    return _strict(F.least, columns)


def clamp(value: Column, low: Column, high: Column) -> Column:
    return strict_greatest(strict_least(value, high), low)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights crossed from ``start`` to ``end``."""
    return F.datediff(end, start)


def years_between(start: Column, end: Column) -> Column:
    """Difference of the calendar years, so 31 December to 1 January counts 1."""
    return F.year(end) - F.year(start)


def shift_year(date: Column, as_of: Column, base_year: int) -> Column:
    """Move a date by whole years so that a plan made for ``base_year`` stays current."""
    return F.add_months(date, 12 * (F.year(as_of) - F.lit(base_year)))


def seconds_after(start: Column, seconds: Column) -> Column:
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def minutes_before(end: Column, minutes: Column) -> Column:
    return end - F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0).cast("decimal(18,6)"))


def utc_instant(moment: Column) -> Column:
    """A timestamp without zone read as UTC, to the second, whatever the session's zone.

    Watermarks need an instant; a plain cast would shift it by the session's zone.
    """
    days = F.datediff(moment, F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.timestamp_seconds(
        days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    )


def utc_date(instant: Column) -> Column:
    """The UTC date of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def hash_bucket(key: Column, salt: str, buckets: int = 1000) -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key and the salt only.

    The same key always falls into the same bucket, on any engine that has MD5.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def in_sample(key: Column, salt: str, rate: Column) -> Column:
    """True for about ``rate`` of the keys; a higher rate with the same salt gives a superset."""
    return hash_bucket(key, salt) < rate * F.lit(1000)


def slug(name: Column, length: int = 15) -> Column:
    """A short code from a free name: upper case, dashes for spaces, cut to ``length``."""
    return F.left(F.replace(F.upper(name), F.lit(" "), F.lit("-")), F.lit(length))


def search_text(*columns: Column) -> Column:
    """Join fields with a blank; a NULL field keeps its separator."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])


def cycle(values: list[str], position: Column) -> Column:
    """The value at ``position`` modulo the length of the list."""
    table = F.array(*[F.lit(v) for v in values])
    return F.element_at(table, (F.pmod(position, F.lit(len(values))) + 1).cast("int"))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")
