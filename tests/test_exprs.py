from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from segmentry.functions import exprs as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_strict_greatest_and_least_are_null_when_an_argument_is(spark):
    df = spark.createDataFrame([(None, 1), (0, 1), (5, 1)], "a int, b int")
    got = [tuple(r) for r in df.select(X.strict_greatest(F.col("a"), F.col("b")), X.strict_least(F.col("a"), F.col("b"))).collect()]
    assert got == [(None, None), (1, 0), (5, 1)]


def test_rounding_is_half_up_on_decimals(spark):
    for text, digits, want in [("2.675", 2, 2.68), ("0.125", 2, 0.13), ("2.5", 0, 3.0), ("-2.5", 0, -3.0)]:
        assert float(one(spark, X.round_to(F.lit(float(text)), digits))) == want


def test_safe_ratio_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (None, 2)], "n int, d int")
    got = [r[0] if r[0] is None else float(r[0]) for r in df.select(X.safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [0.3333, 0.0, 0.0, None]


def test_year_difference_counts_calendar_years(spark):
    start, end = F.lit("2000-12-31").cast("date"), F.lit("2001-01-01").cast("date")
    assert one(spark, X.years_between(start, end)) == 1
    assert one(spark, X.days_between(start, end)) == 1


def test_one_year_before_a_leap_day(spark):
    bound = X.ntz(datetime(2024, 2, 29, 12)) - F.expr("INTERVAL 1 YEAR")
    assert one(spark, bound) == datetime(2023, 2, 28, 12)


def test_shift_year_keeps_month_and_day(spark):
    moved = X.shift_year(F.lit("2025-03-01").cast("date"), F.lit("2027-06-30").cast("date"), 2025)
    assert one(spark, moved) == date(2027, 3, 1)


def test_slug_and_search_text(spark):
    assert one(spark, X.slug(F.lit("Welcome series q3 launch"))) == "WELCOME-SERIES-"
    assert one(spark, X.search_text(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "a  b"


def test_hash_bucket_matches_its_definition(spark):
    want = int(hashlib.md5(b"42open").hexdigest()[:8], 16) % 1000
    assert one(spark, X.hash_bucket(F.lit(42), "open")) == want


def test_sample_grows_with_the_rate(spark):
    ids = spark.range(2000)
    small = {r.id for r in ids.filter(X.in_sample(F.col("id"), "s", F.lit(0.1))).collect()}
    large = {r.id for r in ids.filter(X.in_sample(F.col("id"), "s", F.lit(0.3))).collect()}
    assert small < large and 120 < len(small) < 280 and 500 < len(large) < 700


def test_moduli_that_are_coprime_are_independent(spark):
    counts = spark.range(3000).groupBy((F.col("id") % 10).alias("a"), (F.col("id") % 3).alias("b")).count()
    assert {r["count"] for r in counts.collect()} == {100}
