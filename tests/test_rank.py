from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from segmentry.operators import dml, quantiles, rank
from segmentry.operators.topk import top_per_group


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some are NULL."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        x = 548 if i % 3 == 0 else rng.choice([None, *range(400)])
        data.append((i, x, f"n{rng.randrange(50)}"))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, x int, name string").repartition(5)


def orders():
    return {
        "ascending": ([F.col("x"), F.col("id")], [F.col("x").asc_nulls_first(), F.col("id")]),
        "descending": ([rank.descending(F.col("x")), F.col("id")], [F.col("x").desc_nulls_first(), F.col("id")]),
        "nulls last": ([rank.nulls_last(F.col("x")), F.col("id")], [F.col("x").asc_nulls_last(), F.col("id")]),
        "text": ([F.col("name"), rank.descending(F.col("id"))], [F.col("name"), F.col("id").desc()]),
    }


@pytest.mark.parametrize("name", ["ascending", "descending", "nulls last", "text"])
def test_partitioned_row_numbers_equal_the_window(spark, skewed, name):
    keys, window = orders()[name]
    want = {r.id: r.n for r in skewed.withColumn("n", F.row_number().over(Window.orderBy(*window))).collect()}
    split = rank.row_numbers(skewed, "n", keys)
    assert {r.id: r.n for r in split.collect()} == want
    # The only single task works on one row for each partition.
    plan = split._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan.split("Join")[0]


@pytest.mark.parametrize("name", ["ascending", "descending", "nulls last", "text"])
@pytest.mark.parametrize("tiles", [5, 7])
def test_boundary_tiles_equal_the_window(spark, skewed, name, tiles):
    keys, window = orders()[name]
    want = {r.id: r.t for r in skewed.withColumn("t", F.ntile(tiles).over(Window.orderBy(*window))).collect()}
    got = rank.tiles(skewed, {"t": keys}, tiles)
    assert {r.id: r.t for r in got.collect()} == want


def test_refinement_over_hot_values_negatives_and_wide_ranges(spark, monkeypatch):
    """Many rounds: few steps, a third of the rows on one value, numbers at both ends of 64 bits."""
    monkeypatch.setattr(quantiles, "STEPS", 3)
    monkeypatch.setattr(quantiles, "FEW", 4)
    rng = random.Random(9)
    big = [rng.choice([-(2**62), 2**62, -1, 0, 1, None, rng.randrange(-(2**40), 2**40)]) for _ in range(900)]
    data = [(i - 450, b, None if i % 7 == 0 else Decimal(rng.randrange(-999, 999)) / 100, bool(i % 3)) for i, b in enumerate(big)]
    df = spark.createDataFrame(data, "id bigint, big bigint, money decimal(18,2), flag boolean").repartition(4)
    specs = {"a": [F.col("big"), F.col("id")], "b": [rank.descending(F.col("money")), F.col("id")],
             "c": [rank.nulls_last(F.col("money")), rank.descending(F.col("id"))], "d": [F.col("flag"), F.col("id")]}
    order = {"a": [F.col("big").asc_nulls_first(), F.col("id")], "b": [F.col("money").desc_nulls_first(), F.col("id")],
             "c": [F.col("money").asc_nulls_last(), F.col("id").desc()], "d": [F.col("flag"), F.col("id")]}
    want = df.withColumns({n: F.ntile(7).over(Window.orderBy(*o)) for n, o in order.items()})
    assert sorted(rank.tiles(df, specs, 7).collect()) == sorted(want.collect())


def test_tiles_sort_nothing_and_keep_pruning(spark, sf_dir, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5_000).selectExpr("id", "id % 50 x", "uuid() other").write.parquet(path)
    got = rank.tiles(spark.read.parquet(path), {"t": [F.col("x"), F.col("id")]}, 5).select("id", "t")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "other" not in plan.split("ReadSchema")[1]


def test_fewer_rows_than_tiles(spark):
    df = spark.range(3)
    got = rank.tiles(df, {"t": [F.col("id")]}, 5)
    assert [(r.id, r.t) for r in got.orderBy("id").collect()] == [(0, 1), (1, 2), (2, 3)]
    assert rank.tiles(df.filter("false"), {"t": [F.col("id")]}, 5).count() == 0


def test_no_partition_holds_all_copies_of_a_hot_value(spark, skewed):
    parts = skewed.repartitionByRange(15, "x", "id").groupBy(F.spark_partition_id().alias("p")).count()
    assert max(r["count"] for r in parts.collect()) < 3000 / 3


def test_new_ids_continue_without_gap(spark):
    got = dml.with_new_ids(spark.range(10), "new", [F.col("id")], after=100)
    assert [r.new for r in got.orderBy("id").collect()] == list(range(101, 111))


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_with_a_hot_group(spark, k):
    data = [("hot" if i % 3 else f"g{i % 7}", i, (i * 7919) % 1009) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, id bigint, score int")
    got = top_per_group(df, ["g"], [F.col("score").desc(), F.col("id")], k, salt=F.col("id"), salts=4)
    want = {}
    for g, i, s in data:
        want.setdefault(g, []).append((-s, i))
    expected = {(g, p + 1, i) for g, v in want.items() for p, (_, i) in enumerate(sorted(v)[:k])}
    assert {(r.g, r.position, r.id) for r in got.collect()} == expected
