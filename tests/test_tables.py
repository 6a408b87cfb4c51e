from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from segmentry.operators import dml
from segmentry.plans import refresh, writeback
from segmentry.sources.schemas import ASSETS, BRIEFS
from segmentry.sources.storage import CLEANUP, Tables, materialise, shared_dir
from tests.conftest import rows

FIRST, LATER = datetime(2024, 6, 1, 9, 30, 5), datetime(2024, 6, 2, 10, 0, 0)


def test_upsert_hit_miss_and_null(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, keep string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(dml.upsert(target, source, ["k"], ["v"])) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]


def test_latest_row_per_key_with_a_hot_key(spark):
    data = [(0 if i % 3 else i, i, f"v{i}") for i in range(900)]
    got = dml.latest(spark.createDataFrame(data, "k int, n int, v string"), ["k"], F.col("n"))
    want = {}
    for k, n, v in data:
        want[k] = max(want.get(k, (-1, "")), (n, v))
    assert {r.k: (r.n, r.v) for r in got.collect()} == want


def test_delete_keeps_undecided_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert rows(dml.delete_where(df, F.col("x") > 3)) == [(1,), (None,)]


def test_table_can_be_rewritten_from_itself(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("t", spark.range(5))
    tables.append("t", spark.range(5, 8))
    assert tables.read("t").count() == 8
    tables.overwrite("t", tables.read("t").filter("id % 2 = 0"))
    assert rows(tables.read("t")) == [(0,), (2,), (4,), (6,)]
    assert tables.truncate("t").count() == 0 and tables.read("t").columns == ["id"]
    with pytest.raises(KeyError):
        tables.read("unknown")


def test_unfinished_version_is_not_read(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("t", spark.range(3))
    spark.range(9).write.parquet(f"{tmp_path}/t/v-000001")
    (tmp_path / "t" / "v-000001" / "_SUCCESS").unlink()
    assert tables.read("t").count() == 3
    assert tables.overwrite("t", spark.range(4)).count() == 4


def test_materialised_rows_lie_in_the_shared_folder(spark):
    stored = materialise(spark.range(10))
    assert shared_dir(spark) in stored.inputFiles()[0]
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_refresh_runs_parents_first_and_once(spark, tmp_path):
    seen = []

    def build(name, frame):
        def run(done):
            seen.append(name)
            return frame(done)
        return run

    chain = [
        refresh.Derived("child", build("child", lambda d: d["parent"].groupBy().count()), ("parent",)),
        refresh.Derived("parent", build("parent", lambda d: spark.range(7))),
    ]
    done = refresh.refresh(Tables(spark, str(tmp_path)), chain)
    assert seen == ["parent", "child"] and done["child"].first()["count"] == 7
    with pytest.raises(ValueError):
        refresh.refresh(Tables(spark, str(tmp_path)), [refresh.Derived("a", lambda d: None, ("b",))])


def submissions(spark, *items):
    data = [(c, json.dumps(b), i) for i, (c, b) in enumerate(items)]
    return spark.createDataFrame(data, "campaign_id string, brief_json string, sequence bigint")


def test_briefs_are_upserted(spark):
    empty = spark.createDataFrame([], BRIEFS.ddl())
    first = writeback.save_briefs(empty, submissions(
        spark,
        ("CMP-2025-001", {"brief_id": "B1", "created_by": "ann"}),
        ("CMP-2025-001", {"created_by": "bob", "status": "approved"}),
        ("CMP-2025-001", {"created_by": "cid"}),
    ), FIRST)
    got = {r.brief_id: r for r in first.collect()}
    made = [k for k in got if k.startswith("BRF-2025-001-093005-")]
    assert len(got) == 3 and len(made) == 2  # same second, still two ids
    assert got["B1"].status == "draft" and got["B1"].created_at == FIRST
    saved = spark.createDataFrame(first.collect(), first.schema)
    again = writeback.save_briefs(saved, submissions(
        spark, ("CMP-2", {"brief_id": "B1", "status": "approved"}), ("CMP-3", {"brief_id": "B1", "status": "archived"}),
        ("CMP-4", {"brief_id": "B9"}),
    ), LATER)
    got = {r.brief_id: r for r in again.collect()}
    assert len(got) == 4
    assert (got["B1"].campaign_id, got["B1"].status, got["B1"].created_by) == ("CMP-3", "archived", None)
    assert got["B1"].created_at == FIRST and got["B9"].created_at == LATER


ASSET_ROWS = "brief_id string, asset_json string, sequence bigint"


def test_equal_submissions_stay_apart(spark):
    same = json.dumps({"channel": "email", "content_body": "hi"})
    empty = spark.createDataFrame([], ASSETS.ddl())
    twice = spark.createDataFrame([("BRF-7", same, 1), ("BRF-7", same, 2)], ASSET_ROWS)
    assert writeback.save_assets(empty, twice, FIRST).select("asset_id").distinct().count() == 2
    given = [("BRF-7", json.dumps({"asset_id": "A1", "headline": h}), n) for n, h in enumerate(("old", "new"))]
    (only,) = writeback.save_assets(empty, spark.createDataFrame(given, ASSET_ROWS), FIRST).collect()
    assert (only.asset_id, only.headline) == ("A1", "new")
    briefs = submissions(spark, *[("CMP-1", {"created_by": "ann"})] * 3)
    assert writeback.save_briefs(spark.createDataFrame([], BRIEFS.ddl()), briefs, FIRST).count() == 3


def test_unreadable_score_fails(spark):
    bad = spark.createDataFrame([("BRF-7", json.dumps({"brand_voice_score": "none"}), 1)], ASSET_ROWS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        writeback.parsed_assets(bad, FIRST).collect()


def test_latest_with_unknown_order_and_repeated_source_keys(spark):
    rows_ = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", 5, 3)], "k string, at int, v int")
    assert rows(dml.latest(rows_, ["k"], F.col("at")).select("k", "v")) == [("a", 1), ("b", 3)]
    with pytest.raises(Exception, match="repeats a key"):
        dml.upsert(rows_, rows_, ["k"], ["v"]).collect()


def test_assets_are_parsed_with_defaults(spark):
    items = [("BRF-7", {"channel": "email", "content_body": "hi", "brand_voice_score": 7.5}),
             ("BRF-7", {"asset_id": "A1", "approval_status": "approved", "brand_voice_score": None})]
    df = spark.createDataFrame([(b, json.dumps(a), i) for i, (b, a) in enumerate(items)], ASSET_ROWS)
    saved = {r.asset_id: r for r in writeback.save_assets(spark.createDataFrame([], ASSETS.ddl()), df, FIRST).collect()}
    made = next(k for k in saved if k != "A1")
    assert made.startswith("AST-7-EMA-093005-")
    assert saved[made].approval_status == "draft" and float(saved[made].brand_voice_score) == 8
    assert saved["A1"].approval_status == "approved" and saved["A1"].brand_voice_score is None


def test_row_counts(spark):
    got = refresh.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got) == [("a", 3), ("b", 0)]


def test_materialise_leaves_the_session_as_it_was(spark):
    for own in (None, "false"):
        if own:
            spark.conf.set(CLEANUP, own)
        counted = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
        written = materialise(counted)
        assert sorted(written.collect()) == sorted(counted.collect())
        with pytest.raises(Exception):
            materialise(spark.range(1).select(F.raise_error(F.lit("no")).alias("x")))
        assert spark.conf.get(CLEANUP, None) == own
    spark.conf.unset(CLEANUP)
