"""Incremental refreshes against full builds, and checked writes."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from segmentry.plans import incremental, profile
from segmentry.sources import checked
from segmentry.sources.schemas import ASSETS, AUDIENCES, TABLES
from tests.conftest import rows

KINDS = ["purchase", "purchase", "return", "page_view", "search", "gear_review", "add_to_cart", None, "unknown"]
CLOCKS = [datetime(2024, 2, 29), datetime(2024, 3, 1), datetime(2024, 11, 5), datetime(2025, 2, 28), datetime(2026, 1, 1)]


@pytest.fixture(scope="module")
def stream(spark):
    """Events over three years, a third of them of one customer, each with the refresh that it arrives for."""
    draw = random.Random(11)
    data = []
    for i in range(4_000):
        at = datetime(2023, 2, 1) + timedelta(hours=draw.randrange(0, 24 * 1080), seconds=draw.randrange(3600))
        due = next((k for k, clock in enumerate(CLOCKS) if at < clock), len(CLOCKS) - 1)
        kind = draw.choice(KINDS)
        amount = {} if draw.random() < 0.1 else {"amount": draw.randrange(1, 9_999) / 100}
        # Some come late, some are dated after the clock of their refresh.
        data.append((0 if i % 3 == 0 else draw.randrange(1, 60), kind, at, json.dumps(amount), max(0, min(len(CLOCKS) - 1, due + draw.choice([0] * 8 + [1, 2, -1])))))
    return spark.createDataFrame(data, "customer_id bigint, event_type string, event_timestamp timestamp_ntz, event_properties string, batch int")


def test_refreshes_equal_full_builds(stream):
    state = incremental.start(stream.filter("batch = 0"), CLOCKS[0])
    for i, clock in enumerate(CLOCKS):
        if i:
            state = incremental.advance(state, stream.filter(F.col("batch") == i), clock, f"b{i}")
        if i == 2:
            state = incremental.compacted(state, "compact")
        full = profile.event_metrics(stream.filter(F.col("batch") <= i), clock)
        got = incremental.metrics(state)
        assert got.columns == full.columns and rows(got) == rows(full)


def test_a_repeated_batch_adds_nothing(stream):
    before = incremental.start(stream.filter("batch = 0"), CLOCKS[0])
    arrived = stream.filter("batch = 1")
    first = rows(incremental.metrics(incremental.advance(before, arrived, CLOCKS[1], "b1")))
    assert rows(incremental.metrics(incremental.advance(before, arrived, CLOCKS[1], "b1"))) == first
    again = incremental.advance(before, arrived, CLOCKS[1], "b1")
    nothing = incremental.advance(again, stream.limit(0), CLOCKS[1], "empty")
    assert rows(incremental.metrics(nothing)) == first


def test_clock_rules(stream):
    with pytest.raises(ValueError):
        incremental.start(stream, datetime(2024, 1, 1, 5))
    state = incremental.start(stream.limit(0), CLOCKS[1])
    assert incremental.metrics(state).count() == 0
    with pytest.raises(ValueError):
        incremental.advance(state, stream, CLOCKS[0], "back")


def test_a_refresh_reads_new_events_and_pruned_days(spark, stream, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    stream.write.partitionBy("batch").parquet(path)
    state = incremental.start(spark.read.parquet(path).filter("batch = 0"), CLOCKS[0])
    plans = []
    monkeypatch.setattr(incremental, "materialise", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    incremental.advance(state, spark.read.parquet(path).filter("batch = 1"), CLOCKS[1], "b1")
    assert "event_properties" not in plans[0]
    assert plans[0].count("PartitionFilters: [isnotnull(batch") == 3 and plans[0].count("isnotnull(event_month") == 3


def test_every_fault_is_rejected_with_its_row(spark, tmp_path):
    data = [("A1", "c", "9.5"), ("A2", "c" * 31, "9.5"), (None, "c", "x"), ("A4", None, "123456"), ("A5", "c", None), ("A5", "d", "1"), ("A6", "c", "1.239")]
    raw = spark.createDataFrame(data, "asset_id string, campaign_id string, brand_voice_score string").withColumn("extra", F.lit(1))
    path, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    done = checked.write(raw, ASSETS, path, rejects, key=["asset_id"])
    assert done == checked.Written(2, 5, {"asset_id: missing": 1, "campaign_id: length": 1, "brand_voice_score: type": 2, "asset_id: repeated": 2})
    kept = spark.read.parquet(path)
    assert kept.schema["brand_voice_score"].dataType.simpleString() == "decimal(4,2)" and "extra" not in kept.columns
    assert sorted((r.asset_id, str(r.brand_voice_score), r.approval_status) for r in kept.collect()) == [("A1", "9.50", "draft"), ("A6", "1.24", "draft")]
    bad = {json.loads(r.row).get("asset_id"): r.faults for r in spark.read.parquet(rejects).collect()}
    assert bad["A2"] == ["campaign_id: length"] and bad[None] == ["asset_id: missing", "brand_voice_score: type"] and bad["A5"] == ["asset_id: repeated"]


def test_too_many_rejects_append_nothing(spark, tmp_path):
    raw = spark.createDataFrame([(None, 1, "n", "c"), (1, 2, "n", "c")], "segment_id bigint, customer_id bigint, segment_name string, campaign_name string")
    with pytest.raises(checked.TooManyRejects):
        checked.write(raw, AUDIENCES, str(tmp_path / "t"), str(tmp_path / "r"), most_rejected=0)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1 and not (tmp_path / "t").exists()


def test_a_missing_required_column_rejects_all(spark, tmp_path):
    done = checked.write(spark.range(3).selectExpr("'S' || id AS store_id"), TABLES["stores"], str(tmp_path / "t"), str(tmp_path / "r"))
    assert done.rows == 0 and done.rejected == 3 and done.faults["city: missing"] == 3


def test_declared_tables():
    assert len(TABLES) == 18
    stores = TABLES["stores"]
    assert stores.lengths["state"] == 2 and "opened_date" not in stores.required and stores.columns["state"] == "string"
    assert TABLES["loyalty_tiers"].columns["points_multiplier"] == "decimal(4,2)" and TABLES["channel_templates"].defaults == {"active": "true"}
    assert TABLES["audience_segments"].columns["micro_segment_ids"] == "array<int>"
