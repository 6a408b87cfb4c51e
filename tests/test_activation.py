from __future__ import annotations

import json
from datetime import datetime
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from segmentry.plans import activation
from segmentry.sources.schemas import ASSETS, AUDIENCES
from tests.conftest import rows

NOW = datetime(2024, 6, 1, 9, 30)


@pytest.fixture(scope="module")
def world(spark):
    profiles = spark.createDataFrame(
        [(i, f"{i}@x", f"n{i}", "email" if i % 2 else "sms", "Loyal", "Low", float(i % 7)) for i in range(60)],
        "customer_id bigint, email string, first_name string, preferred_channel string, rfm_segment string, "
        "churn_risk_tier string, customer_health_score double",
    )
    segments = spark.createDataFrame(
        [(1, "Loyal / Low Churn / EMAIL", "Loyal", "Low", "email", 0.02),
         (2, "Loyal / Low Churn / SMS", "Loyal", "Low", "sms", 0.5),
         (3, "New / High Churn / SMS", "New", "High", "sms", None)],
        "segment_id bigint, segment_name string, rfm_segment string, churn_risk_tier string, "
        "preferred_channel string, avg_campaign_conversion_rate double",
    )
    return profiles, segments, spark.createDataFrame([], AUDIENCES.ddl())


def test_second_activation_stages_nobody(spark, world):
    profiles, segments, empty = world
    first = activation.activate_segment(profiles, segments, empty, 1, "Summer", NOW)
    staged = first.rows.collect()
    assert len(staged) == 30 and all(r.preferred_channel == "email" for r in staged)
    assert sorted(r.priority_rank for r in staged) == list(range(1, 31))
    table = spark.createDataFrame(staged, first.rows.schema)
    second = activation.activate_segment(profiles, segments, table, 1, "Summer", NOW)
    assert second.rows.count() == 0
    summary = json.loads(second.summary.first().result)
    assert summary == {
        "customers_staged": 30, "segment_id": 1, "segment_name": "Loyal / Low Churn / EMAIL",
        "campaign_name": "Summer", "campaign_id": "SUMMER-" + md5(b"Summer").hexdigest(), "status": "success",
    }
    other = activation.activate_segment(profiles, segments, table, 1, "Winter", NOW)
    assert other.rows.count() == 30


def test_priority_follows_health_then_id(world):
    profiles, segments, empty = world
    got = activation.activate_segment(profiles, segments, empty, 2, "Summer", NOW).rows
    order = [r.customer_id for r in got.orderBy("priority_rank").collect()]
    assert order == sorted((i for i in range(60) if i % 2 == 0), key=lambda i: (-(i % 7), i))


def test_delivered_customers_can_be_staged_again(spark, world):
    profiles, segments, empty = world
    staged = activation.activate_segment(profiles, segments, empty, 1, "Summer", NOW).rows
    served = activation.mark_activated(staged, NOW)
    assert {r.status for r in served.select("status").distinct().collect()} == {"activated"}
    assert activation.pending(served).count() == 0
    assert activation.activate_segment(profiles, segments, served, 1, "Summer", NOW).rows.count() == 30


def test_campaign_id_of_the_linked_asset(spark, world):
    profiles, segments, empty = world
    assets = ASSETS.fill(spark.createDataFrame([("AST-1", "CMP-9")], "asset_id string, campaign_id string"))

    def campaign(content_id):
        done = activation.activate_segment(
            profiles, segments, empty, 1, "Big summer sale now", NOW, content_id, assets)
        return json.loads(done.summary.first().result)["campaign_id"]

    assert campaign("AST-1") == "CMP-9"
    assert campaign("AST-missing") == "BIG-SUMMER-SALE-" + md5(b"Big summer sale now").hexdigest()


def test_campaigns_with_one_beginning_stay_apart(spark):
    audience = spark.range(20).select(F.col("id").alias("customer_id"), F.lit("sms").alias("preferred_channel"))
    rates = {"open": 0.5, "click": 0.2, "convert": 0.1}
    ids = [spark.range(1).select(activation.campaign_id_of(f"Summer Trail Days {part}")).first()[0] for part in ("East", "West")]
    first = activation.funnel_events(audience, ids[0], rates, NOW)
    second = activation.funnel_events(audience, ids[1], rates, NOW, known=first)
    assert ids[0] != ids[1] and second.count() == first.count() >= 20


def test_rates_are_clamped(world):
    got = {r.segment_id: (r.open_rate, r.click_rate, r.convert_rate) for r in activation.activation_rates(world[1]).collect()}
    assert got == {1: (0.28, 0.12, 0.05), 2: (0.65, 0.35, 0.5), 3: (None, None, None)}


def test_funnel_is_idempotent_and_numbered_per_step(spark):
    audience = spark.range(500).select(F.col("id").alias("customer_id"), F.lit("sms").alias("preferred_channel"))
    rates = {"open": 0.5, "click": 0.2, "convert": 0.1}
    small = activation.funnel_events(audience, "C-1", rates, NOW)
    events = small.collect()
    assert len({e.event_id for e in events}) == len(events)
    for kind, share in [("send", 1.0), ("open", 0.5), ("click", 0.2), ("convert", 0.1)]:
        of = sorted((e for e in events if e.event_type == kind), key=lambda e: e.event_number)
        assert [e.event_number for e in of] == list(range(1, len(of) + 1))
        assert [e.customer_id for e in of] == sorted(e.customer_id for e in of)
        assert abs(len(of) / 500 - share) < 0.08
        assert all((e.revenue is not None) == (kind == "convert") for e in of)
    assert activation.funnel_events(audience, "C-1", rates, NOW, known=small).count() == 0


def test_split_covers_everyone_once(spark):
    ids = spark.range(3000)
    got = activation.split(ids, F.col("id"), "ab", {"holdout": 0.1, "a": 0.45, "b": 0.45})
    sizes = {r.split_group: r["count"] for r in got.groupBy("split_group").count().collect()}
    assert set(sizes) == {"holdout", "a", "b"} and sum(sizes.values()) == 3000


def test_audience_schema_check(spark):
    rows_ = AUDIENCES.fill(spark.createDataFrame([(1, "x" * 201, 5, "c"), (1, None, 6, "c")],
                           "segment_id bigint, segment_name string, customer_id bigint, campaign_name string"))
    found = AUDIENCES.violations(rows_).first().asDict()
    assert found["segment_name_null"] == 1 and found["segment_name_too_long"] == 1
    assert found["customer_id_null"] == 0 and rows_.first().status == "pending"


def test_unknown_segment_stages_nobody(world):
    profiles, segments, empty = world
    assert activation.activate_segment(profiles, segments, empty, 99, "Summer", NOW).rows.count() == 0


def test_segment_filter_reaches_the_scan(spark, world, tmp_path):
    profiles, segments, empty = world
    profiles.write.parquet(str(tmp_path / "p"))
    segment = segments.filter("segment_id = 1").first().asDict()
    got = activation.not_pending(activation.members_of(spark.read.parquet(str(tmp_path / "p")), segment), empty, "Summer")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(rfm_segment,Loyal)" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_ids_continue_after_the_highest(spark, world):
    profiles, segments, _ = world
    old = AUDIENCES.fill(spark.createDataFrame([(500, 9, "x", 1, "y")],
                         "audience_id bigint, segment_id bigint, segment_name string, customer_id bigint, campaign_name string"))
    got = activation.activate_segment(profiles, segments, old, 1, "Summer", NOW).rows
    assert sorted(r.audience_id for r in got.collect()) == list(range(501, 531))
