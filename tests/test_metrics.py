from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from registry.base import Data
from segmentry.plans import metrics, questions


@pytest.fixture(scope="module")
def layer(spark, sf_dir):
    d = Data(spark, sf_dir)
    return metrics.MetricsLayer(d.stored_profiles, d.segments)


def test_inventory():
    assert sum(map(len, metrics.FACTS.values())) == 18
    assert sum(map(len, metrics.DIMENSIONS.values())) == 18
    assert len(metrics.METRICS) == 12


def test_relationship_is_many_to_one(layer):
    assert layer.duplicate_segments().count() == 0
    assert layer.joined().count() == layer.profiles.count()


def test_segment_metric_counts_each_segment_once(layer):
    got = layer.query(metrics=["avg_intent_score", "customer_count"]).first()
    scores = [float(r.intent_score) for r in layer.segments.collect()]
    assert got.avg_intent_score == pytest.approx(sum(scores) / len(scores))
    assert got.customer_count == layer.profiles.count()


def test_same_customer_metrics_with_and_without_segment_metric(layer):
    own = ["avg_ltv", "total_ltv", "customer_count"]
    alone = {r.region: r[1:] for r in layer.query(["region"], own).collect()}
    mixed = {r.region: r[1:4] for r in layer.query(["region"], own + ["avg_intent_score"]).collect()}
    assert alone == mixed


def test_facts_filters_order_and_limit(layer):
    got = layer.query(["customer_id"], where="region = 'ASIA'", facts=["ltv_annualized"],
                      order=[F.col("ltv_annualized").desc(), F.col("customer_id")], limit=3).collect()
    every = layer.profiles.filter("region = 'ASIA'").select("ltv_annualized", "customer_id").collect()
    want = sorted(every, key=lambda r: (-r[0], r[1]))[:3]
    assert [r.customer_id for r in got] == [r[1] for r in want]


def test_unknown_names_are_refused(layer):
    with pytest.raises(KeyError):
        layer.query(["shoe_size"], ["customer_count"])
    with pytest.raises(KeyError):
        layer.query(["region"], ["median_ltv"])
    with pytest.raises(ValueError):
        layer.query(["region"], ["customer_count"], facts=["annual_spend"])


def test_distinct_count_is_a_metric_of_its_own(layer):
    got = layer.query(["region"], ["customer_count", "distinct_customer_count"]).collect()
    assert all(r.customer_count == r.distinct_customer_count for r in got)


def test_cart_abandonment_without_cart_additions(spark):
    df = spark.createDataFrame(
        [("New", "High", "sms", 2, 0), ("Loyal", "Low", "sms", 1, 4), ("Loyal", "Low", "email", 9, 3)],
        "rfm_segment string, churn_risk_tier string, preferred_channel string, purchase_count_12m bigint, cart_add_count_12m bigint")
    got = [None if r.abandonment_rate is None else float(r.abandonment_rate) for r in questions.cart_abandonment(df, 1).collect()]
    assert got == [0.75, 0.0, None]
