from __future__ import annotations

from datetime import datetime

import pytest

from segmentry.plans import performance

WEEK = datetime(2024, 6, 5)  # a Wednesday; its Monday is 3 June


@pytest.fixture(scope="module")
def inputs(spark):
    events = []
    for channel in ("email", "sms"):
        events += [("both", channel, kind, WEEK, None) for kind in ("send", "send", "open", "click")]
        events.append(("both", channel, "convert", WEEK, 10.0))
    events.append(("owned", "email", "send", WEEK, None))
    ce = spark.createDataFrame(
        events, "campaign_id string, channel string, event_type string, event_timestamp timestamp_ntz, revenue double")
    paid = [("both", p, WEEK, 100, 9, 5.0, 3, 20.0, 2.0, 4.0) for p in ("meta", "google", "tiktok")]
    paid.append(("paid", "meta", WEEK, 100, 9, 5.0, 3, 20.0, 2.0, 4.0))
    pm = spark.createDataFrame(
        paid, "campaign_id string, platform string, date timestamp_ntz, impressions bigint, clicks bigint, spend double, "
        "conversions bigint, revenue double, roas double, cac double")
    library = spark.createDataFrame([("both", "Both", "Seasonal")], "campaign_id string, campaign_name string, campaign_type string")
    return ce, pm, library


def test_fan_out_of_channels_and_platforms(inputs):
    ce, pm, library = inputs
    got = performance.campaign_performance(performance.owned_metrics(ce, library), performance.paid_metrics(pm)).collect()
    both = [r for r in got if r.campaign_id == "both"]
    assert len(both) == 6 and {r.channel for r in both} == {"email", "sms"}
    assert all(str(r.period) == "2024-06-03" and r.conversions == 4 and float(r.cvr) == 2.0 for r in both)
    owned = next(r for r in got if r.campaign_id == "owned")
    assert owned.campaign_name == "owned" and owned.impressions == 0 and float(owned.ctr) == 0
    paid = next(r for r in got if r.campaign_id == "paid")
    assert paid.campaign_name is None and paid.channel == "meta" and paid.clicks == 0 and paid.conversions == 3


def test_by_week_counts_everything_once(inputs):
    ce, pm, library = inputs
    got = {r.campaign_id: r for r in performance.campaign_performance_by_week(ce, library, pm).collect()}
    assert len(got) == 3
    both = got["both"]
    assert (both.sends, both.opens, both.clicks, both.conversions) == (4, 2, 2, 11)
    assert float(both.total_revenue) == 80 and float(both.paid_spend) == 15 and both.impressions == 300
    assert float(both.cvr) == 2.75
