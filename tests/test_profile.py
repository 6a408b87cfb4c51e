from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from segmentry.plans import profile, segments
from segmentry.sources import bindings, seeds
from segmentry.sources.storage import Tables
from registry.base import Data
from tests.conftest import rows

AS_OF = datetime(2024, 6, 1)

# (r, f) → label, from the first-match rule.
GRID = {
    5: ["Recent", "Recent", "Loyal", "Champion", "Champion"],
    4: ["Recent", "Recent", "Loyal", "Champion", "Champion"],
    3: ["Potential", "Potential", "Loyal", "Loyal", "Loyal"],
    2: ["New", "New", "Needs Attention", "Needs Attention", "Needs Attention"],
    1: ["Dormant", "New", "Needs Attention", "At Risk", "At Risk"],
}


def test_rfm_labels_of_all_pairs(spark):
    pairs = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "r int, f int")
    got = pairs.select("r", "f", profile.rfm_segment(F.col("r"), F.col("f")).alias("s")).collect()
    assert all(row.s == GRID[row.r][row.f - 1] for row in got) and len(got) == 25


def test_churn_tier_bounds(spark):
    days = spark.createDataFrame([(0,), (90,), (91,), (180,), (181,), (None,)], "d int")
    got = [r[0] for r in days.select(profile.churn_tier(F.col("d"))).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High"]


@pytest.fixture(scope="module")
def small(spark):
    customers = spark.createDataFrame(
        [(i, f"F{i}", "L", f"{i}@x", "p", date(1990, 5, 5), "Female", "C", "S", "R", "1", "TIER-002", "Active",
          100.0, 5, "email", "Run", True, True, True, "STR-001", date(2024, 1, 1), date(2024, 5, 1))
         for i in range(4)],
        "customer_id bigint, first_name string, last_name string, email string, phone string, date_of_birth date, "
        "gender string, city string, state string, region string, zip_code string, loyalty_tier_id string, "
        "loyalty_tier_name string, annual_spend double, loyalty_points bigint, preferred_channel string, "
        "top_category string, marketing_opt_in boolean, push_opt_in boolean, sms_opt_in boolean, "
        "nearest_store_id string, signup_date date, last_login_date date",
    ).withColumn("annual_spend", F.col("annual_spend").cast("decimal(18,2)"))

    def event(customer, kind, days, props="{}"):
        return (customer, kind, AS_OF - timedelta(days=days), props)

    events = spark.createDataFrame(
        [
            event(0, "purchase", 10, '{"amount":20.04}'), event(0, "purchase", 200, '{"amount":9.96}'),
            event(0, "return", 5), event(0, "page_view", 5), event(0, "training_log", 3),
            event(1, "page_view", 1), event(1, "add_to_cart", 1),
            event(2, "purchase", 400, '{"amount":500}'),  # outside the year
            event(3, "purchase", 100, '{"amount":0.04}'), event(3, "purchase", 90, '{"quantity":1}'),
        ],
        "customer_id bigint, event_type string, event_timestamp timestamp_ntz, event_properties string",
    )
    campaign = spark.createDataFrame(
        [(0, "send", AS_OF, None), (0, "send", AS_OF, None), (0, "send", AS_OF, None), (0, "open", AS_OF, None),
         (0, "convert", AS_OF, 12.5), (1, "open", AS_OF, None)],
        "customer_id bigint, event_type string, event_timestamp timestamp_ntz, revenue double",
    ).withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    return customers, events, campaign


@pytest.fixture(scope="module")
def profiles(small):
    return {r.customer_id: r for r in profile.customer_360(*small, AS_OF).collect()}


def test_profile_has_65_columns_and_one_row_per_customer(small, profiles):
    assert len(profile.PROFILE_COLUMNS) == len(set(profile.PROFILE_COLUMNS)) == 65
    assert set(profiles) == {0, 1, 2, 3}


def test_windowed_metrics(profiles):
    first = profiles[0]
    assert (first.purchase_count_12m, float(first.total_spend_12m), first.avg_order_value) == (2, 30.0, 15.0)
    assert first.days_since_last_purchase == 10 and first.return_count_12m == 1
    assert first.total_events_12m == 5 and first.active_days_12m == 4
    assert float(first.return_rate) == 0.5 and float(first.email_open_rate) == 0.3333
    assert float(first.campaign_conversion_rate) == 0.3333 and float(first.campaign_revenue_12m) == 12.5


def test_customer_with_events_but_no_purchase(profiles):
    row = profiles[1]
    assert float(row.total_spend_12m) == 0 and float(row.ltv_annualized) == 0  # spend is 0, not absent
    assert row.days_since_last_purchase is None and row.churn_risk_tier == "High"
    assert float(row.revenue_opportunity_score) == 312.5  # 100 / 1 * 1.25 * 2.5
    assert float(row.email_open_rate) == 0  # opens without sends


def test_customer_without_events(profiles):
    row = profiles[2]
    assert float(row.ltv_annualized) == 50.0  # half the annual spend
    assert row.revenue_opportunity_score is None
    assert row.total_events_12m == 0 and row.last_activity_date is None
    assert float(row.churn_risk_score) == 69.8  # 365 * .15 + 30 * .5 = 69.75


def test_purchase_without_amount_counts(profiles):
    row = profiles[3]
    assert row.purchase_count_12m == 2 and float(row.total_spend_12m) == 0.04
    assert float(row.revenue_opportunity_score) == 0.13  # 0.04 * 3.125 = 0.125, half up


def test_unreadable_amount_fails(spark, small):
    _, events, _ = small
    bad = events.withColumn("event_properties", F.replace("event_properties", F.lit("0.04"), F.lit('"broken"')))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        profile.event_metrics(bad, AS_OF).collect()


def test_recency_fallback_is_fixed(spark, small):
    customers, events, _ = small
    base = profile.rfm_base(customers, profile.event_metrics(events, AS_OF), AS_OF)
    got = {r.customer_id: r.days_since_purchase for r in base.collect()}
    assert got == {0: 10, 1: 548, 2: 548, 3: 90}


def test_quintiles_are_even(spark, sf_dir):
    d = Data(spark, sf_dir)
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in d.profiles.groupBy(score).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_one_scan_and_pushed_filter(spark, sf_dir):
    d = Data(spark, sf_dir)
    plan = profile.event_metrics(d.events, bindings.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_orderstatus" not in plan


def test_intent_score_is_null_for_a_single_segment(spark):
    base = spark.createDataFrame(
        [("Loyal", "Low", "email", 5, 1.0, 2.0, 0.1, 3.0, 10.0)],
        "rfm_segment string, churn_risk_tier string, preferred_channel string, customer_count bigint, avg_spend double, "
        "avg_engagement_score double, avg_campaign_conversion_rate double, avg_ltv_annualized double, "
        "total_revenue_opportunity double",
    )
    exact = [F.col(c).cast("decimal(18,2)").alias(c) if t == "double" else F.col(c) for c, t in base.dtypes]
    row = segments.ranked_segments(base.select(*exact)).first()
    assert row.segment_id == 1 and row.intent_score is None
    assert row.segment_name == "Loyal / Low Churn / EMAIL"


def test_segment_sizes_do_not_exceed_customers(spark, sf_dir):
    d = Data(spark, sf_dir)
    total = segments.segment_base(d.profiles, d.min_size).agg(F.sum("customer_count")).first()[0]
    assert total <= d.table("customer").count()


def test_small_tables(spark, sf_dir):
    assert seeds.loyalty_tiers(spark).count() == 4
    assert bindings.categories(spark, sf_dir).filter("min_price <= max_price").count() == 12
    assert [r.campaign_id for r in bindings.library(spark, sf_dir).orderBy("campaign_id").collect()] == seeds.CAMPAIGN_IDS
    assert bindings.personas(spark, sf_dir).filter("micro_segment_ids like '[%]'").count() == 5
    assert seeds.channel_templates(spark).schema["max_length"].dataType.simpleString() == "bigint"


def test_active_days_with_hot_customer_and_days_after_the_clock(spark):
    """One customer has a third of all events; some events are dated in the future."""
    data = [(0 if i % 3 == 0 else i % 50, AS_OF + timedelta(days=20 - (i * 37) % 380, hours=i % 24)) for i in range(6000)]
    events = spark.createDataFrame(data, "customer_id bigint, event_timestamp timestamp_ntz").withColumns({
        "event_type": F.lit("search"), "event_properties": F.lit("{}")})
    start = AS_OF.replace(year=AS_OF.year - 1)
    want = {}
    for customer, moment in data:
        if moment >= start:
            want.setdefault(customer, set()).add(moment.date())
    got = profile.event_metrics(events, AS_OF).collect()
    assert {r.customer_id: r.active_days_12m for r in got} == {c: len(d) for c, d in want.items()}
    assert max(len(d) for d in want.values()) > 300


def test_older_months_are_pruned(spark, sf_dir, tmp_path):
    d = Data(spark, sf_dir)
    stored = Tables(spark, str(tmp_path)).overwrite("events", profile.by_month(d.events), [profile.MONTH])
    pruned = profile.event_metrics(stored, bindings.AS_OF)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "2000-08-01" in plan
    assert rows(pruned) == rows(profile.event_metrics(d.events, bindings.AS_OF))
