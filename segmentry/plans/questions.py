"""The analyst questions as ready queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.operators.topk import top
from segmentry.plans.segments import SEGMENT_KEYS


def top_segments(segments: DataFrame, k: int = 5) -> DataFrame:
    """The best segments by intent score."""
    shown = segments.select("segment_id", "segment_name", "customer_count", "intent_score")
    return top(shown, [F.col("intent_score").desc_nulls_first(), F.col("segment_id")], k)


def segment_size(profiles: DataFrame, rfm: str, churn: str, channel: str) -> DataFrame:
    """How many customers a key triple has."""
    chosen = profiles.filter(
        (F.col("rfm_segment") == rfm) & (F.col("churn_risk_tier") == churn)
        & (F.col("preferred_channel") == channel)
    )
    return chosen.agg(F.count(F.lit(1)).alias("customer_count"))


def campaign_responses(campaign_events: DataFrame, keys: list[str]) -> DataFrame:
    """Sends, opens and conversions per key."""
    def of(kind: str):
        return F.count_if(F.col("event_type") == kind)

    return campaign_events.groupBy(*keys).agg(
        of("send").alias("sends"), of("open").alias("opens"), of("convert").alias("conversions")
    )


def best_campaigns(
    campaign_events: DataFrame, profiles: DataFrame, library: DataFrame, churn: str = "High", k: int = 10
) -> DataFrame:
    """Which campaigns converted best among customers of one churn tier.

    ``profiles`` needs the columns customer_id and churn_risk_tier only.
    Events are counted per customer and campaign before the join, so the join
    moves one row per pair and not one per event.
    """
    audience = profiles.filter(F.col("churn_risk_tier") == churn).select("customer_id")
    per_customer = campaign_responses(campaign_events, ["customer_id", "campaign_id"])
    sums = per_customer.join(audience, "customer_id", "left_semi").groupBy("campaign_id").agg(
        *[F.sum(c).alias(c) for c in ("sends", "opens", "conversions")]
    )
    named = sums.join(library.select("campaign_id", "campaign_name"), "campaign_id", "left")
    rated = named.select(
        "campaign_id", "campaign_name", "sends", "conversions",
        X.safe_ratio(F.col("conversions"), F.col("sends")).alias("conversion_rate"),
    )
    return top(rated, [F.col("conversion_rate").desc(), F.col("campaign_id")], k)


def compare_types(campaign_events: DataFrame, library: DataFrame, types: DataFrame) -> DataFrame:
    """Recorded and observed conversion rate of the campaign types in column ``campaign_type`` of ``types``."""
    observed = campaign_responses(campaign_events, ["campaign_id"])
    # The library is grouped first: it can hold several entries per type.
    joined = library.join(types, "campaign_type", "left_semi").join(observed, "campaign_id", "left")
    return joined.groupBy("campaign_type").agg(
        X.round_to(X.mean(F.col("conversion_rate")), 4).alias("recorded_rate"),
        F.sum("sends").alias("sends"),
        X.safe_ratio(F.sum("conversions"), F.sum("sends")).alias("observed_rate"),
    )


def cart_abandonment(profiles: DataFrame, min_size: int) -> DataFrame:
    """Segments by abandonment rate, highest first.

    Defined here as ``1 - min(1, purchases / cart additions)`` over the
    segment's customers; NULL for a segment without cart additions.
    """
    sums = profiles.groupBy(*SEGMENT_KEYS).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("purchase_count_12m").alias("purchases"),
        F.sum("cart_add_count_12m").alias("cart_adds"),
    ).filter(F.col("customer_count") >= min_size)
    bought = X.strict_least(
        F.lit(1.0), F.col("purchases").cast("double") / F.nullif(F.col("cart_adds"), F.lit(0))
    )
    return sums.withColumn("abandonment_rate", X.round_to(F.lit(1.0) - bought, 4)).orderBy(
        F.col("abandonment_rate").desc_nulls_last(), *SEGMENT_KEYS
    )


def tier_opportunity(profiles: DataFrame, tier: str = "Elite") -> DataFrame:
    """Total revenue opportunity of the customers of one loyalty tier."""
    return profiles.filter(F.col("loyalty_tier_name") == tier).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("revenue_opportunity_score").alias("total_revenue_opportunity"),
    )
