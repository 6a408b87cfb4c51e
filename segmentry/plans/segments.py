"""Micro-segments: customers grouped by RFM label, churn tier and channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions import exprs as X

SEGMENT_KEYS = ["rfm_segment", "churn_risk_tier", "preferred_channel"]
MAX_SEGMENTS = 22  # Fixed value: the report keeps the best 22.

MIN_SIZE = 200  # Fixed value: the smallest audience worth a segment.


def segment_base(profiles: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """At most 8 × 3 × channels rows; combined before the shuffle, so a large group is no burden."""
    return (
        profiles.groupBy(*SEGMENT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            X.round_to(X.mean(F.col("annual_spend")), 2).alias("avg_spend"),
            X.round_to(X.mean(F.col("engagement_score")), 2).alias("avg_engagement_score"),
            X.round_to(X.mean(F.col("campaign_conversion_rate")), 4)
            .alias("avg_campaign_conversion_rate"),
            X.round_to(X.mean(F.col("ltv_annualized")), 2).alias("avg_ltv_annualized"),
            F.sum("revenue_opportunity_score").alias("total_revenue_opportunity"),
        )
        .filter(F.col("customer_count") >= min_size)
    )


def intent_weight() -> Column:
    """The three weights."""
    return (
        F.col("total_revenue_opportunity") * X.dec("0.4")
        + F.col("avg_engagement_score") * X.dec("0.35")
        + F.col("avg_ltv_annualized") * X.dec("0.25")
    )


def scaled_rank(rank: Column, rows: Column, low: float = 60.5, width: float = 22.4) -> Column:
    """Rank moved to ``[low, low + width]``; NULL when there is a single row."""
    step = (rank - 1).cast("double") / F.nullif(rows - 1, F.lit(0))
    return X.round_to(F.lit(low) + step * F.lit(width), 1)


def ranked_segments(base: DataFrame) -> DataFrame:
    """Ids, names and intent scores over all segments.

    The windows are global, but they run on the grouped frame of a few dozen
    rows, never on customers.
    """
    by_value = Window.orderBy(
        F.col("total_revenue_opportunity").desc_nulls_first(),
        F.col("avg_engagement_score").desc_nulls_first(),
        *SEGMENT_KEYS,
    )
    by_intent = Window.orderBy(intent_weight().asc_nulls_last())
    name = F.concat(
        F.col("rfm_segment"), F.lit(" / "), F.col("churn_risk_tier"), F.lit(" Churn / "),
        F.upper(F.col("preferred_channel")),
    )
    return base.select(
        F.row_number().over(by_value).cast("bigint").alias("segment_id"),
        name.alias("segment_name"),
        *base.columns,
        scaled_rank(F.rank().over(by_intent), F.count(F.lit(1)).over(Window.partitionBy()))
        .alias("intent_score"),
    )


def micro_segments(profiles: DataFrame, min_size: int = MIN_SIZE, top: int = MAX_SEGMENTS) -> DataFrame:
    """The best segments by intent. Ids are given before the cut, so they need not be dense."""
    ranked = ranked_segments(segment_base(profiles, min_size))
    return ranked.orderBy(F.col("intent_score").desc_nulls_first(), "segment_id").limit(top)


def segment_members(profiles: DataFrame, segments: DataFrame, segment_id: int) -> DataFrame:
    """Customers of one micro-segment, by one semi join on the three keys.

    The right side is a single row by its id, hence the broadcast.
    """
    chosen = segments.filter(F.col("segment_id") == segment_id).select(*SEGMENT_KEYS)
    return profiles.join(F.broadcast(chosen), SEGMENT_KEYS, "left_semi")
