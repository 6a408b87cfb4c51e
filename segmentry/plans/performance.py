"""Weekly campaign performance over owned channels and paid media."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X


def week_of(moment: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", moment))


def owned_metrics(campaign_events: DataFrame, library: DataFrame) -> DataFrame:
    """Delivery counts per campaign, channel and week.

    Events are aggregated first and the library is joined to the few grouped
    rows, so neither the join nor a campaign with a third of all events moves
    raw events.
    """
    def of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    weekly = campaign_events.groupBy(
        "campaign_id", "channel", week_of(F.col("event_timestamp")).alias("period")
    ).agg(
        of("send").alias("sends"), of("open").alias("opens"), of("click").alias("clicks"),
        of("convert").alias("conversions"),
        F.sum(F.coalesce(F.col("revenue"), F.lit(0))).alias("owned_revenue"),
        of("bounce").alias("bounces"), of("unsubscribe").alias("unsubscribes"),
    )
    names = library.select("campaign_id", "campaign_name", "campaign_type")
    return weekly.join(names, "campaign_id", "left").select(
        "campaign_id", "campaign_name", "campaign_type", "channel", "period", "sends", "opens",
        "clicks", "conversions", "owned_revenue", "bounces", "unsubscribes",
    )


def paid_metrics(paid_media: DataFrame) -> DataFrame:
    """Sums per campaign, platform and week; ROAS and CAC are means of the records' own values."""
    return paid_media.groupBy(
        "campaign_id", "platform", week_of(F.col("date")).alias("period")
    ).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("paid_clicks"),
        F.sum("spend").alias("spend"),
        F.sum("conversions").alias("paid_conversions"),
        F.sum("revenue").alias("paid_revenue"),
        X.mean(F.col("roas")).alias("avg_roas"),
        X.mean(F.col("cac")).alias("avg_cac"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def join_owned_paid(owned: DataFrame, paid: DataFrame) -> DataFrame:
    """Full outer join of the two on campaign and week."""
    return owned.join(paid, ["campaign_id", "period"], "full")


def _measures() -> list[Column]:
    return [
        _zero("sends").alias("sends"), _zero("opens").alias("opens"), _zero("clicks").alias("clicks"),
        (_zero("conversions") + _zero("paid_conversions")).alias("conversions"),
        (_zero("owned_revenue") + _zero("paid_revenue")).alias("total_revenue"),
        _zero("spend").alias("paid_spend"), _zero("impressions").alias("impressions"),
        _zero("avg_roas").alias("roas"), _zero("avg_cac").alias("cac"),
    ]


def _rates() -> dict[str, Column]:
    """Click rate is per open; conversion rate counts owned and paid conversions per send."""
    return {
        "email_open_rate": X.safe_ratio(F.col("opens"), F.col("sends")),
        "ctr": X.safe_ratio(F.col("clicks"), F.col("opens")),
        "cvr": X.safe_ratio(F.col("conversions"), F.col("sends")),
    }


def campaign_performance(owned: DataFrame, paid: DataFrame) -> DataFrame:
    """Performance at the grain campaign × channel × platform × week.

    Owned rows are per channel and paid rows per platform, so a week with both
    repeats each side for every row of the other; do not sum over the result
    (use :func:`campaign_performance_by_week`). A paid-only row has no campaign
    name, and paid clicks are not counted in ``clicks``.
    """
    joined = join_owned_paid(owned, paid)
    shown = joined.select(
        "campaign_id",
        F.coalesce(
            F.col("campaign_name"), F.when(F.col("sends").isNotNull(), F.col("campaign_id"))
        ).alias("campaign_name"),
        "campaign_type",
        F.coalesce(F.col("channel"), F.col("platform")).alias("channel"),
        "period", *_measures(),
    )
    return shown.filter(F.col("period").isNotNull()).withColumns(_rates())


def campaign_performance_by_week(campaign_events: DataFrame, library: DataFrame, paid_media: DataFrame) -> DataFrame:
    """Performance per campaign and week, each event and record counted once."""
    owned = owned_metrics(campaign_events, library).groupBy("campaign_id", "period").agg(
        F.max("campaign_name").alias("campaign_name"), F.max("campaign_type").alias("campaign_type"),
        *[F.sum(c).alias(c) for c in ("sends", "opens", "clicks", "conversions", "owned_revenue")],
    )
    paid = paid_media.groupBy("campaign_id", week_of(F.col("date")).alias("period")).agg(
        F.sum("impressions").alias("impressions"), F.sum("spend").alias("spend"),
        F.sum("conversions").alias("paid_conversions"), F.sum("revenue").alias("paid_revenue"),
        X.mean(F.col("roas")).alias("avg_roas"), X.mean(F.col("cac")).alias("avg_cac"),
    )
    joined = join_owned_paid(owned, paid).filter(F.col("period").isNotNull())
    return joined.select(
        "campaign_id", "campaign_name", "campaign_type", "period", *_measures()
    ).withColumns(_rates())
