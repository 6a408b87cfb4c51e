"""Customer 360: behaviour metrics, RFM scores and derived scores per customer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.operators import rank
from segmentry.sources import seeds

RECENCY_FALLBACK_DAYS = 548  # Fixed value: recency of a customer without a purchase.

PURCHASE_COLUMNS = [
    "purchase_count_12m", "total_spend_12m", "avg_order_value", "last_purchase_date",
    "first_purchase_date", "return_count_12m", "cart_add_count_12m", "wishlist_count_12m",
]
ENGAGEMENT_COLUMNS = [
    "total_events_12m", "page_views_12m", "search_count_12m", "training_logs_12m", "goals_set_12m",
    "reviews_written_12m", "size_exchanges_12m", "active_days_12m", "last_activity_date",
]
CAMPAIGN_COLUMNS = [
    "email_opens_12m", "email_clicks_12m", "campaign_conversions_12m", "campaign_revenue_12m",
    "emails_received_12m", "unsubscribes_12m",
]


def last_year(events: DataFrame, as_of: datetime) -> DataFrame:
    """Events from one year before ``as_of`` on.

    The bound is a folded literal, so it reaches the Parquet scan; on a table
    laid out by month (:func:`by_month`) older months are not even listed.
    """
    start = X.ntz(as_of) - F.expr("INTERVAL 1 YEAR")
    kept = events.filter(F.col("event_timestamp") >= start)
    if MONTH in events.columns:
        kept = kept.filter(F.col(MONTH) >= F.trunc(start.cast("date"), "month"))
    return kept


MONTH = "event_month"


def by_month(events: DataFrame) -> DataFrame:
    """Events with their month, spread evenly for a write partitioned by it.

    The rebalance hint lets the engine split a heavy month into several files
    and merge light ones.
    """
    month = F.trunc(F.to_date("event_timestamp"), "month")
    return events.withColumn(MONTH, month).hint("rebalance", MONTH)


def purchase_amount() -> Column:
    """The amount in the JSON properties, parsed for purchases only; an unreadable one fails the job."""
    kind = F.when(F.col("event_type") == "purchase", F.get_json_object("event_properties", "$.amount"))
    amount = kind.cast(X.MONEY)
    return F.when(F.col("event_type") == "purchase", amount)


def purchase_metrics() -> dict[str, Column]:
    bought = F.col("event_type") == "purchase"
    when_bought = F.when(bought, F.col("event_timestamp"))
    return {
        "purchase_count_12m": F.count_if(bought),
        "total_spend_12m": F.sum(F.when(bought, F.col("amount")).otherwise(F.lit(0))),
        "avg_order_value": X.mean(F.col("amount")),
        "last_purchase_date": F.max(when_bought),
        "first_purchase_date": F.min(when_bought),
        "return_count_12m": F.count_if(F.col("event_type") == "return"),
        "cart_add_count_12m": F.count_if(F.col("event_type") == "add_to_cart"),
        "wishlist_count_12m": F.count_if(F.col("event_type") == "wishlist_add"),
    }


def _day_bits(ago: Column, word: int) -> Column:
    """Bits of the days ``64 * word`` to ``64 * word + 63`` before the clock."""
    place = ago - F.lit(64 * word)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return F.bit_or(F.when(place.between(0, 63), bit))


def active_days(as_of: datetime) -> Column:
    """Number of distinct days with an event.

    A distinct count would shuffle one row per customer and day, twice. The
    days of the window fit into six 64-bit words, which combine before the
    shuffle like any sum. Days outside them (events dated after the clock) are
    few and are counted as a distinct count, so the result is exact.
    """
    date = F.to_date("event_timestamp")
    ago = F.datediff(X.day(as_of), date)
    total = F.count_distinct(F.when(~ago.between(0, 383), date))
    for word in range(6):
        total = total + F.coalesce(F.bit_count(_day_bits(ago, word)), F.lit(0))
    return total


def engagement_metrics(as_of: datetime) -> dict[str, Column]:
    def of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    return {
        "total_events_12m": F.count(F.lit(1)),
        "page_views_12m": of("page_view"),
        "search_count_12m": of("search"),
        "training_logs_12m": of("training_log"),
        "goals_set_12m": of("goal_set"),
        "reviews_written_12m": of("gear_review"),
        "size_exchanges_12m": of("size_exchange"),
        "active_days_12m": active_days(as_of),
        "last_activity_date": F.max("event_timestamp"),
    }


def event_metrics(events: DataFrame, as_of: datetime, parts: tuple[str, ...] = ("purchase", "engagement")) -> DataFrame:
    """Purchase and engagement metrics in one pass over the events.

    Both share the filter and the grouping key, so one scan and one
    aggregation serve both. Counts and sums combine before the shuffle, which
    keeps a customer with very many events from weighing on one task.
    """
    windowed = last_year(events, as_of).withColumn("amount", purchase_amount())
    metrics: dict[str, Column] = {}
    if "purchase" in parts:
        metrics |= purchase_metrics()
    if "engagement" in parts:
        metrics |= engagement_metrics(as_of)
    return windowed.groupBy("customer_id").agg(*[c.alias(n) for n, c in metrics.items()])


def campaign_metrics(campaign_events: DataFrame, as_of: datetime) -> DataFrame:
    def of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    return last_year(campaign_events, as_of).groupBy("customer_id").agg(
        of("open").alias("email_opens_12m"),
        of("click").alias("email_clicks_12m"),
        of("convert").alias("campaign_conversions_12m"),
        F.sum(F.coalesce(F.col("revenue"), F.lit(0))).alias("campaign_revenue_12m"),
        of("send").alias("emails_received_12m"),
        of("unsubscribe").alias("unsubscribes_12m"),
    )


def rfm_inputs(as_of: datetime) -> dict[str, Column]:
    """Recency with the fixed fallback, frequency and monetary value."""
    fallback = F.date_sub(X.day(as_of), RECENCY_FALLBACK_DAYS).cast("timestamp_ntz")
    last = F.coalesce(F.col("last_purchase_date"), fallback)
    return {
        "days_since_purchase": X.days_between(last, X.day(as_of)),
        "frequency": F.coalesce(F.col("purchase_count_12m"), F.lit(0)).cast("bigint"),
        "monetary": F.coalesce(F.col("total_spend_12m"), F.lit(0)).cast(X.MONEY),
    }


def rfm_base(customers: DataFrame, metrics: DataFrame, as_of: datetime) -> DataFrame:
    joined = customers.join(metrics, "customer_id", "left")
    return joined.select("customer_id", *[c.alias(n) for n, c in rfm_inputs(as_of).items()])


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintiles, 5 = best. Ties are broken by customer id so that a rerun agrees."""
    who = F.col("customer_id")
    return rank.tiles(
        base,
        {
            "r_score": [rank.descending(F.col("days_since_purchase")), who],
            "f_score": [F.col("frequency"), who],
            "m_score": [F.col("monetary"), who],
        },
        n_tiles=5,
    ).withColumn("rfm_composite_score", composite())


def composite() -> Column:
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return X.round_to(total.cast("double") / F.lit(3.0), 2)


def rfm_segment(r: Column, f: Column) -> Column:
    """Eight labels; the first match wins."""
    return (
        F.when((r >= 4) & (f >= 4), "Champion")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f < 3), "Recent")
        .when((r < 2) & (f >= 4), "At Risk")
        .when((r < 2) & (f < 2), "Dormant")
        .when(r >= 3, "Potential")
        .when(f >= 3, "Needs Attention")
        .otherwise("New")
    )


def churn_tier(days: Column) -> Column:
    """Days since the last purchase; NULL means there was none."""
    return (
        F.when(days.isNull() | (days > 180), "High").when(days > 90, "Medium").otherwise("Low")
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _top_100(score: Column) -> Column:
    return X.strict_least(F.lit(100), X.round_to(score, 1)).cast("decimal(21,1)")


def customer_scores() -> dict[str, Column]:
    """Engagement, churn, lifetime value, health and opportunity.

    Reads the raw metric columns, where NULL means the customer has no event in
    the window. Fixed values: weights and caps.
    """
    active, logs = _zero("active_days_12m"), _zero("training_logs_12m")
    engagement = (
        active * X.dec("0.4") + logs * X.dec("2.0") + _zero("goals_set_12m") * X.dec("5.0")
        + _zero("reviews_written_12m") * X.dec("3.0") + _zero("purchase_count_12m") * X.dec("1.5")
    )
    churn = (
        F.coalesce(F.col("days_since_last_purchase"), F.lit(365)) * X.dec("0.15")
        + F.greatest(F.lit(0), F.lit(30) - active) * X.dec("0.5")
        + _zero("return_count_12m") * X.dec("2.0")
    )
    health = (
        (F.col("r_score") + F.col("f_score") + F.col("m_score")) * X.dec("8.0")
        + active * X.dec("0.3") + logs * X.dec("1.0")
    )
    per_order = F.col("annual_spend").cast("double") / X.strict_greatest(
        F.col("purchase_count_12m"), F.lit(1)
    )
    opportunity = F.coalesce(F.col("avg_order_value"), per_order) * (
        F.col("points_multiplier").cast("double") * F.lit(2.5)
    )
    return {
        "engagement_score": _top_100(engagement),
        "churn_risk_score": _top_100(churn),
        "ltv_annualized": X.round_to(
            F.coalesce(F.col("total_spend_12m"), F.col("annual_spend") * X.dec("0.5")), 2
        ),
        "customer_health_score": _top_100(health),
        "revenue_opportunity_score": X.round_to(opportunity, 2),
    }


def customer_rates() -> dict[str, Column]:
    sends, opens = F.col("emails_received_12m"), F.col("email_opens_12m")
    return {
        "email_open_rate": X.safe_ratio(opens, sends),
        "email_click_rate": X.safe_ratio(F.col("email_clicks_12m"), opens),
        "campaign_conversion_rate": X.safe_ratio(F.col("campaign_conversions_12m"), sends),
        "return_rate": X.safe_ratio(F.col("return_count_12m"), F.col("purchase_count_12m")),
    }


PROFILE_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "gender", "age",
    "city", "state", "region", "zip_code", "signup_date", "last_login_date", "tenure_days",
    "loyalty_tier_id", "loyalty_tier_name", "annual_spend", "loyalty_points", "tier_discount_pct",
    "preferred_channel", "top_category", "marketing_opt_in", "push_opt_in", "sms_opt_in",
    "nearest_store_id", *PURCHASE_COLUMNS[:5], "days_since_last_purchase", *PURCHASE_COLUMNS[5:],
    *ENGAGEMENT_COLUMNS, *CAMPAIGN_COLUMNS, "email_open_rate", "email_click_rate",
    "campaign_conversion_rate", "return_rate", "r_score", "f_score", "m_score",
    "rfm_composite_score", "rfm_segment", "churn_risk_tier", "engagement_score",
    "churn_risk_score", "ltv_annualized", "customer_health_score", "revenue_opportunity_score",
]

# Metrics shown as 0 for a customer without events; dates stay NULL.
SHOWN_AS_ZERO = [
    c for c in PURCHASE_COLUMNS + ENGAGEMENT_COLUMNS + CAMPAIGN_COLUMNS if not c.endswith("_date")
]


def customer_360(
    customers: DataFrame,
    events: DataFrame,
    campaign_events: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """The 65-column profile, one row per customer.

    Both fact tables are aggregated to the customer before the joins, and all
    joins share the customer id as key. The tier table is inline, so the planner
    knows its size and broadcasts it.
    """
    tiers = seeds.loyalty_tiers(customers.sparkSession).select(
        F.col("tier_id").alias("loyalty_tier_id"), "points_multiplier",
        F.col("discount_pct").alias("tier_discount_pct"),
    )
    today = X.day(as_of)
    wide = (
        customers.join(event_metrics(events, as_of), "customer_id", "left")
        .join(campaign_metrics(campaign_events, as_of), "customer_id", "left")
        .join(tiers, "loyalty_tier_id", "left")
        .withColumns(rfm_inputs(as_of))
    )
    scored = rfm_scores(wide)
    scored = scored.withColumns({
        "age": X.years_between(F.col("date_of_birth"), today),
        "tenure_days": X.days_between(F.col("signup_date"), today),
        "days_since_last_purchase": X.days_between(F.col("last_purchase_date"), today),
    })
    scored = scored.withColumns({
        **customer_scores(), **customer_rates(),
        "rfm_segment": rfm_segment(F.col("r_score"), F.col("f_score")),
        "churn_risk_tier": churn_tier(F.col("days_since_last_purchase")),
    })
    return scored.withColumns({name: _zero(name) for name in SHOWN_AS_ZERO}).select(*PROFILE_COLUMNS)
