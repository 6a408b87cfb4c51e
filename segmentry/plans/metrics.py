"""A small metrics layer: named facts, dimensions and metrics over two entities.

``query`` turns names into one join, one grouping and one projection. Each
metric is aggregated over its own entity: a segment metric counts every segment
once, however many customers it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.plans.segments import SEGMENT_KEYS

CUSTOMER, SEGMENT = "customer", "segment"


@dataclass(frozen=True)
class Metric:
    entity: str
    kind: str  # avg, sum, count or count_distinct
    column: str

    def over(self) -> Column:
        value = F.col(self.column)
        if self.kind == "avg":
            return X.mean(value)
        if self.kind == "sum":
            return F.sum(value)
        if self.kind == "count":
            return F.count(value)
        return F.count_distinct(value)


# Names of the layer.
FACTS = {
    CUSTOMER: [
        "annual_spend", "total_spend_12m", "avg_order_value", "loyalty_points",
        "purchase_count_12m", "cart_add_count_12m", "total_events_12m", "active_days_12m",
        "training_logs_12m", "email_opens_12m", "email_clicks_12m", "campaign_conversions_12m",
        "campaign_revenue_12m", "tenure_days", "days_since_last_purchase", "ltv_annualized",
        "engagement_score",
    ],
    SEGMENT: ["total_revenue_opportunity"],
}
DIMENSIONS = {
    CUSTOMER: [
        "customer_id", "first_name", "last_name", "email", "gender", "city", "state", "region",
        "loyalty_tier_name", "preferred_channel", "top_category", "marketing_opt_in",
        "rfm_segment", "churn_risk_tier", "signup_date", "last_purchase_date",
    ],
    SEGMENT: ["segment_id", "segment_name"],
}
METRICS = {
    "avg_engagement_score": Metric(CUSTOMER, "avg", "engagement_score"),
    "avg_churn_risk": Metric(CUSTOMER, "avg", "churn_risk_score"),
    "avg_health_score": Metric(CUSTOMER, "avg", "customer_health_score"),
    "avg_ltv": Metric(CUSTOMER, "avg", "ltv_annualized"),
    "total_ltv": Metric(CUSTOMER, "sum", "ltv_annualized"),
    "total_revenue_opp": Metric(CUSTOMER, "sum", "revenue_opportunity_score"),
    "total_campaign_revenue": Metric(CUSTOMER, "sum", "campaign_revenue_12m"),
    "avg_email_open_rate": Metric(CUSTOMER, "avg", "email_open_rate"),
    "avg_click_rate": Metric(CUSTOMER, "avg", "email_click_rate"),
    "avg_conversion_rate": Metric(CUSTOMER, "avg", "campaign_conversion_rate"),
    "customer_count": Metric(CUSTOMER, "count", "customer_id"),
    "avg_intent_score": Metric(SEGMENT, "avg", "intent_score"),
}
# Not part of the twelve: the count above counts rows, this one counts ids.
METRICS_EXTRA = {"distinct_customer_count": Metric(CUSTOMER, "count_distinct", "customer_id")}


class MetricsLayer:
    """Customers with their micro-segment, queried by name."""

    def __init__(self, profiles: DataFrame, segments: DataFrame):
        self.profiles = profiles
        self.segments = segments
        self.metrics = {**METRICS, **METRICS_EXTRA}

    def duplicate_segments(self) -> DataFrame:
        """Key triples that break the many-to-one relationship; empty when it holds."""
        return self.segments.groupBy(*SEGMENT_KEYS).count().filter(F.col("count") > 1)

    def joined(self) -> DataFrame:
        """Every customer with the segment of its three keys, NULL where there is none.

        The planner broadcasts the segments on the evidence of their size.
        """
        side = self.segments.select(
            *SEGMENT_KEYS, "segment_id", "segment_name", "total_revenue_opportunity", "intent_score"
        )
        return self.profiles.join(side, SEGMENT_KEYS, "left")

    def query(
        self,
        dims: list[str] | None = None,
        metrics: list[str] | None = None,
        where: str | Column | None = None,
        order: list[Column] | None = None,
        limit: int | None = None,
        facts: list[str] | None = None,
    ) -> DataFrame:
        """Metrics by dimensions, or raw facts when ``facts`` is given instead."""
        dims, metrics, facts = dims or [], metrics or [], facts or []
        self._check(dims, metrics, facts)
        rows = self.joined()
        if where is not None:
            rows = rows.filter(where)
        if facts:
            out = rows.select(*dims, *facts)
        else:
            out = self._aggregate(rows, dims, metrics)
        if order:
            out = out.orderBy(*order)
        return out.limit(limit) if limit is not None else out

    def _check(self, dims: list[str], metrics: list[str], facts: list[str]) -> None:
        known = {
            "dimension": (dims, DIMENSIONS[CUSTOMER] + DIMENSIONS[SEGMENT]),
            "metric": (metrics, list(self.metrics)),
            "fact": (facts, FACTS[CUSTOMER] + FACTS[SEGMENT]),
        }
        for kind, (asked, names) in known.items():
            for name in asked:
                if name not in names:
                    raise KeyError(f"unknown {kind}: {name}")
        if facts and metrics:
            raise ValueError("ask for facts or for metrics")

    def _aggregate(self, rows: DataFrame, dims: list[str], metrics: list[str]) -> DataFrame:
        own = [m for m in metrics if self.metrics[m].entity == CUSTOMER]
        foreign = [m for m in metrics if self.metrics[m].entity == SEGMENT]
        if not foreign:
            return rows.groupBy(*dims).agg(*[self.metrics[m].over().alias(m) for m in own])
        # First per (dimensions, segment), where each segment is one row, then
        # per dimensions: one pass, and customers are combined before any shuffle.
        columns = sorted({self.metrics[m].column for m in foreign})
        partial = {}
        for m in own:
            value = F.col(self.metrics[m].column)
            if self.metrics[m].kind == "count_distinct":
                raise ValueError("a distinct count cannot be combined with a segment metric")
            partial[f"{m}__n"] = F.count(value)
            if self.metrics[m].kind != "count":
                partial[f"{m}__s"] = F.sum(value)
        first = {f"seg__{c}": F.max(c) for c in columns}
        grain = dims + (["segment_id"] if "segment_id" not in dims else [])
        per_segment = rows.groupBy(*grain).agg(
            *[c.alias(n) for n, c in {**partial, **first}.items()]
        )
        out = []
        for m in metrics:
            metric = self.metrics[m]
            if metric.entity == SEGMENT:
                out.append(Metric(SEGMENT, metric.kind, f"seg__{metric.column}").over().alias(m))
            elif metric.kind == "count":
                out.append(F.sum(f"{m}__n").alias(m))
            elif metric.kind == "sum":
                out.append(F.sum(f"{m}__s").alias(m))
            else:
                out.append((F.sum(f"{m}__s").cast("double") / F.sum(f"{m}__n")).alias(m))
        return per_segment.groupBy(*dims).agg(*out)
