"""Segment activation: stage an audience, split it by hash, hand it to delivery."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.operators import rank
from segmentry.plans.segments import SEGMENT_KEYS
from segmentry.sources.schemas import AUDIENCES, CAMPAIGN_EVENTS


def activation_rates(segments: DataFrame) -> DataFrame:
    """Open, click and conversion rate of a segment from its history, with floors and caps.

    Fixed values: factors and bounds. NULL history gives NULL rates.
    """
    rate = F.col("avg_campaign_conversion_rate").cast("double")
    return segments.select(
        "segment_id", "segment_name",
        X.clamp(rate * 5.0, F.lit(0.28), F.lit(0.65)).alias("open_rate"),
        X.clamp(rate * 2.5, F.lit(0.12), F.lit(0.35)).alias("click_rate"),
        X.strict_greatest(rate, F.lit(0.05)).alias("convert_rate"),
    )


def campaign_id_of(name: str) -> Column:
    """A readable code and a hash of the whole name, so that names with one beginning stay apart."""
    return F.concat(X.slug(F.lit(name)), F.lit("-"), F.md5(F.lit(name)))


def campaign_code(name: str, assets: DataFrame | None, content_id: str | None) -> Column:
    """The campaign id: the linked asset's campaign, else a code from the name."""
    code = campaign_id_of(name)
    if assets is None or content_id is None:
        return code
    own = assets.filter(F.col("asset_id") == content_id).agg(F.max("campaign_id").alias("own")).first()
    return F.coalesce(F.lit(own["own"]).cast("string"), code)


def not_pending(members: DataFrame, audiences: DataFrame, campaign_name: str) -> DataFrame:
    """Members who are not already waiting for delivery under this campaign name."""
    waiting = audiences.filter(
        (F.col("campaign_name") == campaign_name) & (F.col("status") == "pending")
    ).select("customer_id")
    return members.join(waiting, "customer_id", "left_anti")


def members_of(profiles: DataFrame, segment: dict) -> DataFrame:
    """The customers of one segment; its keys are literals, so the filter reaches the scan."""
    belongs = F.lit(True)
    for key in SEGMENT_KEYS:
        belongs = belongs & (F.col(key) == F.lit(segment[key]))
    return profiles.filter(belongs)


def by_priority(members: DataFrame) -> DataFrame:
    """Healthiest customers first; ties by id."""
    keys = [rank.descending(F.col("customer_health_score")), F.col("customer_id")]
    return rank.row_numbers(members, "priority_rank", keys)


@dataclass
class Activation:
    """New audience rows (to append) and the one-row summary."""

    rows: DataFrame
    summary: DataFrame


def activate_segment(
    profiles: DataFrame,
    segments: DataFrame,
    audiences: DataFrame,
    segment_id: int,
    campaign_name: str,
    now: datetime,
    content_id: str | None = None,
    assets: DataFrame | None = None,
) -> Activation:
    """Stage the customers of a segment for a campaign; calling twice stages nobody twice.

    The segment's row, the highest audience id and the asset's campaign are
    read first: single values, which enter the plan as literals, so the segment
    filter reaches the scan of the profiles. The profile already carries address
    and channel, so customers are not joined again. The caller appends ``rows`` once.
    """
    segment = segments.filter(F.col("segment_id") == segment_id).first()
    segment = segment.asDict() if segment else dict.fromkeys([*SEGMENT_KEYS, "segment_name"])
    highest = audiences.agg(F.coalesce(F.max("audience_id"), F.lit(0)).alias("highest")).first()["highest"]
    members = not_pending(members_of(profiles, segment), audiences, campaign_name)
    staged = by_priority(
        members.select(
            "customer_id", "email", "first_name", "preferred_channel", "customer_health_score"
        )
    )
    rows = AUDIENCES.fill(
        staged.withColumns({
            "audience_id": F.col("priority_rank") + F.lit(highest),
            "segment_id": F.lit(segment_id),
            "segment_name": F.lit(segment["segment_name"]).cast("string"),
            "campaign_name": F.lit(campaign_name),
            "campaign_content_id": F.lit(content_id).cast("string"),
            "status": F.lit("pending"),
            "created_at": X.ntz(now),
        })
    )
    waiting = audiences.filter(
        (F.col("segment_id") == segment_id) & (F.col("campaign_name") == campaign_name)
        & (F.col("status") == "pending")
    )
    summary = (
        rows.select("customer_id").unionByName(waiting.select("customer_id"))
        .agg(F.count(F.lit(1)).alias("customers_staged"))
        .select(F.to_json(F.struct(
            "customers_staged", F.lit(segment_id).alias("segment_id"),
            F.lit(segment["segment_name"]).cast("string").alias("segment_name"),
            F.lit(campaign_name).alias("campaign_name"),
            campaign_code(campaign_name, assets, content_id).alias("campaign_id"),
            F.lit("success").alias("status"),
        )).alias("result"))
    )
    return Activation(rows, summary)


# Steps of a response funnel: event type, salt of the time offset, spread and
# floor of the offset in minutes. Fixed values.
FUNNEL = [
    ("send", "", 1380, 60),
    ("open", "O", 1170, 30),
    ("click", "C", 885, 15),
    ("convert", "V", 595, 5),
]


def funnel_events(
    audience: DataFrame,
    campaign_id: str,
    rates: dict[str, float],
    now: datetime,
    known: DataFrame | None = None,
) -> DataFrame:
    """Split an audience into send, open, click and convert groups by a hash of the customer.

    One pass over the audience: each row is repeated for the steps its hash
    falls into. The id is a hash of campaign, customer and step, so the same
    event cannot enter twice; ``known`` events are left out. ``event_number``
    counts within the step.
    """
    who = F.col("customer_id")
    steps = []
    for kind, salt, spread, floor in FUNNEL:
        offset = X.hash_bucket(who, salt, spread) + F.lit(floor)
        earned = F.lit(35) + X.hash_bucket(who, "", 245)
        taken = F.lit(True) if kind == "send" else X.in_sample(who, kind, F.lit(rates[kind]))
        step = F.struct(
            F.lit(len(steps)).alias("step"),
            F.lit(kind).alias("event_type"),
            X.minutes_before(X.ntz(now), offset).alias("event_timestamp"),
            (earned if kind == "convert" else F.lit(None)).cast(X.MONEY).alias("revenue"),
        )
        steps.append(F.when(taken, step))
    events = audience.select(
        who, F.col("preferred_channel").alias("channel"),
        F.explode_outer(F.array(*steps)).alias("e"),
    ).filter(F.col("e").isNotNull()).select("customer_id", "channel", "e.*")
    digest = F.md5(F.concat_ws("|", F.lit(campaign_id), who.cast("string"), F.col("event_type")))
    events = events.withColumns({
        "event_id": F.concat(F.lit("S"), digest),
        "campaign_id": F.lit(campaign_id),
        "device_type": F.lit("mobile"),
    })
    if known is not None:
        events = events.join(known.select("event_id"), "event_id", "left_anti")
    return number_within_steps(events)


def number_within_steps(events: DataFrame) -> DataFrame:
    """Number the events of each step by customer, without one task per step."""
    numbered = rank.row_numbers(events, "event_number", [F.col("step"), F.col("customer_id")])
    # One row for each step: how many events precede it.
    lower = numbered.groupBy("step").agg((F.min("event_number") - 1).alias("lower"))
    numbered = numbered.join(lower, "step").withColumn("event_number", F.col("event_number") - F.col("lower")).drop("lower")
    shown = CAMPAIGN_EVENTS.fill(numbered).columns
    return numbered.withColumn("promo_code_used", F.lit(None).cast("string")).select(
        *shown, "event_number"
    )


def pending(audiences: DataFrame) -> DataFrame:
    """Rows waiting for delivery."""
    return audiences.filter(F.col("status") == "pending")


def hand_over(audiences: DataFrame, path: str) -> None:
    """Write the waiting rows for the sender, one folder of JSON files per channel."""
    pending(audiences).write.mode("overwrite").partitionBy("preferred_channel").json(path)


def mark_activated(audiences: DataFrame, now: datetime) -> DataFrame:
    """The audience table after delivery."""
    waiting = F.col("status") == "pending"
    return audiences.withColumns({
        "activated_at": F.when(waiting, X.ntz(now)).otherwise(F.col("activated_at")),
        "status": F.when(waiting, F.lit("activated")).otherwise(F.col("status")),
    })


def split(audience: DataFrame, key: Column, salt: str, shares: dict[str, float]) -> DataFrame:
    """Label every row with one group by its hash, e.g. hold-out and variants."""
    bucket = X.hash_bucket(key, salt)
    label, upper = None, 0.0
    for name, share in shares.items():
        upper += share
        limit = round(upper * 1000)
        label = F.when(bucket < limit, name) if label is None else label.when(bucket < limit, name)
    return audience.withColumn("split_group", label)
