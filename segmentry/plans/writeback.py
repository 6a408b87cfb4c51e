"""Saving briefs and content assets that arrive as JSON, in batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.operators import dml
from segmentry.plans.refresh import row_counts
from segmentry.sources.schemas import ASSETS, BRIEFS
from segmentry.sources.storage import Tables

BRIEF_FIELDS = "brief_id string, status string, created_by string"
ASSET_FIELDS = (
    "asset_id string, campaign_id string, channel string, asset_type string, content_body string, "
    "headline string, cta string, approval_status string, brand_voice_score string"
)


def _digest(*columns: Column) -> Column:
    """Keeps generated ids apart; the time alone has only seconds, and equal contents differ in their sequence."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))


def parsed_briefs(submissions: DataFrame, now: datetime) -> DataFrame:
    """``campaign_id, brief_json, sequence`` to brief rows; the JSON is parsed once."""
    body = submissions.withColumn("b", F.from_json("brief_json", BRIEF_FIELDS))
    made = F.concat(
        F.lit("BRF-"), F.replace(F.col("campaign_id"), F.lit("CMP-"), F.lit("")), F.lit("-"),
        F.date_format(X.ntz(now), "HHmmss"), F.lit("-"),
        _digest(F.col("campaign_id"), F.col("brief_json"), F.col("sequence")),
    )
    return body.select(
        F.coalesce(F.col("b.brief_id"), made).alias("brief_id"),
        "campaign_id",
        F.coalesce(F.col("b.status"), F.lit("draft")).alias("status"),
        F.col("b.created_by").alias("created_by"),
        X.ntz(now).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.col("brief_json").alias("brief_content"),
        "sequence",
    )


def save_briefs(existing: DataFrame, submissions: DataFrame, now: datetime) -> DataFrame:
    """The brief table after the batch. A brief sent several times keeps its last content,
    a known brief keeps its creation time."""
    rows = dml.latest(parsed_briefs(submissions, now), ["brief_id"], F.col("sequence"))
    return dml.upsert(
        existing, BRIEFS.fill(rows), ["brief_id"],
        update=["campaign_id", "status", "created_by", "brief_content"],
    )


def generated_asset_id(channel: Column, now: datetime) -> Column:
    """The id of a submission that brings none; unique, as the whole submission and its sequence are digested."""
    return F.concat(
        F.lit("AST-"), F.replace(F.col("brief_id"), F.lit("BRF-"), F.lit("")), F.lit("-"),
        F.upper(F.left(channel, F.lit(3))), F.lit("-"),
        F.date_format(X.ntz(now), "HHmmss"), F.lit("-"),
        _digest(F.col("brief_id"), F.col("asset_json"), F.col("sequence")),
    )


def parsed_assets(submissions: DataFrame, now: datetime) -> DataFrame:
    """``brief_id, asset_json, sequence`` to asset rows, one for each id: of a repeated given id the last
    submission counts. The voice score is kept as a whole number; an unreadable one fails the job."""
    body = submissions.withColumn("a", F.from_json("asset_json", ASSET_FIELDS))
    made = generated_asset_id(F.col("a.channel"), now)
    score = F.round(F.col("a.brand_voice_score").cast("decimal(18,6)"), 0)
    rows = body.select(
        F.coalesce(F.col("a.asset_id"), made).alias("asset_id"),
        "brief_id",
        *[F.col(f"a.{c}").alias(c) for c in
          ("campaign_id", "channel", "asset_type", "content_body", "headline", "cta")],
        F.coalesce(F.col("a.approval_status"), F.lit("draft")).alias("approval_status"),
        score.alias("brand_voice_score"),
        X.ntz(now).alias("generated_at"),
        "sequence",
    )
    return ASSETS.fill(dml.latest(rows, ["asset_id"], F.col("sequence")))


def save_assets(existing: DataFrame, submissions: DataFrame, now: datetime) -> DataFrame:
    """The asset table after the batch: new ids are added, a known id takes the new content."""
    rows = parsed_assets(submissions, now)
    return dml.upsert(existing, rows, ["asset_id"], update=[c for c in rows.columns if c != "asset_id"])


WRITTEN_BACK = ["campaign_audiences", "campaign_briefs", "content_assets"]
SEEDED = "S"  # Fixed value: ids of events written by an activation start with it.


def reset(tables: Tables) -> DataFrame:
    """Empty the write-back tables, drop seeded delivery events, and count what is left."""
    for name in WRITTEN_BACK:
        tables.truncate(name)
    events = tables.read("campaign_events")
    tables.overwrite("campaign_events", dml.delete_where(events, F.col("event_id").startswith(SEEDED)))
    return row_counts({n: tables.read(n) for n in [*WRITTEN_BACK, "campaign_events"]})
