"""Checks of content assets against the channel templates before publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ["too_long", "subject_length", "missing_stop", "click_here", "all_caps", "no_template"]


def check_assets(assets: DataFrame, templates: DataFrame) -> DataFrame:
    """One flag per rule and asset; a rule that does not apply is false.

    The templates are joined without a hint: the planner broadcasts them by
    their known size. Fixed values: the lengths.
    """
    sides = templates.select("channel", "asset_type", "template_id", "max_length")
    body = F.coalesce(F.col("content_body"), F.lit(""))
    length = F.length(body)
    subject = F.coalesce(F.col("asset_type") == "subject_line", F.lit(False))
    sms = F.coalesce(F.col("channel") == "sms", F.lit(False))
    joined = assets.join(sides, ["channel", "asset_type"], "left")
    flags = {
        "too_long": F.coalesce(length > F.col("max_length"), F.lit(False)),
        "subject_length": subject & ~length.between(35, 55),
        "missing_stop": sms & ~F.contains(body, F.lit("STOP")),
        "click_here": F.contains(F.lower(body), F.lit("click here")),
        "all_caps": subject & (F.upper(body) == body) & (F.lower(body) != body),
        "no_template": F.col("template_id").isNull(),
    }
    checked = joined.withColumns(flags)
    broken = sum((F.col(r).cast("int") for r in RULES), F.lit(0))
    return checked.withColumn("violations", broken)


def violation_rollup(checked: DataFrame) -> DataFrame:
    """Counts of broken rules per channel and asset type."""
    return checked.groupBy("channel", "asset_type").agg(
        F.count(F.lit(1)).alias("assets"),
        *[F.count_if(F.col(r)).alias(r) for r in RULES],
        F.count_if(F.col("violations") == 0).alias("publishable"),
    )
