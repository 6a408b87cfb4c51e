"""The generic test tables read as the tables of the data model.

Every binding is a projection (plus dimension joins for customers), so filters
and column pruning of the plans still reach the Parquet scan. The columns that
the generic tables lack are derived from the keys by fixed rules.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.sources import seeds

AS_OF = datetime(2001, 8, 2)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tier_rule(spend: Column, values: list[str]) -> Column:
    """First tier whose upper bound is above the spend."""
    return (
        F.when(spend < 300, values[0]).when(spend < 1000, values[1])
        .when(spend < 2500, values[2]).otherwise(values[3])
    )


def customers(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    number = F.col("c_custkey")
    spend = F.col("c_acctbal").cast(X.MONEY)
    today = X.day(as_of)
    # Nation and region are small by their file size; the planner broadcasts
    # them on that evidence, so no hint is given.
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        number.alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        # What the tables lack is taken from the balance, the market segment and the place.
        F.concat(F.lit("+00 "), X.padded(F.col("c_nationkey"), 2), F.lit(" "), X.padded(number, 9)).alias("phone"),
        F.date_sub(F.date_sub(today, 7300), F.floor(F.abs(F.col("c_acctbal"))).cast("int")).alias("date_of_birth"),
        X.cycle(seeds.GENDERS, F.length("c_mktsegment").cast("bigint")).alias("gender"),
        F.col("n_name").alias("city"),
        F.right(F.col("n_name"), F.lit(2)).alias("state"),
        F.concat(X.padded(F.col("c_nationkey"), 2), X.padded(number % 1000, 3)).alias("zip_code"),
        F.col("r_name").alias("region"),
        tier_rule(spend, [t[0] for t in seeds.LOYALTY_TIERS]).alias("loyalty_tier_id"),
        tier_rule(spend, [t[1] for t in seeds.LOYALTY_TIERS]).alias("loyalty_tier_name"),
        spend.alias("annual_spend"),
        F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0))).cast("bigint").alias("loyalty_points"),
        X.cycle(seeds.PREFERRED_CHANNELS, F.col("c_nationkey").cast("bigint")).alias("preferred_channel"),
        F.col("c_mktsegment").alias("top_category"),
        (F.col("c_acctbal") >= 0).alias("marketing_opt_in"),
        (F.length("c_mktsegment") > 8).alias("push_opt_in"),
        (F.col("c_nationkey") < 13).alias("sms_opt_in"),
        F.concat(F.lit("STR-"), X.padded(F.col("c_nationkey") + 1, 3)).alias("nearest_store_id"),
        F.date_sub(today, F.floor(F.col("c_acctbal") + 1001).cast("int")).alias("signup_date"),
        F.date_sub(today, F.col("c_nationkey").cast("int")).alias("last_login_date"),
    )


def activity(orders: DataFrame) -> DataFrame:
    """The event stream: one activity per order, amount kept as JSON properties."""
    return orders.select(
        F.concat(F.lit("EVT-"), F.col("o_orderkey").cast("string")).alias("event_id"),
        F.col("o_custkey").alias("customer_id"),
        X.cycle(seeds.EVENT_TYPES, F.col("o_orderkey")).alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.to_json(F.struct(F.col("o_totalprice").alias("amount"))).alias("event_properties"),
    )


def campaign_activity(orders: DataFrame) -> DataFrame:
    """Campaign delivery events: one per order."""
    number = F.col("o_orderkey")
    kind = X.cycle(seeds.CAMPAIGN_EVENT_TYPES, number)
    return orders.select(
        F.concat(F.lit("CEV-"), number.cast("string")).alias("event_id"),
        X.cycle(seeds.CAMPAIGN_IDS, F.col("o_custkey")).alias("campaign_id"),
        F.col("o_custkey").alias("customer_id"),
        kind.alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
        X.cycle(seeds.CAMPAIGN_CHANNELS, number).alias("channel"),
        X.cycle(seeds.DEVICES, number).alias("device_type"),
        F.when(kind == "convert", F.col("o_totalprice").cast(X.MONEY)).alias("revenue"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity(load(spark, sf_dir, "orders"))


def campaign_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_activity(load(spark, sf_dir, "orders"))


def paid_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertising results: one record per order line."""
    line = load(spark, sf_dir, "lineitem")
    spend = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    revenue = F.col("l_extendedprice").cast(X.MONEY)
    sold = F.col("l_quantity").cast("bigint")
    return line.select(
        X.cycle(seeds.CAMPAIGN_IDS, F.col("l_suppkey")).alias("campaign_id"),
        F.col("l_returnflag").alias("platform"),
        F.col("l_shipdate").alias("date"),
        (sold * 100).alias("impressions"),
        sold.alias("clicks"),
        spend.alias("spend"),
        F.col("l_linenumber").cast("bigint").alias("conversions"),
        revenue.alias("revenue"),
        # Row-level ratios on a fixed decimal grid, so their sums are exact.
        (F.col("l_tax") * 100).cast("decimal(18,4)").alias("roas"),
        (F.col("l_discount") * 50).cast("decimal(18,4)").alias("cac"),
    )


CATEGORIES = 12


def category_id(number: Column) -> Column:
    return F.concat(F.lit("CAT-"), X.padded(number % CATEGORIES + 1, 3))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product categories: the parts of one remainder, with their first type and name and their price range."""
    price = F.col("p_retailprice").cast("decimal(8,2)")
    return load(spark, sf_dir, "part").groupBy(category_id(F.col("p_partkey")).alias("category_id")).agg(
        F.min("p_type").alias("department"), F.min("p_name").alias("category_name"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"))


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One library entry per campaign: the supplier and the part of the campaign's number.

    The recorded rates are the supplier's balance in three scales.
    """
    number = F.col("s_suppkey")
    cents = F.round(F.abs(F.col("s_acctbal")) * 100).cast("bigint")
    rate = lambda most: ((cents % most) / F.lit(10000.0)).cast("decimal(5,4)")
    known = load(spark, sf_dir, "supplier").filter((number >= 0) & (number < len(seeds.CAMPAIGN_IDS)))
    return known.join(load(spark, sf_dir, "part"), number == F.col("p_partkey")).select(
        X.cycle(seeds.CAMPAIGN_IDS, number).alias("campaign_id"), F.col("s_name").alias("campaign_name"),
        F.concat(F.lit("NATION "), F.col("s_nationkey").cast("string")).alias("target_segment"), F.col("p_type").alias("campaign_type"),
        X.cycle(seeds.CAMPAIGN_CHANNELS, number).alias("channel"), F.col("p_brand").alias("performance_tier"),
        rate(5000).alias("open_rate"), rate(2500).alias("click_rate"), rate(1500).alias("conversion_rate"))


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A persona per market segment; its micro-segments, as a JSON array, are the nation numbers of the segment's remainder."""
    nation = F.col("c_nationkey").cast("bigint")
    own = F.when(nation % 5 == F.length("c_mktsegment") % 5, nation)
    return load(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("persona_name")).agg(
        F.to_json(F.sort_array(F.collect_set(own))).alias("micro_segment_ids"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library entries with text: source and language are the filterable attributes."""
    return load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts with the product category they belong to."""
    docs = load(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("review_id"),
        category_id(F.col("doc_id")).alias("category_id"),
        F.col("text").alias("review_text"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings")


def brief_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Briefs as submitted: every second turn brings its own id, several turns one brief."""
    turns = load(spark, sf_dir, "conversations")
    given = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("BRF-"), F.col("conv_id").cast("string")))
    status = F.when(F.col("turn") % 3 == 0, F.lit("approved"))
    body = F.struct(
        given.alias("brief_id"), status.alias("status"), F.col("role").alias("created_by"),
        F.col("role").alias("persona_name"), F.col("text").alias("objective"),
        F.when(F.col("turn") > 1, F.lit("friendly")).alias("tone"),
    )
    return turns.select(
        X.cycle(seeds.CAMPAIGN_IDS, F.col("conv_id")).alias("campaign_id"),
        F.to_json(body).alias("brief_json"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("sequence"),
    )


def asset_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content assets as submitted, one per conversation turn."""
    turns = load(spark, sf_dir, "conversations")
    slot = F.col("conv_id") * 3 + F.col("turn")
    channels = [t[1] for t in seeds.TEMPLATES] + ["print"]
    types = [t[2] for t in seeds.TEMPLATES] + ["flyer"]
    given = F.when(F.col("turn") % 4 == 0,
                   F.concat(F.lit("AST-"), F.col("conv_id").cast("string"), F.lit("-"),
                            F.col("turn").cast("string")))
    body = F.struct(
        given.alias("asset_id"),
        X.cycle(seeds.CAMPAIGN_IDS, F.col("conv_id")).alias("campaign_id"),
        X.cycle(channels, slot).alias("channel"),
        X.cycle(types, slot).alias("asset_type"),
        F.col("text").alias("content_body"),
        F.col("text").alias("headline"),
        F.when(F.col("turn") % 5 == 0, F.lit("in_review")).alias("approval_status"),
        ((slot % 40) / F.lit(4.0)).alias("brand_voice_score"),
    )
    return turns.select(
        F.concat(F.lit("BRF-"), F.col("conv_id").cast("string")).alias("brief_id"),
        F.to_json(body).alias("asset_json"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("sequence"),
    )
