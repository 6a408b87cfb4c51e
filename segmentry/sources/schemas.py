"""Declared schemas of the write-back tables and a check for them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSchema:
    """Column types, required columns and defaults of one table."""

    columns: dict[str, str]
    required: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)

    def ddl(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in self.columns.items())

    def fill(self, rows: DataFrame) -> DataFrame:
        """Rows with a column list: absent columns take their default, else NULL."""
        out = []
        for name, kind in self.columns.items():
            if name in rows.columns:
                value = F.col(name)
            else:
                value = F.lit(self.defaults.get(name))
            out.append(value.cast(kind).alias(name))
        return rows.select(*out)

    def violations(self, rows: DataFrame) -> DataFrame:
        """Counts of NULLs in required columns and of texts over their length."""
        checks = [
            F.count_if(F.col(n).isNull()).alias(f"{n}_null") for n in self.required
        ] + [
            F.count_if(F.length(n) > limit).alias(f"{n}_too_long") for n, limit in self.lengths.items()
        ]
        return rows.agg(*checks)


BRIEFS = TableSchema(
    columns={
        "brief_id": "string", "campaign_id": "string", "status": "string", "created_by": "string",
        "created_at": "timestamp_ntz", "approved_at": "timestamp_ntz", "brief_content": "string",
    },
    required=("brief_id",),
    defaults={"status": "draft"},
    lengths={"brief_id": 50, "campaign_id": 30, "status": 20, "created_by": 100},
)

ASSETS = TableSchema(
    columns={
        "asset_id": "string", "brief_id": "string", "campaign_id": "string", "asset_type": "string",
        "channel": "string", "content_body": "string", "headline": "string", "cta": "string",
        "approval_status": "string", "brand_voice_score": "decimal(4,2)",
        "generated_at": "timestamp_ntz", "reviewed_by": "string", "reviewed_at": "timestamp_ntz",
        "published_at": "timestamp_ntz", "published_url": "string",
    },
    required=("asset_id",),
    defaults={"approval_status": "draft"},
    lengths={"asset_id": 50, "brief_id": 50, "campaign_id": 30, "headline": 500, "cta": 200},
)

AUDIENCES = TableSchema(
    columns={
        "audience_id": "bigint", "segment_id": "bigint", "segment_name": "string",
        "customer_id": "bigint", "email": "string", "first_name": "string",
        "preferred_channel": "string", "campaign_name": "string", "campaign_content_id": "string",
        "priority_rank": "bigint", "status": "string", "created_at": "timestamp_ntz",
        "activated_at": "timestamp_ntz",
    },
    required=("segment_id", "segment_name", "customer_id", "campaign_name"),
    defaults={"status": "pending"},
    lengths={"segment_name": 200, "campaign_name": 100},
)

CAMPAIGN_EVENTS = TableSchema(
    columns={
        "event_id": "string", "campaign_id": "string", "customer_id": "bigint",
        "event_type": "string", "event_timestamp": "timestamp_ntz", "channel": "string",
        "device_type": "string", "revenue": "decimal(18,2)", "promo_code_used": "string",
    },
    required=("event_id", "campaign_id", "customer_id", "event_type", "event_timestamp"),
)


def declared(columns: str) -> TableSchema:
    """A schema from a list of ``name type``; ``text(n)`` is a text of n characters at most, ``!`` a required column,
    ``= value`` its default."""
    types, required, defaults, lengths = {}, [], {}, {}
    for part in re.split(r",\s*(?![^()]*\))", columns.strip()):
        name, kind, _, default = re.fullmatch(r"(\w+) ([\w(),<> ]+?)!?( = (\w+))?", part.strip()).groups()
        if limit := re.fullmatch(r"text\((\d+)\)", kind):
            kind, lengths[name] = "string", int(limit[1])
        types[name] = kind
        if part.rstrip().endswith("!"):
            required.append(name)
        if default:
            defaults[name] = default
    return TableSchema(types, tuple(required), defaults, lengths)


# Names, types, lengths, required columns and defaults of the data model.
TABLES = {
    "product_categories": declared("""category_id text(10)!, department text(50)!, category_name text(100)!,
        min_price decimal(8,2)!, max_price decimal(8,2)!"""),
    "loyalty_tiers": declared("""tier_id text(10)!, tier_name text(30)!, min_annual_spend decimal(8,2)!,
        max_annual_spend decimal(8,2)!, points_multiplier decimal(4,2)!, discount_pct decimal(4,1)!"""),
    "marketing_campaigns": declared("""campaign_id text(15)!, campaign_name text(50)!, campaign_type text(30)!, start_date date,
        end_date date, channels text(100), message text(200), response_rate decimal(5,2), conversion_rate decimal(5,2)"""),
    "stores": declared("""store_id text(10)!, store_name text(100)!, store_type text(20)!, city text(50)!, state text(2)!,
        zip_code text(10), region text(20)!, opened_date date"""),
    "promotions": declared("""promo_id text(10)!, promo_code text(20)!, promo_name text(100)!, discount_type text(20)!,
        discount_value decimal(6,2)!, min_order_value decimal(8,2), start_date date!, end_date date!, applicable_tiers text(100)"""),
    "audience_segments": declared("""persona_id text(10)!, persona_name text(100)!, description text(500)!, primary_sport text(50)!,
        age_range text(20)!, price_sensitivity text(20)!, channel_preference text(50)!, motivations text(300)!,
        micro_segment_ids array<int>, total_customers bigint, avg_ltv decimal(10,2)"""),
    "customers": declared("""customer_id bigint!, first_name text(50)!, last_name text(50)!, email text(100)!, phone text(20),
        date_of_birth date, gender text(20), city text(50), state text(2), zip_code text(10), region text(20),
        loyalty_tier_id text(10), loyalty_tier_name text(30), annual_spend decimal(10,2), loyalty_points bigint,
        preferred_channel text(20), top_category text(50), marketing_opt_in boolean, push_opt_in boolean, sms_opt_in boolean,
        nearest_store_id text(10), signup_date date, last_login_date date"""),
    "event_stream": declared("""event_id text(20)!, customer_id bigint!, event_type text(30)!, event_timestamp timestamp_ntz!,
        product_id text(15), category_id text(10), session_id text(20), channel text(20), device_type text(20),
        event_properties string"""),
    "campaign_events": CAMPAIGN_EVENTS,
    "campaign_library": declared("""campaign_id text(15)!, campaign_name text(100)!, brief_id text(20), target_segment text(100),
        campaign_type text(30)!, channel text(20)!, subject_line text(200), body_preview text(500), cta_text text(100),
        tone text(50), performance_tier text(20), open_rate decimal(5,4), click_rate decimal(5,4), conversion_rate decimal(5,4),
        revenue_generated decimal(12,2), created_date date, last_used_date date, tags text(500)"""),
    "campaign_briefs": BRIEFS,
    "content_assets": ASSETS,
    "campaign_audiences": AUDIENCES,
    "paid_media_performance": declared("""record_id text(20)!, campaign_id text(15), asset_id text(30), platform text(20),
        ad_set_name text(100), date date!, impressions bigint, clicks bigint, spend decimal(10,2), conversions bigint,
        revenue decimal(12,2), cpm decimal(8,2), cpc decimal(8,2), roas decimal(8,4), cac decimal(8,2)"""),
    "product_sentiment_scores": declared("""product_sentiment_id bigint, category_id text(10), category_name text(100),
        department text(50), avg_sentiment decimal(8,4), review_count bigint, positive_review_count bigint,
        neutral_review_count bigint, negative_review_count bigint, top_positive_themes text(500),
        top_negative_themes text(500), fit_score decimal(5,2), quality_score decimal(5,2), computed_at timestamp_ntz"""),
    "geo_search_queries": declared("""query_id text(15)!, query_text text(300)!, search_platform text(20)!, category text(50),
        impressions bigint, brand_mentioned boolean, brand_mention_rate decimal(6,4), citation_url text(200),
        query_volume bigint, tracked_date date!"""),
    "brand_voice_guidelines": declared("""guideline_id text(10)!, category text(30)!, rule_text text(500)!, examples text(500),
        applies_to_channel text(100), active boolean = true, created_at timestamp_ntz"""),
    "channel_templates": declared("""template_id text(10)!, channel text(20)!, asset_type text(30)!, max_length bigint,
        format_rules text(500), required_elements text(300), example_content text(500), active boolean = true"""),
}
