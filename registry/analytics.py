"""Registered analyses: profile, segments, activation, write-back, performance, metrics."""

from __future__ import annotations

from datetime import datetime
from hashlib import md5

from pyspark.sql import functions as F

from registry.base import Data, query
from registry.sql import (
    RFM, bucket, cnt, mean, ratio, rnd, sel, with_,
)
from segmentry.functions import exprs as X
from segmentry.plans import (
    activation, incremental, metrics, performance, profile, questions, refresh, segments, writeback,
)
from segmentry.sources import bindings, checked
from segmentry.sources.bindings import AS_OF
from segmentry.sources.schemas import ASSETS, AUDIENCES, BRIEFS, CAMPAIGN_EVENTS, TABLES
from segmentry.sources.storage import Tables, materialise, new_path

NOW = datetime(2001, 8, 2, 9, 30, 15)
CAMPAIGN = "Summer Trail Days"
CAMPAIGN_ID = "SUMMER-TRAIL-DA-" + md5(CAMPAIGN.encode()).hexdigest()
SEGMENT_ID = 1

PM = ("customer_id purchase_count_12m total_spend_12m:d avg_order_value last_purchase_date "
      "first_purchase_date return_count_12m cart_add_count_12m wishlist_count_12m")
EM = ("customer_id total_events_12m page_views_12m search_count_12m training_logs_12m goals_set_12m "
      "reviews_written_12m size_exchanges_12m active_days_12m last_activity_date")
CM = ("customer_id email_opens_12m email_clicks_12m campaign_conversions_12m campaign_revenue_12m:d "
      "emails_received_12m unsubscribes_12m")
SEGMENT_BASE = ("rfm_segment churn_risk_tier preferred_channel customer_count avg_spend:d "
                "avg_engagement_score:d avg_campaign_conversion_rate:d avg_ltv_annualized:d "
                "total_revenue_opportunity:d")
SEGMENTS = "segment_id segment_name " + SEGMENT_BASE + " intent_score:d"
OWNED = ("campaign_id campaign_name campaign_type channel period sends opens clicks conversions "
         "owned_revenue:d bounces unsubscribes")
PAID = ("campaign_id platform period impressions paid_clicks spend:d paid_conversions "
        "paid_revenue:d avg_roas:d avg_cac:d")


# ---- customer profile -------------------------------------------------------

@query("purchase_metrics", with_("pm") + sel(PM, "pm"))
def purchase_metrics(d: Data):
    return profile.event_metrics(d.events, AS_OF, ("purchase",))


@query("engagement_metrics", with_("em") + sel(EM, "em"))
def engagement_metrics(d: Data):
    return profile.event_metrics(d.events, AS_OF, ("engagement",))


@query("campaign_metrics", with_("cm") + sel(CM, "cm"))
def campaign_metrics(d: Data):
    return profile.campaign_metrics(d.campaign_events, AS_OF)


@query("rfm_base", with_("rfm_base") + sel("customer_id days_since_purchase frequency monetary:d", "rfm_base"))
def rfm_base(d: Data):
    metrics_ = profile.event_metrics(d.events, AS_OF, ("purchase",))
    return profile.rfm_base(d.customers.select("customer_id"), metrics_, AS_OF)


RFM_COMPOSITE = rnd("CAST(r_score + f_score + m_score AS DOUBLE) / 3.0", 2)


@query("rfm_scores", with_("rfm") + f"""SELECT customer_id, days_since_purchase, frequency,
  CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
  CAST({RFM_COMPOSITE} AS DOUBLE) AS rfm_composite_score FROM rfm""")
def rfm_scores(d: Data):
    return profile.rfm_scores(rfm_base(d))


@query("rfm_segment", with_("rfm") + f"SELECT customer_id, r_score, f_score, {RFM} AS rfm_segment FROM rfm")
def rfm_segment(d: Data):
    scored = rfm_scores(d)
    return scored.select(
        "customer_id", "r_score", "f_score",
        profile.rfm_segment(F.col("r_score"), F.col("f_score")).alias("rfm_segment"),
    )


@query("churn_tier", with_("c360") + """SELECT churn_risk_tier, COUNT(*) AS customers,
  MIN(days_since_last_purchase) AS min_days, MAX(days_since_last_purchase) AS max_days
FROM c360 GROUP BY churn_risk_tier""")
def churn_tier(d: Data):
    days = X.days_between(F.col("last_purchase_date"), X.day(AS_OF))
    joined = d.customers.select("customer_id").join(
        profile.event_metrics(d.events, AS_OF, ("purchase",)), "customer_id", "left"
    )
    return joined.withColumn("days", days).groupBy(
        profile.churn_tier(F.col("days")).alias("churn_risk_tier")
    ).agg(
        F.count(F.lit(1)).alias("customers"), F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
    )


@query("customer_scores", with_("c360") + sel(
    "customer_id engagement_score:d churn_risk_score:d ltv_annualized:d customer_health_score:d "
    "revenue_opportunity_score:d", "c360"))
def customer_scores(d: Data):
    return d.profiles.select(
        "customer_id", "engagement_score", "churn_risk_score", "ltv_annualized",
        "customer_health_score", "revenue_opportunity_score",
    )


@query("customer_rates", with_("c360") + sel(
    "customer_id email_open_rate:d email_click_rate:d campaign_conversion_rate:d return_rate:d", "c360"))
def customer_rates(d: Data):
    """Rates need no ranks, so the profile's scores are not computed for them."""
    counted = d.customers.select("customer_id").join(profile.event_metrics(d.events, AS_OF, ("purchase",)), "customer_id", "left").join(
        profile.campaign_metrics(d.campaign_events, AS_OF), "customer_id", "left")
    return counted.select("customer_id", *[rate.alias(name) for name, rate in profile.customer_rates().items()])


DOUBLES = {
    "annual_spend", "tier_discount_pct", "total_spend_12m", "avg_order_value", "campaign_revenue_12m",
    "email_open_rate", "email_click_rate", "campaign_conversion_rate", "return_rate",
    "rfm_composite_score", "engagement_score", "churn_risk_score", "ltv_annualized",
    "customer_health_score", "revenue_opportunity_score",
}


@query("customer_360", with_("c360") + sel(
    " ".join(c + (":d" if c in DOUBLES else "") for c in profile.PROFILE_COLUMNS), "c360"))
def customer_360(d: Data):
    return d.profiles


# ---- micro-segments ---------------------------------------------------------

@query("segment_base", with_("seg_base") + sel(SEGMENT_BASE, "seg_base"))
def segment_base(d: Data):
    return segments.segment_base(d.profiles, d.min_size)


@query("micro_segments", with_("segments") + sel(SEGMENTS, "segments"))
def micro_segments(d: Data):
    return segments.micro_segments(d.profiles, d.min_size)


MEMBERS = """members AS (SELECT c.* FROM c360 c JOIN segments s ON s.segment_id = 1
  AND s.rfm_segment = c.rfm_segment AND s.churn_risk_tier = c.churn_risk_tier
  AND s.preferred_channel = c.preferred_channel)"""


@query("segment_members", with_("segments") + ", " + MEMBERS + sel(
    " customer_id rfm_segment churn_risk_tier preferred_channel customer_health_score:d", "members"))
def segment_members(d: Data):
    return segments.segment_members(d.stored_profiles, d.segments, SEGMENT_ID).select(
        "customer_id", "rfm_segment", "churn_risk_tier", "preferred_channel", "customer_health_score"
    )


# ---- activation -------------------------------------------------------------

def prior_audience(d: Data):
    """An audience table with history: each customer waits, was served, or was held back."""
    number = F.col("customer_id")
    rows = d.customers.select(
        (number + 1).alias("audience_id"), F.lit(SEGMENT_ID).alias("segment_id"),
        F.lit("earlier").alias("segment_name"), "customer_id", "email", "first_name",
        "preferred_channel", F.lit(CAMPAIGN).alias("campaign_name"),
        F.when(number % 4 == 0, "pending").when(number % 4 == 1, "activated").otherwise("suppressed").alias("status"),
    )
    return AUDIENCES.fill(rows)


PRIOR = "prior AS (SELECT customer_id FROM customers WHERE customer_id % 4 = 0)"
STAGED = f"""staged AS (SELECT m.*, ROW_NUMBER() OVER (ORDER BY customer_health_score DESC, m.customer_id) AS priority_rank
  FROM members m WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE p.customer_id = m.customer_id))"""
ACTIVATE = with_("segments") + ", " + MEMBERS + ", " + PRIOR + ", " + STAGED


def activated(d: Data) -> activation.Activation:
    return activation.activate_segment(
        d.stored_profiles, d.segments, prior_audience(d), SEGMENT_ID, CAMPAIGN, NOW
    )


@query("activate_segment", ACTIVATE + f""" SELECT priority_rank + (SELECT MAX(c_custkey) + 1 FROM customer) AS audience_id, CAST(1 AS BIGINT) AS segment_id,
  (SELECT segment_name FROM segments WHERE segment_id = 1) AS segment_name, customer_id, email,
  first_name, preferred_channel, '{CAMPAIGN}' AS campaign_name, CAST(NULL AS VARCHAR) AS campaign_content_id,
  priority_rank, 'pending' AS status, TIMESTAMP '2001-08-02 09:30:15' AS created_at,
  CAST(NULL AS TIMESTAMP) AS activated_at FROM staged""")
def activate_segment(d: Data):
    return activated(d).rows


@query("activation_summary", ACTIVATE + f""" SELECT '{{"customers_staged":' || CAST(
  (SELECT COUNT(*) FROM staged) + (SELECT COUNT(*) FROM prior) AS VARCHAR)
  || ',"segment_id":1,"segment_name":"' || segment_name || '","campaign_name":"{CAMPAIGN}","campaign_id":"{CAMPAIGN_ID}","status":"success"}}' AS result
FROM segments WHERE segment_id = 1""")
def activation_summary(d: Data):
    return activated(d).summary


@query("activation_rates", with_("segments") + """SELECT segment_id, segment_name,
  GREATEST(LEAST(r * 5.0, 0.65), 0.28) AS open_rate, GREATEST(LEAST(r * 2.5, 0.35), 0.12) AS click_rate,
  GREATEST(r, 0.05) AS convert_rate
FROM (SELECT segment_id, segment_name, CAST(avg_campaign_conversion_rate AS DOUBLE) AS r FROM segments)""")
def activation_rates(d: Data):
    return activation.activation_rates(segments.micro_segments(d.profiles, d.min_size))


@query("join_anti", ACTIVATE + " SELECT customer_id FROM staged")
def join_anti(d: Data):
    members = segments.segment_members(d.stored_profiles, d.segments, SEGMENT_ID)
    return activation.not_pending(members, prior_audience(d), CAMPAIGN).select("customer_id")


@query("priority_rank", with_("c360") + """SELECT customer_id,
  ROW_NUMBER() OVER (ORDER BY customer_health_score DESC, customer_id) AS priority_rank FROM c360""")
def priority_rank(d: Data):
    ranked = activation.by_priority(d.profiles.select("customer_id", "customer_health_score"))
    return ranked.select("customer_id", "priority_rank")


RATES = {"open": 0.40, "click": 0.20, "convert": 0.08}
FUNNEL_SQL = " UNION ALL ".join(
    f"SELECT customer_id, preferred_channel AS channel, '{kind}' AS event_type, "
    f"TIMESTAMP '2001-08-02 09:30:15' - to_minutes({bucket('customer_id', salt, spread)} + {floor}) AS event_timestamp, "
    + (f"CAST(35 + {bucket('customer_id', '', 245)} AS DOUBLE)" if kind == "convert" else "CAST(NULL AS DOUBLE)")
    + " AS revenue FROM customers"
    + ("" if kind == "send" else f" WHERE {bucket('customer_id', kind)} < {RATES[kind] * 1000}")
    for kind, salt, spread, floor in activation.FUNNEL
)


@query("funnel_events", with_("customers") + f"""
SELECT 'S' || md5('{CAMPAIGN_ID}|' || CAST(customer_id AS VARCHAR) || '|' || event_type) AS event_id,
  '{CAMPAIGN_ID}' AS campaign_id, customer_id, event_type, event_timestamp, channel,
  'mobile' AS device_type, revenue, CAST(NULL AS VARCHAR) AS promo_code_used,
  ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY customer_id) AS event_number
FROM ({FUNNEL_SQL})""")
def funnel_events(d: Data):
    audience = d.customers.select("customer_id", "preferred_channel")
    return activation.funnel_events(audience, CAMPAIGN_ID, RATES, NOW)


FLOW_SQL = " UNION ALL ".join(
    f"SELECT preferred_channel AS channel, '{kind}' AS event_type, "
    f"TIMESTAMP '2001-08-02 09:30:15' - to_minutes({bucket('customer_id', salt, spread)} + {floor}) AS event_timestamp, "
    + (f"35 + {bucket('customer_id', '', 245)}" if kind == "convert" else "0") + " AS revenue FROM staged"
    + ("" if kind == "send" else f", r WHERE {bucket('customer_id', kind)} < r.{kind}_rate * 1000")
    for kind, salt, spread, floor in activation.FUNNEL
)


@query("activation_flow", ACTIVATE + f""", r AS (SELECT GREATEST(LEAST(c * 5.0, 0.65), 0.28) AS open_rate,
    GREATEST(LEAST(c * 2.5, 0.35), 0.12) AS click_rate, GREATEST(c, 0.05) AS convert_rate
  FROM (SELECT CAST(avg_campaign_conversion_rate AS DOUBLE) AS c FROM segments WHERE segment_id = 1))
, f AS ({FLOW_SQL})
SELECT '{CAMPAIGN_ID}' AS campaign_id, channel, CAST(date_trunc('week', event_timestamp) AS DATE) AS period,
  {cnt("event_type = 'send'")} AS sends, {cnt("event_type = 'open'")} AS opens, {cnt("event_type = 'click'")} AS clicks,
  {cnt("event_type = 'convert'")} AS conversions, CAST(SUM(revenue) AS DOUBLE) AS owned_revenue
FROM f GROUP BY channel, CAST(date_trunc('week', event_timestamp) AS DATE)""")
def activation_flow(d: Data):
    """Stage a segment, split its audience by the segment's own rates, and report the weeks; a second
    split adds nothing."""
    segments_ = materialise(d.segments, "segments")
    staged = materialise(activation.activate_segment(
        d.stored_profiles, segments_, prior_audience(d), SEGMENT_ID, CAMPAIGN, NOW).rows, "audience")
    # One row: the segment's.
    own = activation.activation_rates(segments_).filter(F.col("segment_id") == SEGMENT_ID).first()
    rates = {kind: own[f"{kind}_rate"] for kind in ("open", "click", "convert")}
    first = materialise(activation.funnel_events(staged, CAMPAIGN_ID, rates, NOW), "flow-events")
    again = activation.funnel_events(staged, CAMPAIGN_ID, rates, NOW, known=first)
    return performance.owned_metrics(first.unionByName(again), d.library).select(
        "campaign_id", "channel", "period", "sends", "opens", "clicks", "conversions", "owned_revenue")


@query("hash_sample", with_("customers") + f"""SELECT customer_id, {bucket('customer_id', 'open')} AS hash_bucket,
  {bucket('customer_id', 'open')} < 0.4 * 1000 AS in_sample,
  CASE WHEN {bucket('customer_id', 'ab')} < 100 THEN 'holdout' WHEN {bucket('customer_id', 'ab')} < 550 THEN 'a'
       ELSE 'b' END AS split_group FROM customers""")
def hash_sample(d: Data):
    who = F.col("customer_id")
    flagged = d.customers.select(
        who, X.hash_bucket(who, "open").alias("hash_bucket"),
        X.in_sample(who, "open", F.lit(0.4)).alias("in_sample"),
    )
    return activation.split(flagged, who, "ab", {"holdout": 0.1, "a": 0.45, "b": 0.45})


@query("outbox_pending", with_("customers") + """SELECT preferred_channel, COUNT(*) AS waiting,
  MIN(customer_id) AS first_customer, MAX(customer_id) AS last_customer
FROM customers WHERE customer_id % 4 = 0 GROUP BY preferred_channel""")
def outbox_pending(d: Data):
    path = new_path(d.spark, "outbox")
    activation.hand_over(prior_audience(d), path)
    sent = d.spark.read.schema(AUDIENCES.ddl()).json(path)
    return sent.groupBy("preferred_channel").agg(
        F.count(F.lit(1)).alias("waiting"), F.min("customer_id").alias("first_customer"),
        F.max("customer_id").alias("last_customer"),
    )


# ---- write-back -------------------------------------------------------------

def no_briefs(d: Data):
    return d.spark.createDataFrame([], BRIEFS.ddl())


SENT = "CAST(TIMESTAMP '2001-08-02 09:30:15' AS TIMESTAMP)"
# The submissions as their JSON text enters the generated ids; the oracle builds the same text.
BRIEF_TEXT = """'{' || concat_ws(',',
  CASE WHEN given_id IS NOT NULL THEN '"brief_id":"' || given_id || '"' END,
  CASE WHEN status IS NOT NULL THEN '"status":"' || status || '"' END,
  '"created_by":' || to_json(created_by), '"persona_name":' || to_json(created_by), '"objective":' || to_json(objective),
  CASE WHEN tone IS NOT NULL THEN '"tone":"' || tone || '"' END) || '}'"""


@query("save_briefs", with_("briefs_in") + f"""
, named AS (SELECT *, COALESCE(given_id, 'BRF-' || replace(campaign_id, 'CMP-', '') || '-093015-'
    || md5(campaign_id || '|' || {BRIEF_TEXT} || '|' || CAST(sequence AS VARCHAR))) AS brief_id FROM briefs_in)
, kept AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY brief_id ORDER BY sequence DESC) AS rn FROM named) WHERE rn = 1)
SELECT brief_id, campaign_id, COALESCE(status, 'draft') AS status, created_by, {SENT} AS created_at, objective, tone FROM kept""")
def save_briefs(d: Data):
    saved = writeback.save_briefs(no_briefs(d), bindings.brief_submissions(d.spark, d.dir), NOW)
    return saved.select(
        "brief_id", "campaign_id", "status", "created_by", "created_at",
        F.get_json_object("brief_content", "$.objective").alias("objective"),
        F.get_json_object("brief_content", "$.tone").alias("tone"),
    )


@query("save_assets", with_("assets_in") + """
SELECT COALESCE(given_id, 'generated-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS asset_id, brief_id,
  campaign_id, asset_type, channel, content_body, headline, CAST(NULL AS VARCHAR) AS cta,
  COALESCE(approval_status, 'draft') AS approval_status,
  CAST(ROUND(CAST(score AS DECIMAL(18,6)), 0) AS DOUBLE) AS brand_voice_score,
  TIMESTAMP '2001-08-02 09:30:15' AS generated_at FROM assets_in""")
def save_assets(d: Data):
    none = d.spark.createDataFrame([], ASSETS.ddl())
    sent = bindings.asset_submissions(d.spark, d.dir)
    saved = writeback.save_assets(none, sent, NOW)
    # Each generated id is traced to its one submission, which a merged or repeated id would break.
    made = writeback.generated_asset_id(F.get_json_object("asset_json", "$.channel"), NOW)
    names = sent.select(made.alias("asset_id"), F.format_string("generated-%d-%d", F.floor(F.col("sequence") / 1000), F.col("sequence") % 1000).alias("name"))
    return saved.join(names, "asset_id", "left").select(
        F.coalesce("name", "asset_id").alias("asset_id"),
        "brief_id", "campaign_id", "asset_type", "channel", "content_body", "headline", "cta",
        "approval_status", "brand_voice_score", "generated_at",
    )


@query("reset_state", """SELECT 'campaign_audiences' AS table_name, CAST(0 AS BIGINT) AS row_count UNION ALL SELECT 'campaign_briefs', 0
UNION ALL SELECT 'content_assets', 0 UNION ALL SELECT 'campaign_events', COUNT(*) FROM orders""")
def reset_state(d: Data):
    """Clear what activation and write-back added; the delivery events of the source stay."""
    tables = Tables(d.spark)
    tables.overwrite("campaign_audiences", prior_audience(d))
    tables.overwrite("campaign_briefs", writeback.save_briefs(no_briefs(d), bindings.brief_submissions(d.spark, d.dir), NOW))
    tables.overwrite("content_assets", writeback.parsed_assets(bindings.asset_submissions(d.spark, d.dir), NOW))
    own = CAMPAIGN_EVENTS.fill(d.campaign_events)
    tables.overwrite("campaign_events", own.unionByName(CAMPAIGN_EVENTS.fill(funnel_events(d))))
    return writeback.reset(tables)


# ---- performance ------------------------------------------------------------

@query("owned_metrics", with_("owned") + sel(OWNED, "owned"))
def owned_metrics(d: Data):
    return performance.owned_metrics(d.campaign_events, d.library)


@query("paid_metrics", with_("paidw") + sel(PAID, "paidw"))
def paid_metrics(d: Data):
    return performance.paid_metrics(d.paid_media)


# Both sides are stacked instead of joined in full: owned rows with their paid
# partners, then the paid rows without one.
PAIRED = """paired AS (
SELECT o.campaign_id, o.period, o.channel, p.platform, o.campaign_name AS name, o.campaign_type, o.sends, o.opens, o.clicks,
  o.conversions AS won, o.owned_revenue, p.impressions, p.paid_clicks, p.spend, p.paid_conversions, p.paid_revenue, p.avg_roas, p.avg_cac
FROM owned o LEFT JOIN paidw p USING (campaign_id, period)
UNION ALL
SELECT p.campaign_id, p.period, NULL, p.platform, NULL, NULL, NULL, NULL, NULL, NULL, NULL, p.impressions, p.paid_clicks, p.spend,
  p.paid_conversions, p.paid_revenue, p.avg_roas, p.avg_cac
FROM paidw p WHERE NOT EXISTS (FROM owned o WHERE o.campaign_id = p.campaign_id AND o.period = p.period))"""
MEASURES = (
    "ifnull(sends, 0) AS sends, ifnull(opens, 0) AS opens, ifnull(clicks, 0) AS clicks, "
    "ifnull(won, 0) + ifnull(paid_conversions, 0) AS conversions, "
    "CAST(ifnull(owned_revenue, 0) + ifnull(paid_revenue, 0) AS DOUBLE) AS total_revenue, "
    "CAST(ifnull(spend, 0) AS DOUBLE) AS paid_spend, ifnull(impressions, 0) AS impressions, "
    "ifnull(avg_roas, 0) AS roas, ifnull(avg_cac, 0) AS cac"
)
RATE_COLUMNS = (f"CAST({ratio('opens', 'sends')} AS DOUBLE) AS email_open_rate, "
                f"CAST({ratio('clicks', 'opens')} AS DOUBLE) AS ctr, "
                f"CAST({ratio('conversions', 'sends')} AS DOUBLE) AS cvr")


@query("perf_gold", with_("owned", "paidw") + f""", {PAIRED}, shown AS (
SELECT campaign_id, CASE WHEN sends IS NOT NULL THEN ifnull(name, campaign_id) END AS campaign_name, campaign_type,
  ifnull(channel, platform) AS channel, period, {MEASURES} FROM paired WHERE period IS NOT NULL)
SELECT *, {RATE_COLUMNS} FROM shown""")
def perf_gold(d: Data):
    return performance.campaign_performance(owned_metrics(d), paid_metrics(d))


@query("perf_gold_dedup", with_("owned", "paid") + f""", keys AS (
SELECT campaign_id, period FROM owned UNION SELECT campaign_id, CAST(date_trunc('week', date) AS DATE) FROM paid)
, o AS (SELECT campaign_id, period, MAX(campaign_name) AS campaign_name, MAX(campaign_type) AS campaign_type,
  {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {c}' for c in ('sends', 'opens', 'clicks'))},
  CAST(SUM(conversions) AS BIGINT) AS won, SUM(owned_revenue) AS owned_revenue FROM owned GROUP BY ALL)
, p AS (SELECT campaign_id, CAST(date_trunc('week', date) AS DATE) AS period,
  CAST(SUM(impressions) AS BIGINT) AS impressions, SUM(spend) AS spend,
  CAST(SUM(conversions) AS BIGINT) AS paid_conversions, SUM(revenue) AS paid_revenue,
  {mean('roas')} AS avg_roas, {mean('cac')} AS avg_cac FROM paid GROUP BY ALL)
, shown AS (SELECT campaign_id, campaign_name, campaign_type, period, {MEASURES}
  FROM keys LEFT JOIN o USING (campaign_id, period) LEFT JOIN p USING (campaign_id, period))
SELECT *, {RATE_COLUMNS} FROM shown""")
def perf_gold_dedup(d: Data):
    return performance.campaign_performance_by_week(d.campaign_events, d.library, d.paid_media)


@query("join_full_outer", with_("owned", "paidw") + f""", {PAIRED}
SELECT campaign_id, period, channel, platform, sends, paid_clicks FROM paired""")
def join_full_outer(d: Data):
    joined = performance.join_owned_paid(owned_metrics(d), paid_metrics(d))
    return joined.select("campaign_id", "period", "channel", "platform", "sends", "paid_clicks")


# ---- refresh ----------------------------------------------------------------

@query("refresh_full", with_("owned") + sel(OWNED, "owned"))
def refresh_full(d: Data):
    tables = Tables(d.spark)
    owned = refresh.Derived("owned_metrics", lambda done: owned_metrics(d))
    return refresh.refresh(tables, [owned])["owned_metrics"]


@query("refresh_chain", with_("segments") + sel(SEGMENTS, "segments"))
def refresh_chain(d: Data):
    chain = [
        refresh.Derived(
            "micro_segments",
            lambda done: segments.micro_segments(done["customer_360"], d.min_size),
            after=("customer_360",),
        ),
        refresh.Derived("customer_360", lambda done: d.profiles),
    ]
    return refresh.refresh(Tables(d.spark), chain)["micro_segments"]


# ---- metrics layer ----------------------------------------------------------

def layer(d: Data) -> metrics.MetricsLayer:
    return metrics.MetricsLayer(d.stored_profiles, d.segments)


JOINED = """joined AS (SELECT c.*, s.segment_id, s.segment_name, s.total_revenue_opportunity, s.intent_score
  FROM c360 c LEFT JOIN segments s ON s.rfm_segment = c.rfm_segment
  AND s.churn_risk_tier = c.churn_risk_tier AND s.preferred_channel = c.preferred_channel)"""


@query("semantic_join", with_("segments") + ", " + JOINED + sel(
    " customer_id rfm_segment segment_id segment_name ltv_annualized:d total_revenue_opportunity:d", "joined"))
def semantic_join(d: Data):
    return layer(d).query(
        dims=["customer_id", "rfm_segment", "segment_id", "segment_name"],
        facts=["ltv_annualized", "total_revenue_opportunity"],
    )


CUSTOMER_METRICS = {m: (x.kind, x.column) for m, x in metrics.METRICS.items() if x.entity == "customer"}
METRIC_SQL = ", ".join(
    (f"COUNT({c})" if kind == "count" else mean(c) if kind == "avg" else f"CAST(SUM({c}) AS DOUBLE)") + f" AS {m}"
    for m, (kind, c) in CUSTOMER_METRICS.items()
)


@query("semantic_metrics", with_("segments") + ", " + JOINED + f"""
, a AS (SELECT region, loyalty_tier_name, {METRIC_SQL} FROM joined GROUP BY region, loyalty_tier_name)
, b AS (SELECT region, loyalty_tier_name, {mean('intent_score')} AS avg_intent_score FROM
  (SELECT DISTINCT region, loyalty_tier_name, segment_id, intent_score FROM joined) GROUP BY region, loyalty_tier_name)
SELECT a.*, b.avg_intent_score FROM a JOIN b ON a.region IS NOT DISTINCT FROM b.region
  AND a.loyalty_tier_name IS NOT DISTINCT FROM b.loyalty_tier_name""")
def semantic_metrics(d: Data):
    return layer(d).query(dims=["region", "loyalty_tier_name"], metrics=list(metrics.METRICS))


@query("semantic_topk", with_("segments") + ", " + JOINED + f"""
SELECT segment_name, COUNT(customer_id) AS customer_count, CAST(SUM(ltv_annualized) AS DOUBLE) AS total_ltv
FROM joined WHERE loyalty_tier_name <> 'Starter' GROUP BY segment_name
ORDER BY total_ltv DESC NULLS LAST, segment_name LIMIT 5""")
def semantic_topk(d: Data):
    return layer(d).query(
        dims=["segment_name"], metrics=["customer_count", "total_ltv"],
        where="loyalty_tier_name <> 'Starter'",
        order=[F.col("total_ltv").desc_nulls_last(), F.col("segment_name")], limit=5,
    )


# ---- analyst questions ------------------------------------------------------

@query("q_top_segments", with_("segments") + """SELECT segment_id, segment_name, customer_count,
  CAST(intent_score AS DOUBLE) AS intent_score FROM segments ORDER BY intent_score DESC NULLS FIRST, segment_id LIMIT 5""")
def q_top_segments(d: Data):
    return questions.top_segments(segments.micro_segments(d.profiles, d.min_size))


@query("q_segment_size", with_("c360") + """SELECT COUNT(*) AS customer_count FROM c360
WHERE rfm_segment = 'Champion' AND churn_risk_tier = 'Low' AND preferred_channel = 'email'""")
def q_segment_size(d: Data):
    return questions.segment_size(d.profiles, "Champion", "Low", "email")


@query("q_best_campaigns", with_("c360", "ce", "library") + f""", s AS (SELECT campaign_id, {cnt("event_type = 'send'")} AS sends,
  {cnt("event_type = 'convert'")} AS conversions FROM ce
  WHERE customer_id IN (SELECT customer_id FROM c360 WHERE churn_risk_tier = 'High') GROUP BY campaign_id)
SELECT s.campaign_id, library.campaign_name, sends, conversions, CAST({ratio('conversions', 'sends')} AS DOUBLE) AS conversion_rate
FROM s LEFT JOIN library ON library.campaign_id = s.campaign_id ORDER BY conversion_rate DESC, s.campaign_id LIMIT 10""")
def q_best_campaigns(d: Data):
    bought = profile.event_metrics(d.events, AS_OF, ("purchase",))
    days = X.days_between(F.col("last_purchase_date"), X.day(AS_OF))
    tiers = d.customers.select("customer_id").join(bought, "customer_id", "left").select(
        "customer_id", profile.churn_tier(days).alias("churn_risk_tier"))
    return questions.best_campaigns(d.campaign_events, tiers, d.library)


@query("q_compare_types", with_("ce", "library") + f""", o AS (SELECT campaign_id, {cnt("event_type = 'send'")} AS sends,
  {cnt("event_type = 'convert'")} AS conversions FROM ce GROUP BY campaign_id)
SELECT campaign_type, CAST({rnd(mean('conversion_rate'), 4)} AS DOUBLE) AS recorded_rate,
  CAST(SUM(sends) AS BIGINT) AS sends, CAST({ratio('SUM(conversions)', 'SUM(sends)')} AS DOUBLE) AS observed_rate
FROM library LEFT JOIN o ON o.campaign_id = library.campaign_id
WHERE campaign_type IN (SELECT DISTINCT campaign_type FROM library ORDER BY 1 LIMIT 2) GROUP BY campaign_type""")
def q_compare_types(d: Data):
    """The first two types of the library."""
    first = d.library.select("campaign_type").distinct().orderBy("campaign_type").limit(2)
    return questions.compare_types(d.campaign_events, d.library, first)


@query("q_cart_abandon", with_("c360", "min_size") + f""", s AS (SELECT rfm_segment, churn_risk_tier, preferred_channel,
  COUNT(*) AS customer_count, CAST(SUM(purchase_count_12m) AS BIGINT) AS purchases,
  CAST(SUM(cart_add_count_12m) AS BIGINT) AS cart_adds FROM c360 GROUP BY ALL
  HAVING COUNT(*) >= (SELECT n FROM min_size))
SELECT *, CASE WHEN cart_adds > 0 THEN CAST({rnd('1.0 - LEAST(1.0, CAST(purchases AS DOUBLE) / cart_adds)', 4)} AS DOUBLE) END
  AS abandonment_rate FROM s""")
def q_cart_abandon(d: Data):
    return questions.cart_abandonment(d.profiles, d.min_size)


@query("q_tier_opportunity", with_("c360") + """SELECT COUNT(*) AS customer_count,
  CAST(SUM(revenue_opportunity_score) AS DOUBLE) AS total_revenue_opportunity
FROM c360 WHERE loyalty_tier_name = 'Elite'""")
def q_tier_opportunity(d: Data):
    return questions.tier_opportunity(d.profiles)


# ---- incremental refresh and checked writes ---------------------------------

@query("refresh_incremental", with_("pm", "em") + sel(PM, "pm").replace("SELECT", "SELECT em.* EXCLUDE (customer_id),").replace(
    " customer_id,", " pm.customer_id,") + " JOIN em ON em.customer_id = pm.customer_id")
def refresh_incremental(d: Data):
    """The year's metrics after two refreshes with new, late, future and expired events."""
    when = F.col("event_timestamp")
    number = F.replace(F.col("event_id"), F.lit("EVT-"), F.lit("")).cast("bigint")
    late = number % 11 == 0
    first, second = datetime(2001, 5, 20), datetime(2001, 7, 9)
    state = incremental.start(d.events.filter((when < X.ntz(first)) & ~late), first)
    arrived = d.events.filter(((when >= X.ntz(first)) & (when < X.ntz(second)) & ~late) | (late & (number % 2 == 0) & (when < X.ntz(second))))
    state = incremental.advance(state, arrived, second, "second")
    rest = d.events.filter((when >= X.ntz(second)) | (late & (number % 2 == 1)))
    return incremental.metrics(incremental.advance(state, rest, AS_OF, "third"))


@query("schema_check", """WITH a AS (SELECT o_orderkey AS event_id, o_custkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN repeat('x', 31) ELSE o_orderpriority END AS kind,
  CASE WHEN o_orderkey % 5 = 0 THEN 'no time' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS moment, o_orderkey FROM orders)
, f AS (SELECT o_orderkey, unnest([x FOR x IN [
  CASE WHEN kind IS NULL THEN 'event_type: missing' END, CASE WHEN length(kind) > 30 THEN 'event_type: length' END,
  CASE WHEN moment = 'no time' THEN 'event_timestamp: type' END] IF x IS NOT NULL]) AS fault FROM a)
SELECT fault, COUNT(*) AS row_count FROM f GROUP BY fault
UNION ALL SELECT 'kept', COUNT(*) FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM f)""")
def schema_check(d: Data):
    """Raw events with faults, written through the declared schema: faults found, and rows kept."""
    number = F.col("o_orderkey")
    raw = d.table("orders").select(
        F.concat(F.lit("E"), number.cast("string")).alias("event_id"), F.col("o_custkey").alias("customer_id"),
        F.when(number % 7 == 0, F.lit(None)).when(number % 7 == 1, F.lit("x" * 31)).otherwise(F.col("o_orderpriority")).alias("event_type"),
        F.when(number % 5 == 0, "no time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("event_timestamp"))
    path, rejects = new_path(d.spark, "events"), new_path(d.spark, "rejects")
    checked.write(raw, TABLES["event_stream"], path, rejects, key=["event_id"])
    faults = d.spark.read.parquet(rejects).select(F.explode("faults").alias("fault")).groupBy("fault").agg(F.count(F.lit(1)).alias("row_count"))
    kept = d.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("kept").alias("fault"), "row_count")
    return faults.unionByName(kept)
