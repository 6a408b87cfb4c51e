"""SQL building blocks of the oracle queries."""

from __future__ import annotations

from segmentry.sources import seeds

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
TODAY = "DATE '2001-08-02'"


def cycle(values: list[str], position: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST(({position}) % {len(values)} AS INTEGER) + 1]"


def rnd(value: str, digits: int) -> str:
    """Rounded half up, as a fixed-point number."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,8)), {digits}) AS DECIMAL(22,{digits}))"


def ratio(n: str, d: str, digits: int = 4) -> str:
    return (f"CASE WHEN ({d}) > 0 THEN {rnd(f'CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)', digits)} "
            f"ELSE 0 END")


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def mean(value: str) -> str:
    return f"CAST(SUM({value}) AS DOUBLE) / COUNT({value})"


def cnt(predicate: str) -> str:
    return f"COUNT(*) FILTER (WHERE {predicate})"


def bucket(key: str, salt: str, buckets: int = 1000) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8)) AS BIGINT) "
            f"% {buckets})")


def values(rows: list[tuple], schema: str) -> str:
    columns = [part.split() for part in schema.split(", ")]
    types = {"string": "VARCHAR", "bigint": "BIGINT"}
    text = ", ".join(
        "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows
    )
    casts = ", ".join(f"CAST({n} AS {types.get(t, t.upper())}) AS {n}" for n, t in columns)
    names = ", ".join(n for n, _ in columns)
    return f"SELECT {casts} FROM (VALUES {text}) AS v({names})"


def tier(column: int) -> str:
    t = [row[column] for row in seeds.LOYALTY_TIERS]
    return (f"CASE WHEN CAST(c_acctbal AS DECIMAL(18,2)) < 300 THEN '{t[0]}' "
            f"WHEN CAST(c_acctbal AS DECIMAL(18,2)) < 1000 THEN '{t[1]}' "
            f"WHEN CAST(c_acctbal AS DECIMAL(18,2)) < 2500 THEN '{t[2]}' ELSE '{t[3]}' END")


def z(name: str) -> str:
    return f"COALESCE({name}, 0)"


def capped(value: str) -> str:
    return f"CAST(LEAST(100, {rnd(value, 1)}) AS DECIMAL(22,1))"


TOKENS = r"[x for x in regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+') if x <> '']"


def tokens(text: str) -> str:
    return TOKENS.format(text)


# Labels of the 25 pairs, rows r = 1…5, columns f = 1…5: the rule written out as a table.
RFM_GRID = [
    "Dormant", "New", "Needs Attention", "At Risk", "At Risk",
    "New", "New", "Needs Attention", "Needs Attention", "Needs Attention",
    "Potential", "Potential", "Loyal", "Loyal", "Loyal",
    "Recent", "Recent", "Loyal", "Champion", "Champion",
    "Recent", "Recent", "Loyal", "Champion", "Champion",
]
RFM = "([" + ", ".join(f"'{label}'" for label in RFM_GRID) + "])[CAST((r_score - 1) * 5 + f_score AS INTEGER)]"


def churn(days: str) -> str:
    return f"(['Low', 'Medium', 'High'])[1 + COALESCE(CAST({days} > 90 AS INTEGER) + CAST({days} > 180 AS INTEGER), 2)]"


def counts(kinds: dict[str, str]) -> str:
    return ", ".join(f"{cnt(f"event_type = '{kind}'")} AS {name}" for name, kind in kinds.items())


BOUGHT = {
    "purchase_count_12m": "purchase", "return_count_12m": "return",
    "cart_add_count_12m": "add_to_cart", "wishlist_count_12m": "wishlist_add",
}
ENGAGED = {
    "page_views_12m": "page_view", "search_count_12m": "search", "training_logs_12m": "training_log",
    "goals_set_12m": "goal_set", "reviews_written_12m": "gear_review", "size_exchanges_12m": "size_exchange",
}
MAILED = {
    "email_opens_12m": "open", "email_clicks_12m": "click", "campaign_conversions_12m": "convert",
    "emails_received_12m": "send", "unsubscribes_12m": "unsubscribe",
}
DELIVERED = {
    "sends": "send", "opens": "open", "clicks": "click", "conversions": "convert",
    "bounces": "bounce", "unsubscribes": "unsubscribe",
}
SHOWN_AS_ZERO = [*BOUGHT, "total_spend_12m", "avg_order_value", *ENGAGED, "total_events_12m",
                 "active_days_12m", *MAILED, "campaign_revenue_12m"]
SCORE_WEIGHTS = {  # score → {column: weight}
    "engagement": {"active_days_12m": "0.4", "training_logs_12m": "2.0", "goals_set_12m": "5.0",
                   "reviews_written_12m": "3.0", "purchase_count_12m": "1.5"},
    "health": {"r_score": "8.0", "f_score": "8.0", "m_score": "8.0", "active_days_12m": "0.3",
               "training_logs_12m": "1.0"},
}


def weighted(score: str) -> str:
    return " + ".join(f"{weight} * {z(column)}" for column, weight in SCORE_WEIGHTS[score].items())


# name → (names it needs, text)
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "tiers": ((), values(seeds.LOYALTY_TIERS, seeds.LOYALTY_TIERS_SCHEMA)),
    "categories": ((), """
SELECT 'CAT-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 3, '0') AS category_id, min(p_type) AS department,
  min(p_name) AS category_name FROM part GROUP BY 1"""),
    "library": ((), f"""
SELECT {cycle(seeds.CAMPAIGN_IDS, 's_suppkey')} AS campaign_id, s_name AS campaign_name, p_type AS campaign_type,
  (CAST(round(abs(s_acctbal) * 100) AS BIGINT) % 1500) / 10000.0 AS conversion_rate
FROM supplier JOIN part ON p_partkey = s_suppkey WHERE s_suppkey BETWEEN 0 AND {len(seeds.CAMPAIGN_IDS) - 1}"""),
    "personas": ((), """
SELECT c_mktsegment AS persona_name, unnest(list_distinct(list(CAST(c_nationkey AS BIGINT)))) AS segment_id
FROM customer WHERE c_nationkey % 5 = length(c_mktsegment) % 5 GROUP BY c_mktsegment"""),
    "templates": ((), values(seeds.TEMPLATES, seeds.TEMPLATES_SCHEMA)),
    "customers": ((), f"""
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name, lower(c_name) || '@example.com' AS email,
  '+00 ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ' ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
  {TODAY} - 7300 - CAST(floor(abs(c_acctbal)) AS INTEGER) AS date_of_birth,
  {cycle(seeds.GENDERS, 'length(c_mktsegment)')} AS gender,
  n_name AS city, right(n_name, 2) AS state,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS zip_code,
  r_name AS region, {tier(0)} AS loyalty_tier_id, {tier(1)} AS loyalty_tier_name,
  CAST(c_acctbal AS DECIMAL(18,2)) AS annual_spend,
  CAST(floor(GREATEST(c_acctbal, 0)) AS BIGINT) AS loyalty_points,
  {cycle(seeds.PREFERRED_CHANNELS, 'c_nationkey')} AS preferred_channel,
  c_mktsegment AS top_category,
  c_acctbal >= 0 AS marketing_opt_in, length(c_mktsegment) > 8 AS push_opt_in, c_nationkey < 13 AS sms_opt_in,
  'STR-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') AS nearest_store_id,
  {TODAY} - CAST(floor(c_acctbal + 1001) AS INTEGER) AS signup_date,
  {TODAY} - CAST(c_nationkey AS INTEGER) AS last_login_date
FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey"""),
    "ev": ((), f"""
SELECT 'EVT-' || CAST(o_orderkey AS VARCHAR) AS event_id, o_custkey AS customer_id,
  {cycle(seeds.EVENT_TYPES, 'o_orderkey')} AS event_type, o_orderdate AS event_timestamp,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders"""),
    "ev12": (("ev",), f"""
SELECT * FROM ev WHERE event_timestamp >= {AS_OF} - INTERVAL 1 YEAR"""),
    "ce": ((), f"""
SELECT 'CEV-' || CAST(o_orderkey AS VARCHAR) AS event_id,
  {cycle(seeds.CAMPAIGN_IDS, 'o_custkey')} AS campaign_id, o_custkey AS customer_id,
  {cycle(seeds.CAMPAIGN_EVENT_TYPES, 'o_orderkey')} AS event_type,
  o_orderdate AS event_timestamp, {cycle(seeds.CAMPAIGN_CHANNELS, 'o_orderkey')} AS channel,
  {cycle(seeds.DEVICES, 'o_orderkey')} AS device_type,
  CASE WHEN {cycle(seeds.CAMPAIGN_EVENT_TYPES, 'o_orderkey')} = 'convert'
       THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS revenue
FROM orders"""),
    "paid": ((), f"""
SELECT {cycle(seeds.CAMPAIGN_IDS, 'l_suppkey')} AS campaign_id, l_returnflag AS platform,
  l_shipdate AS date, CAST(l_quantity AS BIGINT) * 100 AS impressions,
  CAST(l_quantity AS BIGINT) AS clicks,
  CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS spend,
  CAST(l_linenumber AS BIGINT) AS conversions, CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue,
  CAST(l_tax * 100 AS DECIMAL(18,4)) AS roas, CAST(l_discount * 50 AS DECIMAL(18,4)) AS cac
FROM lineitem"""),
    "spent": (("ev12",), """
SELECT customer_id, SUM(amount) AS spend, COUNT(*) AS n, MIN(event_timestamp) AS first_purchase_date,
  MAX(event_timestamp) AS last_purchase_date
FROM ev12 WHERE event_type = 'purchase' GROUP BY customer_id"""),
    "pm": (("ev12", "spent"), f"""
SELECT k.*, COALESCE(spend, 0) AS total_spend_12m, CAST(spend AS DOUBLE) / n AS avg_order_value,
  last_purchase_date, first_purchase_date
FROM (SELECT customer_id, {counts(BOUGHT)} FROM ev12 GROUP BY customer_id) k LEFT JOIN spent USING (customer_id)"""),
    "em": (("ev12",), f"""
SELECT customer_id, {counts(ENGAGED)}, COUNT(*) AS total_events_12m,
  COUNT(DISTINCT CAST(event_timestamp AS DATE)) AS active_days_12m, MAX(event_timestamp) AS last_activity_date
FROM ev12 GROUP BY customer_id"""),
    "cm": (("ce",), f"""
SELECT customer_id, {counts(MAILED)}, COALESCE(SUM(revenue), 0) AS campaign_revenue_12m
FROM ce WHERE event_timestamp >= {AS_OF} - INTERVAL 1 YEAR GROUP BY customer_id"""),
    "rfm_base": (("customers", "pm"), f"""
SELECT c.customer_id,
  date_diff('day', COALESCE(pm.last_purchase_date, CAST({TODAY} - 548 AS TIMESTAMP)), {AS_OF})
    AS days_since_purchase,
  COALESCE(pm.purchase_count_12m, 0) AS frequency,
  CAST(COALESCE(pm.total_spend_12m, 0) AS DECIMAL(18,2)) AS monetary
FROM customers c LEFT JOIN pm ON pm.customer_id = c.customer_id"""),
    "rfm": (("rfm_base",), """
SELECT customer_id, days_since_purchase, frequency, monetary,
  NTILE(5) OVER (ORDER BY days_since_purchase DESC, customer_id) AS r_score,
  NTILE(5) OVER (ORDER BY frequency, customer_id) AS f_score,
  NTILE(5) OVER (ORDER BY monetary, customer_id) AS m_score
FROM rfm_base"""),
    "wide": (("customers", "tiers", "pm", "em", "cm", "rfm"), f"""
SELECT *, date_diff('day', last_purchase_date, {AS_OF}) AS days_since_last_purchase
FROM customers LEFT JOIN (SELECT tier_id AS loyalty_tier_id, points_multiplier, discount_pct FROM tiers) USING (loyalty_tier_id)
LEFT JOIN pm USING (customer_id) LEFT JOIN em USING (customer_id) LEFT JOIN cm USING (customer_id)
LEFT JOIN rfm USING (customer_id)"""),
    "c360": (("wide",), f"""
SELECT * REPLACE ({', '.join(f'{z(c)} AS {c}' for c in SHOWN_AS_ZERO)}),
  year({TODAY}) - year(date_of_birth) AS age, date_diff('day', signup_date, {TODAY}) AS tenure_days,
  discount_pct AS tier_discount_pct,
  {ratio('email_opens_12m', 'emails_received_12m')} AS email_open_rate,
  {ratio('email_clicks_12m', 'email_opens_12m')} AS email_click_rate,
  {ratio('campaign_conversions_12m', 'emails_received_12m')} AS campaign_conversion_rate,
  {ratio('return_count_12m', 'purchase_count_12m')} AS return_rate,
  {rnd('CAST(r_score + f_score + m_score AS DOUBLE) / 3.0', 2)} AS rfm_composite_score,
  {RFM} AS rfm_segment, {churn('days_since_last_purchase')} AS churn_risk_tier,
  {capped(weighted('engagement'))} AS engagement_score, {capped(weighted('health'))} AS customer_health_score,
  {capped(f"0.15 * COALESCE(days_since_last_purchase, 365) + 2.0 * {z('return_count_12m')} + CASE WHEN {z('active_days_12m')} < 30 THEN 0.5 * (30 - {z('active_days_12m')}) ELSE 0 END")}
    AS churn_risk_score,
  {rnd('CASE WHEN total_events_12m IS NULL THEN annual_spend * 0.5 ELSE total_spend_12m END', 2)} AS ltv_annualized,
  CASE WHEN total_events_12m IS NOT NULL THEN
    {rnd('(CASE WHEN purchase_count_12m > 0 THEN avg_order_value ELSE CAST(annual_spend AS DOUBLE) END) * (CAST(points_multiplier AS DOUBLE) * 2.5)', 2)}
  END AS revenue_opportunity_score
FROM wide"""),
    "min_size": ((), "SELECT 3 AS n"),
    "seg_base": (("c360", "min_size"), f"""
SELECT rfm_segment, churn_risk_tier, preferred_channel, COUNT(*) AS customer_count,
  {rnd(mean('annual_spend'), 2)} AS avg_spend,
  {rnd(mean('engagement_score'), 2)} AS avg_engagement_score,
  {rnd(mean('campaign_conversion_rate'), 4)} AS avg_campaign_conversion_rate,
  {rnd(mean('ltv_annualized'), 2)} AS avg_ltv_annualized,
  SUM(revenue_opportunity_score) AS total_revenue_opportunity
FROM c360 GROUP BY rfm_segment, churn_risk_tier, preferred_channel
HAVING COUNT(*) >= (SELECT n FROM min_size)"""),
    "seg_weight": (("seg_base",), """
SELECT *, 0.25 * avg_ltv_annualized + 0.35 * avg_engagement_score + 0.4 * total_revenue_opportunity AS w FROM seg_base"""),
    "seg_ranked": (("seg_weight",), f"""
SELECT ROW_NUMBER() OVER (ORDER BY total_revenue_opportunity DESC NULLS FIRST,
    avg_engagement_score DESC NULLS FIRST, rfm_segment, churn_risk_tier, preferred_channel) AS segment_id,
  concat(rfm_segment, ' / ', churn_risk_tier, ' Churn / ', upper(preferred_channel)) AS segment_name,
  a.* EXCLUDE (w),
  CASE WHEN (SELECT COUNT(*) FROM seg_weight) > 1 THEN
    {rnd("""60.5 + CAST((SELECT COUNT(*) FROM seg_weight b WHERE b.w < a.w OR (a.w IS NULL AND b.w IS NOT NULL)) AS DOUBLE)
      / ((SELECT COUNT(*) FROM seg_weight) - 1) * 22.4""", 1)} END AS intent_score
FROM seg_weight a"""),
    "segments": (("seg_ranked",), """
SELECT * FROM seg_ranked ORDER BY intent_score DESC NULLS FIRST, segment_id LIMIT 22"""),
    "owned": (("ce", "library"), f"""
SELECT w.*, campaign_name, campaign_type FROM (
  SELECT campaign_id, channel, CAST(date_trunc('week', event_timestamp) AS DATE) AS period, {counts(DELIVERED)},
    COALESCE(SUM(revenue), 0) AS owned_revenue FROM ce GROUP BY ALL) w
LEFT JOIN library USING (campaign_id)"""),
    "paidw": (("paid",), f"""
SELECT campaign_id, platform, CAST(date_trunc('week', date) AS DATE) AS period,
  CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS paid_clicks,
  SUM(spend) AS spend, CAST(SUM(conversions) AS BIGINT) AS paid_conversions,
  SUM(revenue) AS paid_revenue, {mean('roas')} AS avg_roas, {mean('cac')} AS avg_cac
FROM paid GROUP BY campaign_id, platform, CAST(date_trunc('week', date) AS DATE)"""),
    "briefs_in": ((), f"""
SELECT {cycle(seeds.CAMPAIGN_IDS, 'conv_id')} AS campaign_id,
  CASE WHEN turn % 2 = 0 THEN 'BRF-' || CAST(conv_id AS VARCHAR) END AS given_id,
  CASE WHEN turn % 3 = 0 THEN 'approved' END AS status, role AS created_by, text AS objective,
  CASE WHEN turn > 1 THEN 'friendly' END AS tone, conv_id * 1000 + turn AS sequence, conv_id, turn
FROM conversations"""),
    "assets_in": ((), f"""
SELECT 'BRF-' || CAST(conv_id AS VARCHAR) AS brief_id,
  CASE WHEN turn % 4 = 0 THEN 'AST-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END AS given_id,
  {cycle(seeds.CAMPAIGN_IDS, 'conv_id')} AS campaign_id,
  {cycle([t[1] for t in seeds.TEMPLATES] + ['print'], 'conv_id * 3 + turn')} AS channel,
  {cycle([t[2] for t in seeds.TEMPLATES] + ['flyer'], 'conv_id * 3 + turn')} AS asset_type,
  text AS content_body, text AS headline,
  CASE WHEN turn % 5 = 0 THEN 'in_review' END AS approval_status,
  CAST(((conv_id * 3 + turn) % 40) / 4.0 AS DOUBLE) AS score, conv_id, turn
FROM conversations"""),
}


def with_(*names: str) -> str:
    """``WITH`` clause of the named blocks and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in BLOCKS[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n][1]}\n)" for n in order) + "\n"


def sel(columns: str, source: str) -> str:
    """Select list from names with a mark: ``:d`` is cast to double, ``:i`` to bigint."""
    out = []
    for item in columns.split():
        name, _, mark = item.partition(":")
        kind = {"d": "DOUBLE", "i": "BIGINT"}.get(mark)
        out.append(f"CAST({name} AS {kind}) AS {name}" if kind else name)
    return f"SELECT {', '.join(out)} FROM {source}"
