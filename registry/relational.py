"""Registered operators: sources and sinks, filters, joins, aggregates, windows, functions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from registry.base import Data, query
from registry.sql import AS_OF as SQL_AS_OF
from registry.sql import cnt, cycle, ratio, rnd, with_
from segmentry.functions import exprs as X
from segmentry.operators import dml, rank
from segmentry.operators.topk import top
from segmentry.plans import performance, profile, refresh, segments
from segmentry.sources import bindings, seeds
from segmentry.sources.bindings import AS_OF
from segmentry.sources.schemas import AUDIENCES
from segmentry.sources.storage import Tables



def n() -> Column:
    return F.count(F.lit(1))


# ---- sources ----------------------------------------------------------------

@query("src_values", with_("tiers", "customers") + """SELECT tier_id, tier_name,
  CAST(points_multiplier AS DOUBLE) AS points_multiplier, COUNT(customer_id) AS customers,
  CAST(MIN(annual_spend) AS DOUBLE) AS lowest_spend
FROM tiers LEFT JOIN customers ON loyalty_tier_id = tier_id GROUP BY tier_id, tier_name, points_multiplier""")
def src_values(d: Data):
    held = d.customers.groupBy(F.col("loyalty_tier_id").alias("tier_id")).agg(
        n().alias("customers"), F.min("annual_spend").alias("lowest_spend")
    )
    return seeds.loyalty_tiers(d.spark).join(held, "tier_id", "left").select(
        "tier_id", "tier_name", "points_multiplier",
        F.coalesce("customers", F.lit(0)).alias("customers"), "lowest_spend",
    )


@query("src_range", """WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders)
, days AS (SELECT lo + CAST(i AS INTEGER) AS day FROM b, range(0, (SELECT date_diff('day', lo, hi) + 1 FROM b)) r(i))
SELECT day, COUNT(o_orderkey) AS orders FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day""")
def src_range(d: Data):
    """A gap-free sequence of days with the orders of each, 0 where there is none."""
    orders = d.table("orders").select(F.to_date("o_orderdate").alias("day"))
    ends = orders.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    days = d.spark.range((ends["hi"] - ends["lo"]).days + 1).select(
        F.date_add(F.lit(ends["lo"]), F.col("id").cast("int")).alias("day")
    )
    per_day = orders.groupBy("day").agg(n().alias("orders"))
    return days.join(per_day, "day", "left").select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("flatten_pos", """SELECT i - 1 AS pos, v AS value, COUNT(*) AS parts
FROM (SELECT unnest(string_split(p_name, ' ')) AS v, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)
GROUP BY i, v""")
def flatten_pos(d: Data):
    """A JSON array in text to one row per element with its position."""
    text = F.concat(F.lit('["'), F.replace(F.col("p_name"), F.lit(" "), F.lit('","')), F.lit('"]'))
    stored = d.table("part").select(text.alias("words"))
    rows = stored.select(F.posexplode(F.from_json("words", "array<string>")).alias("pos", "value"))
    return rows.groupBy("pos", "value").agg(n().alias("parts"))


@query("flatten_struct", """SELECT name, COUNT(*) AS entries, CAST(SUM(size) AS BIGINT) AS total_size
FROM (SELECT p_brand AS name, p_size AS size FROM part UNION ALL SELECT p_type, p_size + 1 FROM part) GROUP BY name""")
def flatten_struct(d: Data):
    """A JSON array of objects to typed columns."""
    entry = '{"name":"%s","size":%d}'
    stored = d.table("part").select(
        F.format_string(f"[{entry},{entry}]", "p_brand", "p_size", "p_type", F.col("p_size") + 1).alias("j")
    )
    rows = stored.select(F.inline(F.from_json("j", "array<struct<name:string,size:int>>")))
    return rows.groupBy("name").agg(n().alias("entries"), F.sum("size").alias("total_size"))


STORE_TYPES = ["corner", "arcade", "depot", "kiosk"]


@query("flatten_cross", f"""SELECT word, store_type, COUNT(*) AS stores
FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part), (SELECT unnest({STORE_TYPES}) AS store_type)
GROUP BY word, store_type ORDER BY word, store_type LIMIT 500""")
def flatten_cross(d: Data):
    """Two arrays of one row unfolded against each other, first 500 in order.

    Each side is grouped as soon as it is unfolded.
    """
    words = d.table("part").select(F.explode(F.split("p_name", " ")).alias("word"))
    counted = words.groupBy("word").agg(n().alias("stores"))
    types = F.array(*[F.lit(t) for t in STORE_TYPES])
    rows = counted.select("word", F.explode(types).alias("store_type"), "stores")
    return top(rows, [F.col("word"), F.col("store_type")], 500)


# ---- sinks and changes ------------------------------------------------------

TIER_SPEND = """SELECT loyalty_tier_id, COUNT(*) AS customers, CAST(SUM(annual_spend) AS DOUBLE) AS spend
FROM customers GROUP BY loyalty_tier_id"""


@query("sink_overwrite", with_("customers") + TIER_SPEND)
def sink_overwrite(d: Data):
    """Write a table, rewrite it from itself, read it back."""
    tables = Tables(d.spark)
    tables.overwrite("spend", d.customers.select("customer_id", "loyalty_tier_id", "annual_spend"))
    again = tables.overwrite("spend", tables.read("spend"))
    return again.groupBy("loyalty_tier_id").agg(n().alias("customers"), F.sum("annual_spend").alias("spend"))


@query("union_all", with_("ev", "ce") + """SELECT source, event_type, COUNT(*) AS events FROM (
SELECT 'activity' AS source, event_type FROM ev UNION ALL SELECT 'campaign', event_type FROM ce) GROUP BY source, event_type""")
def union_all(d: Data):
    """Several inserts that build one table."""
    tables = Tables(d.spark)
    first = d.events.select(F.lit("activity").alias("source"), "event_type")
    tables.overwrite("all_events", first)
    second = d.campaign_events.select(F.lit("campaign").alias("source"), "event_type")
    both = tables.append("all_events", second)
    return both.groupBy("source", "event_type").agg(n().alias("events"))


@query("insert_partial", with_("customers") + """SELECT customer_id, CAST(7 AS BIGINT) AS segment_id, 'Opted in' AS segment_name,
  'News' AS campaign_name, 'pending' AS status, CAST(NULL AS BIGINT) AS priority_rank, CAST(NULL AS VARCHAR) AS email
FROM customers WHERE marketing_opt_in""")
def insert_partial(d: Data):
    """Insert with a column list: the rest takes its default or NULL."""
    rows = d.customers.filter("marketing_opt_in").select(
        "customer_id", F.lit(7).alias("segment_id"), F.lit("Opted in").alias("segment_name"),
        F.lit("News").alias("campaign_name"),
    )
    empty = d.spark.createDataFrame([], AUDIENCES.ddl())
    return empty.unionByName(AUDIENCES.fill(rows)).select(
        "customer_id", "segment_id", "segment_name", "campaign_name", "status", "priority_rank", "email"
    )


@query("merge_upsert", """WITH t AS (SELECT c_custkey AS customer_id, CAST(c_acctbal AS DECIMAL(18,2)) AS spend,
  c_mktsegment AS status, 'kept' AS origin FROM customer)
, s AS (SELECT customer_id, spend, status FROM (SELECT o_custkey * 2 AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS spend,
    CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS status,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
SELECT COALESCE(t.customer_id, s.customer_id) AS customer_id,
  CAST(CASE WHEN s.customer_id IS NOT NULL THEN s.spend ELSE t.spend END AS DOUBLE) AS spend,
  CASE WHEN s.customer_id IS NOT NULL THEN s.status ELSE t.status END AS status, t.origin AS origin
FROM t FULL OUTER JOIN s ON s.customer_id = t.customer_id""")
def merge_upsert(d: Data):
    """Update matched keys (also to NULL), insert the others, keep what is not updated."""
    target = d.table("customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").cast(X.MONEY).alias("spend"),
        F.col("c_mktsegment").alias("status"), F.lit("kept").alias("origin"),
    )
    changes = d.table("orders").select(
        (F.col("o_custkey") * 2).alias("customer_id"), F.col("o_totalprice").cast(X.MONEY).alias("spend"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("status"), "o_orderkey",
    )
    source = dml.latest(changes, ["customer_id"], F.col("o_orderkey")).drop("o_orderkey")
    return dml.upsert(target, source, ["customer_id"], ["spend", "status"])


@query("delete_where", with_("ev") + """SELECT event_type, COUNT(*) AS events FROM ev
WHERE NOT COALESCE(event_id LIKE 'EVT-1%' AND event_type = 'purchase'
  AND CAST(replace(event_id, 'EVT-', '') AS BIGINT) % 10 = NULLIF(customer_id % 10, 9), FALSE) GROUP BY event_type""")
def delete_where(d: Data):
    """Delete by a predicate that is NULL for some rows; those stay."""
    digit = F.replace(F.col("event_id"), F.lit("EVT-"), F.lit("")).cast("bigint") % 10
    gone = (
        F.col("event_id").startswith("EVT-1") & (F.col("event_type") == "purchase")
        & (digit == F.nullif(F.col("customer_id") % 10, F.lit(9)))
    )
    return dml.delete_where(d.events, gone).groupBy("event_type").agg(n().alias("events"))


@query("truncate", """SELECT 'campaign_events' AS table_name, COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM orders""")
def truncate(d: Data):
    tables = Tables(d.spark)
    full = tables.overwrite("campaign_events", d.campaign_events)
    empty = tables.truncate("campaign_events")
    counted = full.agg(n().alias("rows_before")).withColumn("table_name", F.lit("campaign_events"))
    left = empty.agg(n().alias("rows_after")).withColumn("table_name", F.lit("campaign_events"))
    return counted.join(left, "table_name").select("table_name", "rows_before", "rows_after")


@query("audit_counts", """SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'activity', COUNT(*) FROM orders UNION ALL SELECT 'paid_media', COUNT(*) FROM lineitem
UNION ALL SELECT 'campaign_events (seeded)', COUNT(*) FROM orders WHERE ('CEV-' || CAST(o_orderkey AS VARCHAR)) LIKE 'S%'""")
def audit_counts(d: Data):
    return refresh.row_counts({
        "customers": d.table("customer"), "activity": d.events, "paid_media": d.paid_media,
        "campaign_events (seeded)": d.campaign_events.filter(F.col("event_id").startswith("S")),
    })


# ---- filters and projections ------------------------------------------------

@query("filter_window_12m", with_("ev12") + """SELECT event_type, COUNT(*) AS events, MIN(event_timestamp) AS first_event,
  MAX(event_timestamp) AS last_event FROM ev12 GROUP BY event_type""")
def filter_window_12m(d: Data):
    return profile.last_year(d.events, AS_OF).groupBy("event_type").agg(
        n().alias("events"), F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )


@query("filter_conj", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 100000""")
def filter_conj(d: Data):
    return d.table("orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_totalprice") > 100000)
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_like", "SELECT p_type, COUNT(*) AS parts FROM part WHERE p_brand LIKE 'Brand#1%' AND p_name LIKE '%ring' GROUP BY p_type")
def filter_like(d: Data):
    kept = d.table("part").filter(F.col("p_brand").startswith("Brand#1") & F.col("p_name").like("%ring"))
    return kept.groupBy("p_type").agg(n().alias("parts"))


@query("case_simple", """SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
  CASE o_custkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'push' ELSE 'sms' END AS channel, COUNT(*) AS orders
FROM orders GROUP BY 1, 2""")
def case_simple(d: Data):
    status, slot = F.col("o_orderstatus"), F.col("o_custkey") % 3
    return d.table("orders").groupBy(
        F.when(status == "F", "filled").when(status == "O", "open").otherwise("other").alias("state"),
        F.when(slot == 0, "email").when(slot == 1, "push").otherwise("sms").alias("channel"),
    ).agg(n().alias("orders"))


@query("bool_flags", with_("customers") + """SELECT marketing_opt_in, push_opt_in, sms_opt_in, COUNT(*) AS customers,
  COUNT(*) FILTER (WHERE marketing_opt_in AND NOT sms_opt_in) AS no_sms FROM customers GROUP BY 1, 2, 3""")
def bool_flags(d: Data):
    flags = ["marketing_opt_in", "push_opt_in", "sms_opt_in"]
    return d.customers.groupBy(*flags).agg(
        n().alias("customers"),
        F.count_if(F.col("marketing_opt_in") & ~F.col("sms_opt_in")).alias("no_sms"),
    )


@query("casts", """SELECT c_custkey AS customer_id, CAST(CAST(c_acctbal AS DECIMAL(12,1)) AS DOUBLE) AS tenths,
  CAST(c_custkey AS VARCHAR) AS as_text, CAST(c_custkey % 2 AS BOOLEAN) AS as_flag,
  TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, TRY_CAST(c_mktsegment AS BIGINT) AS no_number,
  CAST('2001-0' || CAST(c_custkey % 9 + 1 AS VARCHAR) || '-15' AS DATE) AS as_date,
  CAST('2001-0' || CAST(c_custkey % 9 + 1 AS VARCHAR) || '-15 10:20:30' AS TIMESTAMP) AS as_moment FROM customer""")
def casts(d: Data):
    key = F.col("c_custkey")
    month = F.concat(F.lit("2001-0"), (key % 9 + 1).cast("string"), F.lit("-15"))
    return d.table("customer").select(
        key.alias("customer_id"), F.col("c_acctbal").cast("decimal(12,1)").alias("tenths"),
        key.cast("string").alias("as_text"), (key % 2).cast("boolean").alias("as_flag"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).try_cast("bigint").alias("number"),
        F.col("c_mktsegment").try_cast("bigint").alias("no_number"), month.cast("date").alias("as_date"),
        F.concat(month, F.lit(" 10:20:30")).cast("timestamp_ntz").alias("as_moment"),
    )


# ---- joins ------------------------------------------------------------------

@query("join_inner", """SELECT c_mktsegment, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def join_inner(d: Data):
    """Orders are summed per customer before they meet the customers."""
    per_customer = d.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        n().alias("orders"), F.sum(F.col("o_totalprice").cast(X.MONEY)).alias("amount")
    )
    joined = d.table("customer").select("c_custkey", "c_mktsegment").join(per_customer, "c_custkey")
    return joined.groupBy("c_mktsegment").agg(F.sum("orders").alias("orders"), F.sum("amount").alias("amount"))


def lookup(d: Data, values: list[str], name: str):
    """An inline list as a table of position and value."""
    return seeds.inline(d.spark, list(enumerate(values)), f"idx bigint, {name} string")


@query("join_modulo_lookup", f"""SELECT event_type, device, COUNT(*) AS events FROM (
SELECT {cycle(seeds.EVENT_TYPES, 'o_orderkey')} AS event_type, {cycle(seeds.DEVICES, 'o_orderkey')} AS device FROM orders)
GROUP BY event_type, device""")
def join_modulo_lookup(d: Data):
    """Join on a computed key: the position in a list is the row's number modulo its length."""
    rows = d.table("orders").select(
        (F.col("o_orderkey") % len(seeds.EVENT_TYPES)).alias("e"),
        (F.col("o_orderkey") % len(seeds.DEVICES)).alias("v"),
    )
    kinds, devices = lookup(d, seeds.EVENT_TYPES, "event_type"), lookup(d, seeds.DEVICES, "device")
    joined = rows.join(kinds.withColumnRenamed("idx", "e"), "e").join(
        devices.withColumnRenamed("idx", "v"), "v"
    )
    return joined.groupBy("event_type", "device").agg(n().alias("events"))


@query("join_string_key", with_("categories") + """SELECT category_name, COUNT(*) AS parts,
  CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM part JOIN categories ON category_id = 'CAT-0' || lpad(CAST(p_partkey % 10 + 1 AS VARCHAR), 2, '0') GROUP BY category_name""")
def join_string_key(d: Data):
    """Join on a key built as text; only the first ten categories have one."""
    built = F.concat(F.lit("CAT-0"), X.padded(F.col("p_partkey") % 10 + 1, 2))
    parts = d.table("part").select(built.alias("category_id"), F.col("p_retailprice").cast(X.MONEY).alias("price"))
    named = parts.join(d.categories, "category_id")
    return named.groupBy("category_name").agg(n().alias("parts"), F.sum("price").alias("price"))


@query("join_left_chain", with_("customers", "pm", "em", "cm") + """SELECT c.customer_id, purchase_count_12m, total_events_12m,
  emails_received_12m, last_activity_date FROM customers c LEFT JOIN pm ON pm.customer_id = c.customer_id
LEFT JOIN em ON em.customer_id = c.customer_id LEFT JOIN cm ON cm.customer_id = c.customer_id""")
def join_left_chain(d: Data):
    """Several aggregates joined to the entity on one key: partitioned once."""
    return (
        d.customers.select("customer_id")
        .join(profile.event_metrics(d.events, AS_OF), "customer_id", "left")
        .join(profile.campaign_metrics(d.campaign_events, AS_OF), "customer_id", "left")
        .select("customer_id", "purchase_count_12m", "total_events_12m", "emails_received_12m",
                "last_activity_date")
    )


@query("join_left_dim", with_("customers", "tiers") + """SELECT customer_id, tier_name, CAST(discount_pct AS DOUBLE) AS discount_pct
FROM customers LEFT JOIN tiers ON tier_id = loyalty_tier_id AND discount_pct > 0""")
def join_left_dim(d: Data):
    tiers = seeds.loyalty_tiers(d.spark).filter("discount_pct > 0").select(
        F.col("tier_id").alias("loyalty_tier_id"), "tier_name", "discount_pct"
    )
    return d.customers.select("customer_id", "loyalty_tier_id").join(
        tiers, "loyalty_tier_id", "left"
    ).select("customer_id", "tier_name", "discount_pct")


# ---- aggregates -------------------------------------------------------------

@query("agg_count", "SELECT o_orderstatus, o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY 1, 2")
def agg_count(d: Data):
    return d.table("orders").groupBy("o_orderstatus", "o_orderpriority").agg(n().alias("orders"))


@query("agg_count_if", f"""SELECT user_id, {cnt("event_type = 'view'")} AS views, {cnt("event_type = 'click'")} AS clicks,
  {cnt("event_type = 'error' AND value > 10")} AS big_errors FROM events GROUP BY user_id""")
def agg_count_if(d: Data):
    kind = F.col("event_type")
    return d.table("events").groupBy("user_id").agg(
        F.count_if(kind == "view").alias("views"), F.count_if(kind == "click").alias("clicks"),
        F.count_if((kind == "error") & (F.col("value") > 10)).alias("big_errors"),
    )


@query("agg_cond_sum", """SELECT user_id, CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS spent
FROM events GROUP BY user_id""")
def agg_cond_sum(d: Data):
    amount = F.col("value").cast("decimal(18,4)")
    spent = F.sum(F.when(F.col("event_type") == "purchase", amount).otherwise(F.lit(0)))
    return d.table("events").groupBy("user_id").agg(spent.alias("spent"))


@query("agg_cond_avg", """SELECT user_id, CAST(SUM(CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE)
  / NULLIF(COUNT(*) FILTER (WHERE event_type = 'signup'), 0) AS mean_signup FROM events GROUP BY user_id""")
def agg_cond_avg(d: Data):
    """No match in a group gives NULL, not 0."""
    matching = F.when(F.col("event_type") == "signup", F.col("value").cast("decimal(18,4)"))
    return d.table("events").groupBy("user_id").agg(X.mean(matching).alias("mean_signup"))


@query("agg_cond_minmax", """SELECT user_id, MIN(CASE WHEN event_type = 'purchase' THEN ts END) AS first_purchase,
  MAX(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase, MAX(ts) AS last_seen FROM events GROUP BY user_id""")
def agg_cond_minmax(d: Data):
    bought = F.when(F.col("event_type") == "purchase", F.col("ts"))
    return d.table("events").groupBy("user_id").agg(
        F.min(bought).alias("first_purchase"), F.max(bought).alias("last_purchase"),
        F.max("ts").alias("last_seen"),
    )


@query("agg_distinct_days", "SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days, COUNT(*) AS events FROM events GROUP BY user_id")
def agg_distinct_days(d: Data):
    return d.table("events").groupBy("user_id").agg(
        F.count_distinct(F.to_date("ts")).alias("active_days"), n().alias("events")
    )


@query("agg_having", """SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 15""")
def agg_having(d: Data):
    return d.table("orders").groupBy("o_custkey").agg(n().alias("orders")).filter(F.col("orders") >= 15)


@query("agg_weekly", """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, COUNT(*) AS lines,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1""")
def agg_weekly(d: Data):
    week = performance.week_of(F.col("l_shipdate"))
    return d.table("lineitem").groupBy(week.alias("week")).agg(
        n().alias("lines"), F.sum(F.col("l_extendedprice").cast(X.MONEY)).alias("revenue")
    )


# ---- windows ----------------------------------------------------------------

@query("win_ntile", """SELECT o_orderkey, NTILE(5) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_tile,
  NTILE(7) OVER (ORDER BY o_orderdate, o_orderkey) AS date_tile FROM orders""")
def win_ntile(d: Data):
    orders = d.table("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    priced = rank.tiles(orders, {"price_tile": [rank.descending(F.col("o_totalprice")), key]}, 5)
    return rank.tiles(priced, {"date_tile": [F.col("o_orderdate"), key]}, 7).select(
        "o_orderkey", "price_tile", "date_tile"
    )


@query("win_row_number", """SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS position FROM orders""")
def win_row_number(d: Data):
    """Five priorities share all orders; the unique last key still splits them evenly."""
    keys = [F.col("o_orderpriority"), rank.descending(F.col("o_totalprice")), F.col("o_orderkey")]
    orders = d.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank.row_numbers(orders, "position", keys).select("o_orderkey", "position")


@query("surrogate_key", """SELECT 'STR-' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY p_name, p_partkey) AS VARCHAR), 9, '0') AS store_id,
  p_partkey FROM part""")
def surrogate_key(d: Data):
    parts = d.table("part").select("p_partkey", "p_name")
    numbered = dml.with_new_ids(parts, "id", [F.col("p_name"), F.col("p_partkey")])
    return numbered.select(F.concat(F.lit("STR-"), X.padded(F.col("id"), 9)).alias("store_id"), "p_partkey")


@query("win_rank_expr", with_("seg_weight") + """SELECT rfm_segment, churn_risk_tier, preferred_channel,
  1 + (SELECT COUNT(*) FROM seg_weight b WHERE b.w < a.w OR (a.w IS NULL AND b.w IS NOT NULL)) AS intent_rank FROM seg_weight a""")
def win_rank_expr(d: Data):
    base = segments.segment_base(d.profiles, d.min_size)
    ordered = Window.orderBy(segments.intent_weight().asc_nulls_last())
    return base.select(*segments.SEGMENT_KEYS, F.rank().over(ordered).alias("intent_rank"))


@query("win_count_all", """SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, COUNT(*) AS customers, COUNT(*) OVER () AS groups,
  COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER () AS share FROM customer GROUP BY 1, 2""")
def win_count_all(d: Data):
    """Totals beside each group. The window sees grouped rows only."""
    everything = Window.partitionBy()
    grouped = d.table("customer").groupBy("c_mktsegment", "c_nationkey").agg(n().alias("customers"))
    return grouped.select(
        "c_mktsegment", F.col("c_nationkey"), "customers", n().over(everything).alias("groups"),
        (F.col("customers") / F.sum("customers").over(everything)).alias("share"),
    )


@query("win_scaled_rank", f"""WITH g AS (SELECT o_orderpriority, o_orderstatus, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, o_orderstatus, CAST({rnd('60.5 + CAST(RANK() OVER (ORDER BY amount) - 1 AS DOUBLE) / NULLIF(COUNT(*) OVER () - 1, 0) * 22.4', 1)} AS DOUBLE) AS score
FROM g""")
def win_scaled_rank(d: Data):
    amount = F.sum(F.col("o_totalprice").cast(X.MONEY)).alias("amount")
    grouped = d.table("orders").groupBy("o_orderpriority", "o_orderstatus").agg(amount)
    return grouped.select(
        "o_orderpriority", "o_orderstatus",
        segments.scaled_rank(
            F.rank().over(Window.orderBy("amount")), n().over(Window.partitionBy())
        ).alias("score"),
    )


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 22")
def topk(d: Data):
    rows = d.table("orders").select("o_orderkey", "o_totalprice")
    return top(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 22)


# ---- scalar functions -------------------------------------------------------

@query("fn_string", """SELECT p_partkey, p_brand || '/' || NULLIF(p_type, 'ECONOMY') AS joined, lpad(CAST(p_partkey AS VARCHAR), 3, '0') AS padded,
  lower(p_type) AS lowered, upper(p_name) AS raised, trim('  ' || p_name || ' ') AS trimmed,
  replace(p_brand, 'Brand#', 'B-') AS replaced, left(p_name, 4) AS cut FROM part""")
def fn_string(d: Data):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return d.table("part").select(
        "p_partkey", F.concat(brand, F.lit("/"), F.nullif(kind, F.lit("ECONOMY"))).alias("joined"),
        X.padded(F.col("p_partkey"), 3).alias("padded"), F.lower(kind).alias("lowered"),
        F.upper(name).alias("raised"), F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.replace(brand, F.lit("Brand#"), F.lit("B-")).alias("replaced"), F.left(name, F.lit(4)).alias("cut"),
    )


@query("fn_slug", "SELECT p_partkey, left(replace(upper(p_name || ' ' || p_type), ' ', '-'), 15) AS code FROM part")
def fn_slug(d: Data):
    return d.table("part").select(
        "p_partkey", X.slug(F.concat_ws(" ", "p_name", "p_type")).alias("code")
    )


@query("fn_datefmt", "SELECT event_id, strftime(ts, '%H%M%S') AS clock, strftime(ts, '%Y-%m-%d') AS day FROM events")
def fn_datefmt(d: Data):
    return d.table("events").select(
        "event_id", F.date_format("ts", "HHmmss").alias("clock"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


@query("fn_math", f"""SELECT c_custkey, CAST(c_acctbal * 100 AS BIGINT) % 7 AS signed_rest,
  ((CAST(c_acctbal * 100 AS BIGINT) % 7) + 7) % 7 AS positive_rest, abs(c_acctbal) AS size,
  CAST({rnd('c_acctbal / 8', 2)} AS DOUBLE) AS eighth, CAST((c_custkey + 1) * 3 - 2 AS BIGINT) AS line FROM customer""")
def fn_math(d: Data):
    cents = (F.col("c_acctbal") * 100).cast("decimal(18,0)").cast("bigint")
    return d.table("customer").select(
        "c_custkey", (cents % 7).alias("signed_rest"), F.pmod(cents, F.lit(7)).alias("positive_rest"),
        F.abs("c_acctbal").alias("size"), X.round_to(F.col("c_acctbal") / 8, 2).alias("eighth"),
        ((F.col("c_custkey") + 1) * 3 - 2).alias("line"),
    )


@query("fn_clamp", with_("customers", "pm") + """SELECT c.customer_id,
  CASE WHEN purchase_count_12m IS NOT NULL THEN GREATEST(purchase_count_12m, 1) END AS at_least_one,
  CASE WHEN purchase_count_12m IS NOT NULL THEN LEAST(purchase_count_12m, 2) END AS at_most_two,
  CAST(GREATEST(LEAST(annual_spend, 5000), 0) AS DOUBLE) AS bounded
FROM customers c LEFT JOIN pm ON pm.customer_id = c.customer_id""")
def fn_clamp(d: Data):
    """NULL in gives NULL out, unlike the built-in functions."""
    joined = d.customers.select("customer_id", "annual_spend").join(
        profile.event_metrics(d.events, AS_OF, ("purchase",)), "customer_id", "left"
    )
    count = F.col("purchase_count_12m")
    return joined.select(
        "customer_id", X.strict_greatest(count, F.lit(1)).alias("at_least_one"),
        X.strict_least(count, F.lit(2)).alias("at_most_two"),
        X.clamp(F.col("annual_spend"), F.lit(0), F.lit(5000)).alias("bounded"),
    )


@query("fn_safe_ratio", f"""WITH u AS (SELECT user_id, {cnt("event_type = 'view'")} AS views, {cnt("event_type = 'click' AND value > 40")} AS clicks,
  {cnt("event_type = 'error' AND value > 90")} AS errors FROM events GROUP BY user_id)
SELECT user_id, CAST({ratio('clicks', 'views')} AS DOUBLE) AS click_rate, CAST({ratio('views', 'errors')} AS DOUBLE) AS per_error FROM u""")
def fn_safe_ratio(d: Data):
    kind, value = F.col("event_type"), F.col("value")
    users = d.table("events").groupBy("user_id").agg(
        F.count_if(kind == "view").alias("views"),
        F.count_if((kind == "click") & (value > 40)).alias("clicks"),
        F.count_if((kind == "error") & (value > 90)).alias("errors"),
    )
    return users.select(
        "user_id", X.safe_ratio(F.col("clicks"), F.col("views")).alias("click_rate"),
        X.safe_ratio(F.col("views"), F.col("errors")).alias("per_error"),
    )


@query("fn_date", f"""SELECT o_orderkey, o_orderdate + INTERVAL 1 YEAR AS next_year, CAST(o_orderdate AS DATE) - 90 AS before,
  o_orderdate + to_seconds(o_orderkey % 100000) AS later, o_orderdate - to_minutes(o_orderkey % 1380 + 60) AS sooner,
  date_diff('day', o_orderdate, {SQL_AS_OF}) AS age_days, year({SQL_AS_OF}) - year(o_orderdate) AS age_years,
  CAST(date_trunc('day', o_orderdate) AS DATE) AS day, year(o_orderdate) AS year FROM orders""")
def fn_date(d: Data):
    date, key = F.col("o_orderdate"), F.col("o_orderkey")
    return d.table("orders").select(
        "o_orderkey", (date + F.expr("INTERVAL 1 YEAR")).alias("next_year"),
        F.date_sub(date.cast("date"), 90).alias("before"),
        X.seconds_after(date, key % 100000).alias("later"),
        X.minutes_before(date, key % 1380 + 60).alias("sooner"),
        X.days_between(date, X.day(AS_OF)).alias("age_days"),
        X.years_between(date, X.day(AS_OF)).alias("age_years"),
        F.to_date(F.date_trunc("day", date)).alias("day"), F.year(date).alias("year"),
    )


@query("fn_date_shift", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + to_years(CAST(2001 - 1995 AS INTEGER)) AS DATE) AS shifted FROM orders""")
def fn_date_shift(d: Data):
    """Dates of a plan made for 1995, moved to the year of the clock."""
    return d.table("orders").select(
        "o_orderkey", X.shift_year(F.to_date("o_orderdate"), X.day(AS_OF), 1995).alias("shifted")
    )


# ---- JSON, arrays and templates ---------------------------------------------

@query("json_build", """SELECT o_orderkey, '{"amount":' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
  || ',"quantity":' || CAST(o_orderkey % 3 + 1 AS VARCHAR) || '}' AS properties FROM orders""")
def json_build(d: Data):
    body = F.struct(
        F.col("o_totalprice").cast(X.MONEY).alias("amount"), (F.col("o_orderkey") % 3 + 1).alias("quantity")
    )
    return d.table("orders").select("o_orderkey", F.to_json(body).alias("properties"))


@query("json_path", """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k_float FROM events""")
def json_path(d: Data):
    """Typed access to a semi-structured column: parsed once to a variant."""
    parsed = d.table("events").select("event_id", F.parse_json("props").alias("v"))
    return parsed.select(
        "event_id", F.variant_get("v", "$.k", "bigint").alias("k"),
        F.variant_get("v", "$.absent", "string").alias("absent"),
        F.variant_get("v", "$.k", "double").alias("k_float"),
    )


@query("json_object", """SELECT o_orderkey, '{"id":' || CAST(o_orderkey AS VARCHAR)
  || CASE WHEN o_orderstatus <> 'P' THEN ',"state":"' || o_orderstatus || '"' ELSE '' END || ',"status":"success"}' AS result FROM orders""")
def json_object(d: Data):
    """An object from keys and values; a NULL value leaves its key out."""
    body = F.struct(
        F.col("o_orderkey").alias("id"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("state"),
        F.lit("success").alias("status"),
    )
    return d.table("orders").select("o_orderkey", F.to_json(body).alias("result"))


@query("array_explode", with_("personas", "segments") + """SELECT persona_name, p.segment_id, segment_name, customer_count FROM personas p
JOIN segments s ON s.segment_id = p.segment_id""")
def array_explode(d: Data):
    """Personas unfolded to the micro-segments they stand for."""
    ids = F.explode(F.from_json("micro_segment_ids", "array<bigint>"))
    unfolded = bindings.personas(d.spark, d.dir).select("persona_name", ids.alias("segment_id"))
    found = segments.micro_segments(d.profiles, d.min_size)
    return found.join(unfolded, "segment_id").select(
        "persona_name", "segment_id", "segment_name", "customer_count"
    )


@query("prompt_column", """SELECT p_partkey, 'Write a subject line for ' || p_name || ' by ' || p_brand || '. Audience: ' || lower(p_type)
  || '. At most 60 characters.' AS prompt FROM part""")
def prompt_column(d: Data):
    text = F.concat(
        F.lit("Write a subject line for "), F.col("p_name"), F.lit(" by "), F.col("p_brand"),
        F.lit(". Audience: "), F.lower(F.col("p_type")), F.lit(". At most 60 characters."),
    )
    return d.table("part").select("p_partkey", text.alias("prompt"))


@query("cohort_assign", """SELECT c_custkey % 10 AS cohort, c_custkey % 3 AS channel_slot,
  CASE c_custkey % 10 WHEN 7 THEN 'stale' WHEN 8 THEN 'dormant' ELSE 'recent' END AS timing, COUNT(*) AS customers,
  MIN(c_custkey) AS first_customer FROM customer GROUP BY 1, 2, 3""")
def cohort_assign(d: Data):
    """Cohorts by modulus 10 and channels by modulus 3: coprime, so independent."""
    cohort = F.pmod(F.col("c_custkey"), F.lit(10))
    timing = F.when(cohort == 7, "stale").when(cohort == 8, "dormant").otherwise("recent")
    return d.table("customer").groupBy(
        cohort.alias("cohort"), F.pmod(F.col("c_custkey"), F.lit(3)).alias("channel_slot"), timing.alias("timing")
    ).agg(n().alias("customers"), F.min("c_custkey").alias("first_customer"))
