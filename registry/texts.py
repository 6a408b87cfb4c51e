"""Registered text, vector and streaming queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from registry.base import Data, query
from registry.analytics import prior_audience
from registry.sql import cnt, mean, rnd, sel, tokens, with_
from segmentry.functions import exprs as X
from segmentry.plans import search, sentiment, templates, writeback
from segmentry.sources import bindings, seeds
from segmentry.sources.schemas import AUDIENCES
from segmentry.sources.storage import Tables, new_path
from segmentry.streaming import outbox, weekly

LIBRARY_QUERIES = {
    "invented": ["rewh", "orantion", "ononst"],
    "german": ["nicht", "sich", "auf"],
    "mixed": ["pour", "orre", "thatin", "por"],
}
BRIEF_QUERIES = {"brief": ["assistant", "friendly", "the"], "tone": ["friendly", "dans"]}


def bm25_sql(source: str, key: str, queries: dict[str, list[str]], where: str = "TRUE", attributes: str = "") -> str:
    """BM25 over ``source(key, text)`` from its definition: postings of all tokens."""
    terms = ", ".join(f"('{q}', '{t}')" for q, ts in queries.items() for t in ts)
    extra = "".join(f", s.{a}" for a in attributes.split())
    return f"""docs AS (SELECT *, {tokens('text')} AS words FROM {source})
, post AS (SELECT {key}, len(words) AS dl, unnest(words) AS term FROM docs)
, tf AS (SELECT {key}, dl, term, COUNT(*) AS tf FROM post GROUP BY ALL)
, stats AS (SELECT COUNT(*) AS n, SUM(len(words)) / COUNT(*) AS avgdl FROM docs)
, df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term)
, asked(query, term) AS (VALUES {terms})
, scored AS (SELECT query, {key}, {rnd('''SUM(ln((n - df + 0.5) / (df + 0.5) + 1.0) * (tf * 2.2)
    / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)))''', 6)} AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), stats GROUP BY query, {key})
SELECT query, s.{key}{extra}, CAST(score AS DOUBLE) AS score, position FROM (SELECT scored.*, ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, {key}) AS position
  FROM scored JOIN {source} USING ({key}) WHERE {where}) r JOIN {source} s USING ({key}) WHERE position <= 10"""


@query("search_bm25", "WITH " + bm25_sql("documents", "doc_id", LIBRARY_QUERIES, attributes="lang source"))
def search_bm25(d: Data):
    return search.bm25(
        bindings.documents(d.spark, d.dir), "doc_id", F.col("text"), LIBRARY_QUERIES, attributes=["lang", "source"]
    )


@query("search_topk", "WITH " + bm25_sql("documents", "doc_id", {"one": ["the", "rewh"]}))
def search_topk(d: Data):
    return search.bm25(bindings.documents(d.spark, d.dir), "doc_id", F.col("text"), {"one": ["the", "rewh"]})


@query("search_filtered", "WITH " + bm25_sql(
    "documents", "doc_id", LIBRARY_QUERIES, "lang IN ('de', 'fr') AND source <> 'src3'", "lang source"))
def search_filtered(d: Data):
    return search.bm25(
        bindings.documents(d.spark, d.dir), "doc_id", F.col("text"), LIBRARY_QUERIES,
        where=F.col("lang").isin("de", "fr") & (F.col("source") != "src3"), attributes=["lang", "source"],
    )


def built_index(d: Data) -> search.SearchIndex:
    docs = bindings.documents(d.spark, d.dir)
    return search.SearchIndex.build(Tables(d.spark), docs, "doc_id", F.col("text"), ["lang", "source"])


@query("search_index", "WITH " + bm25_sql("documents", "doc_id", LIBRARY_QUERIES, attributes="lang source"))
def search_index(d: Data):
    """The same answers from a written index."""
    return built_index(d).search(LIBRARY_QUERIES, attributes=["lang", "source"])


@query("search_document", """SELECT doc_id, md5(COALESCE(source, '') || ' ' || COALESCE(text, '') || ' '
  || COALESCE(CAST(quality AS VARCHAR), '') || ' ' || COALESCE(lang, '')) AS digest
FROM documents LEFT JOIN labels USING (doc_id)""")
def search_document(d: Data):
    """One search text per entry. Labels are joined by key; a missing one leaves a blank."""
    joined = bindings.documents(d.spark, d.dir).join(d.table("labels"), "doc_id", "left")
    text = X.search_text(F.col("source"), F.col("text"), F.col("quality").cast("string"), F.col("lang"))
    return joined.select("doc_id", F.md5(text).alias("digest"))


@query("search_briefs", with_("briefs_in") + """, src AS (SELECT sequence,
  COALESCE(created_by, '') || ' ' || COALESCE(objective, '') || '  ' || COALESCE(tone, '') || ' ' AS text FROM briefs_in)
, """ + bm25_sql("src", "sequence", BRIEF_QUERIES))
def search_briefs(d: Data):
    submitted = bindings.brief_submissions(d.spark, d.dir)
    return search.bm25(submitted, "sequence", search.brief_text(F.col("brief_json")), BRIEF_QUERIES)


@query("search_cosine", f"""WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
, c AS (SELECT label, i, CAST(SUM(CAST(x AS DECIMAL(18,12))) AS DOUBLE) / COUNT(x) AS x FROM x GROUP BY label, i)
, s AS (SELECT c.label AS q, x.vec_id, {rnd('SUM(c.x * x.x) / (sqrt(SUM(x.x * x.x)) * sqrt(SUM(c.x * c.x)))', 6)} AS score
  FROM x JOIN c ON c.i = x.i GROUP BY c.label, x.vec_id)
SELECT CAST(q AS VARCHAR) AS query, vec_id, CAST(score AS DOUBLE) AS score, position FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS position FROM s) WHERE position <= 10""")
def search_cosine(d: Data):
    """The ten vectors nearest to the centre of each label."""
    vectors = bindings.vectors(d.spark, d.dir)
    # One vector per label; the labels are a fixed set of classes.
    centres = search.centroids(vectors, "label", "embedding").collect()
    asked = [(str(r["label"]), list(r["centre"])) for r in sorted(centres, key=lambda r: r["label"])]
    return search.nearest(vectors, "vec_id", "embedding", asked)


def in_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


SCORED = f"""w AS (SELECT doc_id AS review_id, 'CAT-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 3, '0') AS category_id,
  {tokens('text')} AS words FROM documents WHERE text IS NOT NULL)
, n AS (SELECT review_id, category_id, words, len([x for x in words if list_contains({in_list(seeds.POSITIVE_WORDS)}, x)]) AS positive_words,
  len([x for x in words if list_contains({in_list(seeds.NEGATIVE_WORDS)}, x)]) AS negative_words FROM w)
, scored AS (SELECT *, CASE WHEN positive_words + negative_words > 0 THEN
  {rnd('CAST(positive_words - negative_words AS DOUBLE) / (positive_words + negative_words)', 4)} END AS sentiment FROM n)
"""


@query("sentiment_score", "WITH " + SCORED + sel("review_id category_id positive_words negative_words sentiment:d", "scored"))
def sentiment_score(d: Data):
    return sentiment.score_reviews(bindings.reviews(d.spark, d.dir), seeds.POSITIVE_WORDS, seeds.NEGATIVE_WORDS)


@query("sentiment_rollup", with_("categories") + ", " + SCORED + f"""SELECT category_id, category_name, department,
  CAST({rnd(mean('sentiment'), 4)} AS DOUBLE) AS avg_sentiment, COUNT(*) AS review_count,
  {cnt('sentiment > 0.2')} AS positive_review_count, {cnt('sentiment BETWEEN -0.2 AND 0.2')} AS neutral_review_count,
  {cnt('sentiment < -0.2')} AS negative_review_count
FROM scored JOIN categories USING (category_id) GROUP BY category_id, category_name, department""")
def sentiment_rollup(d: Data):
    return sentiment.rollup(sentiment_score(d), d.categories)


@query("top_themes", "WITH " + SCORED + """, t AS (SELECT CASE WHEN sentiment > 0.2 THEN 'positive' ELSE 'negative' END AS polarity,
  unnest(words) AS theme FROM scored WHERE sentiment > 0.2 OR sentiment < -0.2)
, c AS (SELECT polarity, theme, COUNT(*) AS mentions FROM t GROUP BY polarity, theme)
SELECT polarity, theme, mentions, position FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY polarity ORDER BY mentions DESC, theme) AS position FROM c)
WHERE position <= 10""")
def top_themes(d: Data):
    return sentiment.top_themes(bindings.reviews(d.spark, d.dir), seeds.POSITIVE_WORDS, seeds.NEGATIVE_WORDS)


@query("template_check", with_("assets_in", "templates") + f""", f AS (SELECT a.channel, a.asset_type,
  COALESCE(length(content_body) > max_length, FALSE) AS too_long,
  a.asset_type = 'subject_line' AND NOT length(content_body) BETWEEN 35 AND 55 AS subject_length,
  a.channel = 'sms' AND NOT contains(content_body, 'STOP') AS missing_stop,
  contains(lower(content_body), 'click here') AS click_here,
  a.asset_type = 'subject_line' AND upper(content_body) = content_body AND lower(content_body) <> content_body AS all_caps,
  template_id IS NULL AS no_template
FROM assets_in a LEFT JOIN templates t ON t.channel = a.channel AND t.asset_type = a.asset_type)
SELECT channel, asset_type, COUNT(*) AS assets, {', '.join(f'COUNT(*) FILTER (WHERE {r}) AS {r}' for r in templates.RULES)},
  COUNT(*) FILTER (WHERE NOT ({' OR '.join(templates.RULES)})) AS publishable FROM f GROUP BY channel, asset_type""")
def template_check(d: Data):
    assets = writeback.parsed_assets(bindings.asset_submissions(d.spark, d.dir), datetime(2001, 8, 2, 9, 30, 15))
    return templates.violation_rollup(templates.check_assets(assets, seeds.channel_templates(d.spark)))


# ---- streams ----------------------------------------------------------------

@query("stream_weekly", with_("ce") + f"""SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS period, campaign_id, channel,
  {cnt("event_type = 'send'")} AS sends, {cnt("event_type = 'open'")} AS opens, {cnt("event_type = 'click'")} AS clicks,
  {cnt("event_type = 'convert'")} AS conversions FROM ce GROUP BY 1, 2, 3""")
def stream_weekly(d: Data):
    # A folder of part files, or one file: the file's folder is watched for its name then.
    orders = weekly.arriving(d.spark, d.dir, "orders", d.table("orders").schema)
    return weekly.weekly_state(bindings.campaign_activity(orders))


@query("stream_outbox", with_("customers") + """SELECT preferred_channel, campaign_name, COUNT(*) AS delivered, MIN(customer_id) AS first_customer,
  MAX(customer_id) AS last_customer FROM (SELECT *, 'Summer Trail Days' AS campaign_name FROM customers WHERE customer_id % 4 = 0)
GROUP BY preferred_channel, campaign_name""")
def stream_outbox(d: Data):
    """Staged rows arrive in two writes; the second run delivers only the new ones."""
    path = new_path(d.spark, "stream-outbox")
    staged = prior_audience(d)
    for part in (0, 1):
        arrived = staged.filter(F.floor(F.col("customer_id") % 8 / 4) == part)
        arrived.write.mode("append").parquet(f"{path}/staged")
        stream = d.spark.readStream.schema(staged.schema).parquet(f"{path}/staged")
        outbox.deliver(stream, path)
    sent = outbox.delivered(d.spark, path, AUDIENCES.ddl())
    return sent.groupBy("preferred_channel", "campaign_name").agg(
        F.count(F.lit(1)).alias("delivered"), F.min("customer_id").alias("first_customer"),
        F.max("customer_id").alias("last_customer"),
    )
