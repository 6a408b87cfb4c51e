from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from segmentry.plans import search, sentiment, templates
from segmentry.sources import bindings, seeds
from segmentry.sources.storage import Tables

# A third of the texts are copies, one is far longer than the others.
TEXTS = [(i, "Trail shoe, light. TRAIL!" if i % 3 == 0 else f"word{i % 5} shoe number {i}", "en" if i % 2 else "de") for i in range(30)]
TEXTS += [(30, "trail " * 50 + "élan shoe " * 3000, "en"), (31, "", "de"), (32, None, "en")]


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string, lang string")


def brute_bm25(queries, keep=lambda lang: True, k=10):
    split = {i: words(t) for i, t, _ in TEXTS}
    n, mean = len(split), sum(map(len, split.values())) / len(split)
    df = Counter(w for ws in split.values() for w in set(ws))
    out = {}
    for name, terms in queries.items():
        scores = []
        for i, _, lang in TEXTS:
            tf = Counter(split[i])
            s = sum(
                math.log((n - df[t] + .5) / (df[t] + .5) + 1) * tf[t] * 2.2
                / (tf[t] + 1.2 * (.25 + .75 * len(split[i]) / mean))
                for t in terms
            )
            if s > 0 and keep(lang):
                scores.append((-round(s, 6), i))
        out[name] = sorted(scores)[:k]
    return out


def ranking(df):
    got = {}
    for r in df.orderBy("query", "position").collect():
        got.setdefault(r["query"], []).append((pytest.approx(-float(r.score), abs=2e-6), r.doc_id))
    return got


def test_bm25_against_brute_force(docs):
    queries = {"a": ["trail", "shoe"], "b": ["Élan", "word1"], "none": ["missing"]}
    lowered = {q: [t.lower() for t in ts] for q, ts in queries.items()}
    want = brute_bm25(lowered)
    got = ranking(search.bm25(docs, "doc_id", F.col("text"), queries))
    assert "none" not in got and want.pop("none") == []
    assert {q: [(s, i) for s, i in v] for q, v in want.items()} == got


def test_filter_restricts_results_but_not_statistics(docs):
    queries = {"a": ["trail", "shoe"]}
    got = ranking(search.bm25(docs, "doc_id", F.col("text"), queries, k=50, where=F.col("lang") == "de", attributes=["lang"]))
    assert {q: v for q, v in brute_bm25(queries, lambda lang: lang == "de", 50).items()} == got


def test_index_gives_the_same_answers(spark, docs, tmp_path):
    index = search.SearchIndex.build(Tables(spark, str(tmp_path)), docs, "doc_id", F.col("text"), ["lang"])
    queries = {"a": ["trail", "shoe"], "b": ["Élan", "word1"]}
    assert brute_bm25({q: [t.lower() for t in ts] for q, ts in queries.items()}) == ranking(index.search(queries))
    german = ranking(index.search({"a": ["trail", "shoe"]}, k=50, where=F.col("lang") == "de", attributes=["lang"]))
    assert brute_bm25({"a": ["trail", "shoe"]}, lambda lang: lang == "de", 50) == german


def test_nearest_against_brute_force(spark):
    vectors = [(i, [math.sin(i * (j + 1)) for j in range(8)] if i else [0.0] * 8) for i in range(60)]
    df = spark.createDataFrame(vectors, "id bigint, v array<float>")
    queries = [("x", [1.0] * 8), ("y", [float(j) for j in range(8)]), ("z", [-1.0, 2.0] * 4)]
    got = search.nearest(df, "id", "v", queries, k=5, block=2)
    for name, q in queries:
        def cosine(v):
            return sum(a * b for a, b in zip(v, q)) / math.sqrt(sum(a * a for a in v)) / math.sqrt(sum(b * b for b in q))
        want = [i for i, v in sorted(vectors[1:], key=lambda e: (-round(cosine(e[1]), 5), e[0]))[:5]]
        assert [r.id for r in got.filter(F.col("query") == name).orderBy("position").collect()] == want


def test_sentiment_limits_and_missing_words(spark):
    df = spark.createDataFrame(
        [(1, "CAT-001", "good good bad"), (2, "CAT-001", "bad bad good"), (3, "CAT-001", "good bad"),
         (4, "CAT-001", "plain"), (5, "CAT-001", None), (6, "CAT-002", "bad")],
        "review_id bigint, category_id string, review_text string")
    scored = sentiment.score_reviews(df, ["good"], ["bad"])
    got = {r.review_id: None if r.sentiment is None else float(r.sentiment) for r in scored.collect()}
    assert got == {1: 0.3333, 2: -0.3333, 3: 0.0, 4: None, 6: -1.0}
    rolled = {r.category_id: r for r in sentiment.rollup(scored, spark.createDataFrame(
        [("CAT-001", "one", "x"), ("CAT-002", "two", "x")], "category_id string, category_name string, department string")).collect()}
    first = rolled["CAT-001"]
    assert (first.review_count, first.positive_review_count, first.neutral_review_count, first.negative_review_count) == (4, 1, 1, 1)


def test_texts_are_split_once(spark, sf_dir):
    reviews = bindings.reviews(spark, sf_dir)
    for df in (sentiment.top_themes(reviews, ["and"], ["der"]), sentiment.score_reviews(reviews, ["and"], ["der"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") == 1 and plan.count("FileScan") == 1


def test_themes_against_brute_force(spark):
    data = [(i, "CAT-001", ("good " if i % 2 else "bad ") + f"theme{i % 9} comfort fit") for i in range(90)]
    df = spark.createDataFrame(data, "review_id bigint, category_id string, review_text string")
    got = {(r.polarity, r.position): (r.theme, r.mentions) for r in sentiment.top_themes(df, ["good"], ["bad"], k=4).collect()}
    for polarity, rest in (("positive", 1), ("negative", 0)):
        counts = Counter(w for i, _, t in data if i % 2 == rest for w in words(t))
        want = sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:4]
        assert [got[polarity, p + 1] for p in range(4)] == want


def test_template_rules(spark):
    body = "Reply STOP to unsubscribe "
    data = [
        ("sms", "sms_message", (body * 10)[:160]), ("sms", "sms_message", (body * 10)[:161]), ("sms", "sms_message", "hi"),
        ("email", "subject_line", "A" * 40), ("email", "subject_line", "Your trail gear is ready to be picked up"),
        ("email", "subject_line", "short"), ("push", "push_notification", "please CLICK here"), ("print", "flyer", "x"),
        ("push", "push_notification", None),
    ]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "id int, channel string, asset_type string, content_body string")
    checked = templates.check_assets(df, seeds.channel_templates(spark))
    got = {r.id: [n for n in templates.RULES if r[n]] for r in checked.collect()}
    assert got == {0: [], 1: ["too_long"], 2: ["missing_stop"], 3: ["all_caps"], 4: [], 5: ["subject_length"],
                   6: ["click_here"], 7: ["no_template"], 8: []}
    rolled = {(r.channel, r.asset_type): r for r in templates.violation_rollup(checked).collect()}
    assert rolled["sms", "sms_message"].publishable == 1 and rolled["sms", "sms_message"].assets == 3
