"""Lexicon sentiment of reviews and its rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.functions import text as T
from segmentry.operators.topk import top_per_group

LIMIT = 0.2  # Fixed value: above is positive, below the negative is negative.


def score_reviews(reviews: DataFrame, positive: list[str], negative: list[str]) -> DataFrame:
    """Every review with its score; the text is split once and left behind."""
    words = reviews.filter(F.col("review_text").isNotNull()).withColumn(
        "words", T.tokens(F.col("review_text"))
    )
    counted = words.select(
        "review_id", "category_id",
        T.count_in(F.col("words"), positive).cast("bigint").alias("positive_words"),
        T.count_in(F.col("words"), negative).cast("bigint").alias("negative_words"),
    )
    score = T.polarity(F.col("positive_words"), F.col("negative_words"))
    return counted.withColumn("sentiment", X.round_to(score, 4))


def polarity_label(sentiment: Column) -> Column:
    return (
        F.when(sentiment > LIMIT, "positive").when(sentiment < -LIMIT, "negative")
        .when(sentiment.isNotNull(), "neutral")
    )


def rollup(scored: DataFrame, categories: DataFrame) -> DataFrame:
    """Mean score and counts per product category.

    Scores are aggregated per category id first; the category names are joined
    to the grouped rows.
    """
    sentiment = F.col("sentiment")
    grouped = scored.groupBy("category_id").agg(
        X.round_to(X.mean(sentiment), 4).alias("avg_sentiment"),
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(sentiment > LIMIT).alias("positive_review_count"),
        F.count_if(sentiment.between(-LIMIT, LIMIT)).alias("neutral_review_count"),
        F.count_if(sentiment < -LIMIT).alias("negative_review_count"),
    )
    named = grouped.join(
        categories.select("category_id", "category_name", "department"), "category_id"
    )
    return named.select(
        "category_id", "category_name", "department", "avg_sentiment", "review_count",
        "positive_review_count", "neutral_review_count", "negative_review_count",
    )


def top_themes(
    reviews: DataFrame, positive: list[str], negative: list[str], k: int = 10
) -> DataFrame:
    """Most frequent words of positive and of negative reviews, per polarity.

    Words are counted before they are shuffled, and each task hands on only its
    best ``k`` per polarity, as there are only two groups.
    """
    # Step by step, and without a filter before the words are unfolded: a filter
    # on the label would be pushed down and split every text again.
    words = reviews.select(T.tokens(F.col("review_text")).alias("words"))
    counted = words.select(
        "words",
        T.count_in(F.col("words"), positive).alias("p"), T.count_in(F.col("words"), negative).alias("n"),
    )
    scored = counted.select("words", X.round_to(T.polarity(F.col("p"), F.col("n")), 4).alias("sentiment"))
    labelled = scored.select("words", polarity_label(F.col("sentiment")).alias("polarity"))
    kept = F.when(F.col("polarity").isin("positive", "negative"), F.col("words"))
    tokens = labelled.select("polarity", F.explode_outer(kept).alias("theme")).filter(
        F.col("theme").isNotNull()
    )
    counts = tokens.groupBy("polarity", "theme").agg(F.count(F.lit(1)).alias("mentions"))
    return top_per_group(
        counts, ["polarity"], [F.col("mentions").desc(), F.col("theme")], k, salt=F.col("theme")
    )
