"""Text expressions: tokens and lexicon scores, computed once per text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of the whole text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_BREAK)
    return F.filter(words, lambda w: w != F.lit(""))


def count_in(words: Column, lexicon: list[str]) -> Column:
    """How many tokens are in the lexicon. The list is a literal, so no join is needed."""
    return F.size(F.filter(words, lambda w: w.isin(lexicon)))


def polarity(positive: Column, negative: Column) -> Column:
    """``(p - n) / (p + n)`` in [-1, 1]; NULL for a text without any lexicon word."""
    found = positive + negative
    return F.when(found > 0, (positive - negative).cast("double") / found.cast("double"))
