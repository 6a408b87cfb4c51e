"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learned from. With the
class prior p, the risk of calling unlabelled text toxic is corrected by the
toxic texts it must hold: R = p * E_pos[l(f)] + max(0, E_unl[l(-f)] - p * E_pos[l(-f)]).
Where the corrected part of a batch falls below zero it adds nothing to the
step, so the classifier does not learn the unlabelled sample by heart.

A text is the set of its lower-cased words. A word counts as itself and as its
first four and five letters, which catches families of made-up or inflected
insults. The classifier is linear over the most telling of these features.

Defined cases: a NULL text is empty; an empty text scores by the intercept; a
row without doc_id is scored and may be learned from; repeated rows score
alike; of several labels of a doc_id the largest counts; features of one gap are
chosen by their hash; a text of any length is one set of words; without toxic
examples every score is 0; an empty table gives no rows; other columns are
ignored.

Plan: the sampled texts' features are written, counted and ranked in Spark; the
driver gets the chosen features and one bit for each of them and text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from segmentry.llm.common import fold, materialise, texts

WORD = re.compile(r"\w+")
PREFIXES = (4, 5)
# At most so many toxic and unlabelled training texts are fitted on. The
# samples are drawn by a hash of the row over the whole table.
MAX_POSITIVE, MAX_UNLABELLED = 3_000, 6_000
# At most so many features, those whose rates differ most between the samples,
# by so many standard errors at least.
N_FEATURES = 256
MIN_TEXTS = 5
MIN_GAP = 5.0


def features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings."""
    own = word.encode()
    return (crc32(own), *(crc32(f"{word[:n]}*{n}".encode()) for n in PREFIXES if len(word) >= n))


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass(frozen=True)
class Classifier:
    """``weights`` by feature hash, and the intercept; no weights at all: nothing was learned."""

    weights: dict[int, float]
    intercept: float

    def score(self, text: Column) -> Column:
        weights, intercept = self.weights, self.intercept

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict[str, float] = {}

            def worth(word: str) -> float:
                if (found := known.get(word)) is None:
                    if len(known) > 500_000:  # bounds the memory of a worker
                        known.clear()
                    found = known[word] = sum(weights.get(f, 0.0) for f in features(word))
                return found

            for batch in batches:
                # Sorted, so that a sum doesn't depend on the order of a set.
                totals = [intercept + sum(sorted(filter(None, map(worth, words(t or ""))))) for t in batch]
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(totals, -500, 500))), dtype="float64")

        return scored(text) if weights else F.lit(0.0)


def sampled(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows chosen by a hash over all of them; all, if there are no more.

    The share is five standard deviations below ``most``, so that it is not exceeded and nothing is cut off.
    """
    n = df.count()
    if n <= most:
        return df
    wanted = max(1, most - int(5 * most**0.5))
    # The hash as a number below 2^63, so the share is fine for any row count.
    return df.filter(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1) < F.lit(int(2**63 * wanted // n)).cast("bigint"))


def hashed(df: DataFrame) -> DataFrame:
    """Feature hashes ``f`` of every text."""

    @F.pandas_udf(ArrayType(LongType()))
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series([sorted({f for w in words(t) for f in features(w)}) for t in batch])

    return df.select(of("text").alias("f"))


def telling(samples: DataFrame, n_positive: int, n_unlabelled: int, n: int) -> np.ndarray:
    """The ``n`` features whose rates in the two samples (rows (positive, f)) differ most, in standard errors.

    Counted and ranked in Spark; ``n`` rows reach the driver.
    """
    texts_with = samples.select("positive", F.explode("f").alias("f")).groupBy("f").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).filter(
        (F.col("p") >= MIN_TEXTS) | (F.col("u") >= MIN_TEXTS))
    mean = (F.col("p") + F.col("u")) / (n_positive + n_unlabelled)
    error = F.sqrt(F.greatest(mean * (1 - mean), F.lit(1e-9)) * (1 / n_positive + 1 / n_unlabelled))
    gap = F.abs(F.col("p") / n_positive - F.col("u") / n_unlabelled) / error
    best = texts_with.withColumn("gap", gap).filter(F.col("gap") >= MIN_GAP).orderBy(F.col("gap").desc(), "f").limit(n)
    return np.sort(best.select("f").toArrow().column("f").to_numpy().astype(np.int64))


def matrix(rows: DataFrame, chosen: np.ndarray) -> np.ndarray:
    """For each text which of the chosen features it has; a bit a feature is what reaches the driver."""

    @F.pandas_udf("binary")
    def held(batch: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(np.isin(chosen, f)).tobytes() for f in batch])

    packed = b"".join(rows.select(held("f").alias("x")).toArrow().column("x").to_pylist())
    return np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, -(-len(chosen) // 8)), axis=1)[:, : len(chosen)].astype(np.float32)


def fit(chosen: np.ndarray, pos: np.ndarray, unl: np.ndarray, prior: float,
        rounds: int = 600, rate: float = 0.1, ridge: float = 1e-4) -> Classifier:
    """Minimise the non-negative risk with logistic loss by Adam over mini-batches.

    ``pos`` and ``unl``: which of the ``chosen`` features the confirmed and the unlabelled texts have.
    """
    w = np.zeros(len(chosen) + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second, random = np.zeros_like(w), np.zeros_like(w), np.random.default_rng(7)

    def slopes(x: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean of log(1 + exp(-sign * f)) and its gradient."""
        z = sign * (x @ w[:-1].astype(np.float32) + w[-1])
        pull = -sign / (1 + np.exp(np.clip(z, -50, 50)))
        return float(np.logaddexp(0, -z).mean()), np.append(x.T @ pull.astype(np.float32), pull.sum()) / len(x)

    for step in range(1, rounds + 1):
        p = pos[random.permutation(len(pos))[: max(1, len(pos) // 2)]]
        u = unl[random.permutation(len(unl))[: max(1, len(unl) // 2)]]
        (_, toxic), (p_loss, p_clean), (u_loss, u_clean) = slopes(p, 1), slopes(p, -1), slopes(u, -1)
        clean = u_clean - prior * p_clean
        grad = prior * toxic + (clean if u_loss - prior * p_loss >= 0 else 0)
        grad = grad + ridge * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Classifier({int(f): float(v) for f, v in zip(chosen, w[:-1], strict=True)}, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, n_features: int = N_FEATURES) -> Classifier:
    """Learn from the rows of ``docs`` outside fold 0.

    The prior is the toxic share of the labelled training rows, over all of them.
    """
    known = texts(docs).filter(F.coalesce(fold(F.col("doc_id")) != 0, F.lit(True)))
    marks = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    n, toxic = marks.agg(F.count("toxic"), F.sum("toxic")).first()
    if not toxic:
        return Classifier({}, 0.0)
    confirmed = known.join(marks.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    samples = materialise(hashed(sampled(confirmed, max_positive)).withColumn("positive", F.lit(True)).unionByName(
        hashed(sampled(known, max_unlabelled)).withColumn("positive", F.lit(False))), "samples")
    positive, unlabelled = samples.filter("positive"), samples.filter("not positive")
    sizes = positive.count(), unlabelled.count()
    chosen = telling(samples, *sizes, n_features) if all(sizes) else np.empty(0, np.int64)
    if not len(chosen):
        return Classifier({}, 0.0)
    return fit(chosen, matrix(positive, chosen), matrix(unlabelled, chosen), float(np.clip(toxic / n, 0.001, 0.999)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = train(docs, labels)
    return (
        texts(docs)
        .select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                model.score(F.col("text")).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    model = train(docs, labels)
    return docs.filter(model.score(F.coalesce("text", F.lit(""))) < 0.5)
