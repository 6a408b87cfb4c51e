"""The corpus pipeline: toxic documents go, near-duplicates keep one document each, documents with
benchmark items go, personal data is masked, and what remains is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``docs``. Between stages the rows are a written table in the shared folder.
Null, empty, very long and repeated rows, empty tables and further columns are treated as the
operators' own docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmentry.llm import bpe, decontaminate, minhash, pii, toxicity
from segmentry.llm.common import materialise, rank_file, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, rank_file()).drop("offsets")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_items),
    ("personal_data", mask_personal_data),
    ("encoding", encode),
]

# Learned scores, random walks and merges have no SQL form; see the brute-force test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
