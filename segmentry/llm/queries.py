"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segmentry.llm import (
    bpe, decontaminate, filter_audit, language_model, licences, minhash, phrases, pii, repeats, sharding, topk, toxicity, transducer,
)
from segmentry.llm.common import rank_file, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), rank_file(), with_ids=False)


@query
def op9_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


ORACLES["op2_topk"] = topk.SQL


@query
def op3_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find_all(table(spark, sf_dir, "documents"))


@query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def piece_file() -> str:
    """The model file of the registered query; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count(table(spark, sf_dir, "documents"), piece_file())


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrases"] = phrases.SQL


@query
def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filters"] = filter_audit.SQL
