"""Retrieval: BM25 over texts and cosine similarity over vectors, both as top-k."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exprs as X
from segmentry.functions import text as T
from segmentry.operators.topk import top_per_group
from segmentry.sources.seeds import inline
from segmentry.sources.storage import Tables, materialise

K1, B = 1.2, 0.75
TOP = 10  # Fixed value: results returned per query.


def scan(documents: DataFrame, key: str, text: Column, terms: list[str], attributes: list[str]) -> DataFrame:
    """Per document: its length and the tokens that some query asks for.

    Texts are read and split once, and only the asked tokens leave the scan;
    the rest of the search works on this narrow table.
    """
    words = T.tokens(text)
    return documents.select(key, *attributes, words.alias("_words")).select(
        key, *attributes,
        F.size("_words").cast("bigint").alias("length"),
        F.filter("_words", lambda w: w.isin(terms)).alias("hits"),
    )


def corpus_stats(scanned: DataFrame) -> DataFrame:
    """One row: number of documents and of tokens."""
    return scanned.agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("length").alias("n_tokens")
    )


def document_frequency(scanned: DataFrame) -> DataFrame:
    """Number of documents per asked term; at most one row per term."""
    return (
        scanned.select(F.explode(F.array_distinct("hits")).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    )


def idf(n_docs: int, df: int) -> float:
    return math.log((n_docs - df + 0.5) / (df + 0.5) + 1.0)


def row_scores(queries: list[tuple[str, list[tuple[str, float]]]], mean_length: float) -> Column:
    """Array of (query, score) of one document, from its ``hits`` and ``length``.

    The score needs only the document's own row and literals, so scoring does
    not shuffle.
    """
    table = F.array(*[
        F.struct(
            F.lit(name).alias("query"),
            F.array(*[
                F.struct(F.lit(term).alias("term"), F.lit(weight).alias("idf")) for term, weight in terms
            ]).alias("terms"),
        )
        for name, terms in queries
    ])
    ratio = F.col("length") / F.lit(mean_length)
    penalty = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * ratio)

    def part(term: Column) -> Column:
        tf = F.size(F.filter("hits", lambda h: h == term["term"])).cast("double")
        return term["idf"] * (tf * F.lit(K1 + 1)) / (tf + penalty)

    def total(query: Column) -> Column:
        score = F.aggregate(query["terms"], F.lit(0.0), lambda s, t: s + part(t))
        return F.struct(query["query"].alias("query"), score.alias("raw"))

    return F.transform(table, total)


def bm25(
    documents: DataFrame,
    key: str,
    text: Column,
    queries: dict[str, list[str]],
    k: int = TOP,
    where: Column | None = None,
    attributes: list[str] | None = None,
) -> DataFrame:
    """The best ``k`` documents per query: ``query, position, key, score`` and the attributes.

    ``queries`` maps a query name to its terms. Statistics cover all documents;
    ``where`` restricts the results by attribute. Ties go to the smaller key.
    The texts are read once: the narrow scan is written, and statistics and
    scores are computed from it.
    """
    attributes = attributes or []
    terms = sorted({t.lower() for ts in queries.values() for t in ts})
    scanned = materialise(scan(documents, key, text, terms, attributes), "search")
    # One row of totals and one row per asked term come back and enter the plan as literals.
    totals = corpus_stats(scanned).first()
    n_docs, n_tokens = totals["n_docs"], totals["n_tokens"] or 0
    frequency = {r["term"]: r["df"] for r in document_frequency(scanned).collect()}
    mean_length = n_tokens / n_docs if n_tokens else 1.0
    weighted = [
        (name, [(t.lower(), idf(n_docs, frequency.get(t.lower(), 0))) for t in ts])
        for name, ts in queries.items()
    ]
    found = scanned if where is None else scanned.filter(where)
    scored = (
        found.filter(F.size("hits") > 0)
        .select(key, *attributes, F.explode_outer(row_scores(weighted, mean_length)).alias("r"))
        .filter(F.col("r.raw") > 0)
        .select(F.col("r.query").alias("query"), key, *attributes,
                X.round_to(F.col("r.raw"), 6).alias("score"))
    )
    return top_per_group(scored, ["query"], [F.col("score").desc(), F.col(key)], k)


class SearchIndex:
    """A written index: built once per refresh, then asked many times.

    Tables: ``documents`` (key, attributes, length), ``postings`` (term, key,
    length, count), ``terms`` (term, number of documents) and ``corpus`` (one
    row of totals). Postings are
    range-partitioned and sorted by term and key, so a query reads only the row
    groups of its own terms, and a term that most documents have is spread over
    several files.
    """

    def __init__(self, tables: Tables, key: str):
        self.tables, self.key = tables, key

    @classmethod
    def build(
        cls, tables: Tables, documents: DataFrame, key: str, text: Column, attributes: list[str]
    ) -> SearchIndex:
        index = cls(tables, key)
        words = documents.select(key, *attributes, T.tokens(text).alias("_words"))
        stored = tables.overwrite(
            "documents", words.select(key, *attributes, F.size("_words").cast("bigint").alias("length"))
        )
        tables.overwrite("corpus", corpus_stats(stored))
        unfolded = words.select(
            key, F.size("_words").cast("bigint").alias("length"), F.explode_outer("_words").alias("term")
        ).filter(F.col("term").isNotNull())
        counted = unfolded.groupBy("term", key, "length").agg(F.count(F.lit(1)).alias("tf"))
        postings = tables.overwrite(
            "postings", counted.repartitionByRange("term", key).sortWithinPartitions("term", key)
        )
        per_term = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        tables.overwrite("terms", per_term.repartitionByRange("term").sortWithinPartitions("term"))
        return index

    def search(
        self, queries: dict[str, list[str]], k: int = TOP, where: Column | None = None,
        attributes: list[str] | None = None,
    ) -> DataFrame:
        """As :func:`bm25`, from the index: the texts are not read."""
        key, attributes = self.key, attributes or []
        asked = [(name, term.lower()) for name, terms in queries.items() for term in terms]
        wanted = sorted({term for _, term in asked})
        documents = self.tables.read("documents")
        totals = self.tables.read("corpus").first()
        known = self.tables.read("terms").filter(F.col("term").isin(wanted)).collect()
        weights = {r["term"]: idf(totals["n_docs"], r["df"]) for r in known}
        rows = [(name, term, weights[term]) for name, term in asked if term in weights]
        table = inline(documents.sparkSession, rows, "query string, term string, idf double")
        found = self.tables.read("postings").filter(F.col("term").isin(wanted))
        if where is not None:
            found = found.join(documents.filter(where).select(key), key, "left_semi")
        mean_length = (totals["n_tokens"] or 0) / max(totals["n_docs"], 1) or 1.0
        penalty = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("length") / F.lit(mean_length))
        tf = F.col("tf").cast("double")
        weight = F.col("idf") * (tf * F.lit(K1 + 1)) / (tf + penalty)
        scored = (
            found.join(table, "term").groupBy("query", key)
            .agg(X.round_to(F.sum(weight), 6).alias("score"))
        )
        best = top_per_group(scored, ["query"], [F.col("score").desc(), F.col(key)], k)
        if attributes:
            best = best.join(documents.select(key, *attributes), key)
        return best.select("query", key, *attributes, "score", "position")


def brief_text(content: Column) -> Column:
    """Searchable text of a brief: five fields of its JSON."""
    fields = ["persona_name", "objective", "target_audience_description", "tone", "brand_voice_notes"]
    parsed = F.from_json(content, ", ".join(f"{f} string" for f in fields))
    return X.search_text(*[parsed[f] for f in fields])


def as_doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def centroids(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group. Components are summed as fixed-point numbers, so the
    mean does not depend on the order of rows."""
    parts = vectors.select(group, F.posexplode(as_doubles(F.col(vector))).alias("i", "x"))
    means = parts.groupBy(group, "i").agg(
        (F.sum(F.col("x").cast("decimal(18,12)")).cast("double") / F.count("x")).alias("x")
    )
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))  # one vector: its dimension bounds it
    return means.groupBy(group).agg(F.transform(ordered, lambda e: e["x"]).alias("centre"))


def nearest(
    vectors: DataFrame, key: str, vector: str, queries: list[tuple[str, list[float]]], k: int = TOP,
    block: int = 256,
) -> DataFrame:
    """The ``k`` nearest vectors per query by cosine, exact.

    Queries are few and travel as literals, in blocks; vectors are read in
    place, never shuffled. The per-query top-k is taken inside each task
    before the exchange.
    """
    out = None
    for start in range(0, len(queries), block):
        part = queries[start:start + block]
        table = F.array(*[
            F.struct(
                F.lit(name).alias("query"), F.lit(values).alias("values"),
                F.lit(math.sqrt(sum(v * v for v in values))).alias("length"),
            )
            for name, values in part
        ])
        rows = vectors.select(key, as_doubles(F.col(vector)).alias("v"))
        rows = rows.select(key, "v", norm(F.col("v")).alias("length"), F.explode(table).alias("q"))
        cosine = dot(F.col("v"), F.col("q.values")) / (F.col("length") * F.col("q.length"))
        scored = rows.filter(F.col("length") > 0).select(
            F.col("q.query").alias("query"), key, X.round_to(cosine, 6).alias("score")
        )
        best = top_per_group(scored, ["query"], [F.col("score").desc(), F.col(key)], k)
        out = best if out is None else out.unionByName(best)
    return out
