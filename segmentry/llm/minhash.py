"""Near-duplicates by DartMinHash signatures and banded joining.

A text is the set of its five-word runs. Every element has a fixed random
sequence of darts along the rank axis, one region per unit of weight, as if
darts were thrown once at all weights and ranks. A text takes the darts that
hit its elements' regions below a rank bound chosen so that about k (ln k + 4)
of them arrive, whatever its length; each dart belongs to one of k coordinates
and the earliest of a coordinate is its signature value. Texts with an empty
coordinate throw on, up to twice the rank. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity.

Groups of four coordinates make a band. In each band bucket every text is
linked to the bucket's first text only, so a bucket of a third of all texts
costs one row per text. Links are verified on the whole texts. Texts of a
bucket that are still in different components are then compared with each
other where their signatures allow the similarity, which finds the links that
do not pass through a first text.

Copies are collapsed by their digest before all this.

Defined cases: a NULL text is empty; texts without words resemble nothing, not
even each other; a text of fewer than five words is one element; a class is
named by its least doc_id; rows that repeat a doc_id each get a row; rows with
a NULL doc_id take part, and name a class only (NULL) if it has no other row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import WordHashes, grams, materialise, mixed, texts
from segmentry.llm.components import components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
COORDINATES = 256
# A pair whose signatures agree in less than this can't reach the similarity:
# at 256 coordinates it is four standard deviations below.
POSSIBLE = 0.7


def elements(text: str, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    return np.unique(grams(hashes.of(text.lower().split()), words))


def darts(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, bound: np.ndarray,
          k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best rank and the dart's hash for each (owner, coordinate); rank infinite if none.

    ``bound`` is the rank bound by owner; ``owner`` numbers the texts from 0.
    """
    best = np.full(len(bound) * k, np.inf)
    value = np.zeros(len(bound) * k, dtype=np.uint64)
    # One region per unit of weight; the last may be covered in part.
    units = np.maximum(np.ceil(weight), 1).astype(np.int64)
    at = np.repeat(np.arange(len(owner)), units)
    unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
    owner, cover = owner[at], np.minimum(weight[at] - unit, 1.0)
    seed = mixed(element[at] + np.uint64(0x9E3779B97F4A7C15) * (unit.astype(np.uint64) + np.uint64(1)))
    limit, rank, throw = bound[owner], np.zeros(len(at)), 0
    hits = []
    while len(seed):
        throw += 1
        dart = mixed(seed + np.uint64(throw * 0xD1B54A32D192ED03 % 2**64))
        rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53)
        alive = rank < limit
        owner, cover, seed, limit, rank, dart = (x[alive] for x in (owner, cover, seed, limit, rank, dart))
        second = mixed(dart + np.uint64(0xA0761D6478BD642F))
        inside = (second >> np.uint64(40)).astype(np.float64) / 2.0**24 < cover
        second = second[inside]
        hits.append((owner[inside] * k + (second % np.uint64(k)).astype(np.int64), rank[inside], mixed(second)))
    where, rank, dart = (np.concatenate(x) for x in zip(*hits, strict=True))
    np.minimum.at(best, where, rank)
    first = best[where] == rank
    value[where[first]] = dart[first]
    return best, value


def signatures(sets: list[np.ndarray], k: int = COORDINATES, weights: list[np.ndarray] | None = None) -> np.ndarray:
    """k values for each non-empty set of element hashes; weights are positive, 1 each unless given."""
    weights = weights or [np.ones(len(s)) for s in sets]
    out = np.zeros((len(sets), k), dtype=np.uint64)
    open_, factor = np.arange(len(sets)), 1.0
    while len(open_):
        sizes = [len(sets[i]) for i in open_]
        total = np.array([weights[i].sum() for i in open_])
        best, value = darts(
            np.repeat(np.arange(len(open_)), sizes), np.concatenate([sets[i] for i in open_]),
            np.concatenate([weights[i] for i in open_]), factor * k * (np.log(k) + 4) / total, k)
        full = np.isfinite(best.reshape(-1, k)).all(axis=1)
        out[open_[full]] = value.reshape(-1, k)[full]
        open_, factor = open_[~full], factor * 2
    return out


def bands(signature: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash of each band's values and number."""
    out = np.tile(np.arange(1, n_bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, r : n_bands * rows : rows])
    return out


def chunks(items: list[np.ndarray], most: int = 1_000_000) -> Iterator[list[int]]:
    """Indices of non-empty items by size, cut where elements and darts add up, which bounds the memory of a step."""
    now, size = [], 0
    for i in sorted(range(len(items)), key=lambda i: len(items[i])):
        if len(items[i]):
            now.append(i)
            size += len(items[i]) + 10 * COORDINATES
            if size >= most:
                yield now
                now, size = [], 0
    if now:
        yield now


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, text digest, band hashes and one byte of each signature value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (b.slice(i, 2_000) for b in batches for i in range(0, b.num_rows, 2_000)):
            sets = [elements(t, hashes) for t in batch.column("text").to_pylist()]
            banded, short = [None] * len(sets), [None] * len(sets)
            for chosen in chunks(sets):
                s = signatures([sets[i] for i in chosen])
                for i, b, x in zip(chosen, bands(s).view(np.int64), s.astype(np.uint8).view(np.int8), strict=True):
                    banded[i], short[i] = b, x
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(banded, pa.list_(pa.int64())),
                 pa.array(short, pa.list_(pa.int8()))], ["doc_id", "key", "bands", "signature"])

    keyed = texts(docs).withColumn("key", F.unhex(F.md5("text")))
    return keyed.mapInArrow(run, "doc_id bigint, key binary, bands array<bigint>, signature array<tinyint>")


def whole_texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of the given (key, first doc_id), once each.

    Rows are dealt by digest and doc_id, so a text with very many copies is spread over tasks and
    only its first row goes on. The keys grow with the input and are never broadcast.
    """
    rows = texts(docs).select(F.unhex(F.md5("text")).alias("key"), "doc_id", "text")
    wanted = keys.select(F.col("key").alias("k"), "first").hint("merge")
    chosen = rows.join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    # Rows that repeat a doc_id and text are left.
    return materialise(chosen.select("key", "text").dropDuplicates(["key"]), "texts")


def verified(pairs: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v of text digests) whose texts are similar enough, compared on whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = WordHashes(), {}

        def of(key: bytes, text: str) -> np.ndarray:
            if key not in kept:
                if len(kept) >= 256:
                    kept.clear()
                kept[key] = elements(text, hashes)
            return kept[key]

        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            u, v, a, b = (batch.column(c).to_pylist() for c in ("u", "v", "a", "b"))
            good = []
            for i in range(len(u)):
                x, y = of(u[i], a[i]), of(v[i], b[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    a = whole.select(F.col("key").alias("u"), F.col("text").alias("a"))
    b = whole.select(F.col("key").alias("v"), F.col("text").alias("b"))
    return pairs.join(b, "v").join(a, "u").select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def agreement(a: str, b: str):
    """Share of signature bytes in which two texts agree beyond chance."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (same / COORDINATES - 1 / 256) / (1 - 1 / 256)


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size, text_copies of every row of ``docs``."""
    signed = materialise(sign(docs), "signed")
    nodes = materialise(
        signed.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"),
                                  F.first("signature").alias("signature"), F.count(F.lit(1)).alias("copies")), "nodes")
    banded = nodes.select(F.posexplode("bands").alias("place", "bucket"), "key", F.struct("first", "key").alias("node"))
    heads = banded.groupBy("bucket").agg(F.min("node.key").alias("low"), F.max("node.key").alias("high"),
                                         F.min("node").alias("head")).filter("low <> high")
    # Written, so that both sides of the join are plain exchanges, which the planner splits where a bucket is hot.
    heads = materialise(heads.select("bucket", F.col("head.key").alias("head")), "heads")
    shared = materialise(banded.select("bucket", "place", "key").join(heads, "bucket"), "buckets")
    whole = whole_texts(docs, nodes.select("key", "first").join(shared.select("key").distinct(), "key"))
    links = verified(shared.filter("key <> head").select(F.col("head").alias("u"), F.col("key").alias("v")).distinct(),
                     whole, similarity)
    links = materialise(links, "links")
    found = components(links)
    # Texts of one bucket in different components: compared where the signatures allow a link.
    placed = shared.select("bucket", "place", "key").join(
        found.select(F.col("node").alias("key"), "component"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    split = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    rest = placed.join(split.select("bucket"), "bucket", "left_semi").join(nodes.select("key", "signature", "bands"), "key")
    rest = materialise(rest, "rest")
    left = rest.select("bucket", "place", *[F.col(c).alias(f"u_{c}") for c in ("key", "component", "signature", "bands")])
    right = rest.select("bucket", *[F.col(c).alias(f"v_{c}") for c in ("key", "component", "signature", "bands")])
    across = left.join(right, "bucket").filter(
        (F.col("u_key") < F.col("v_key")) & (F.col("u_component") != F.col("v_component"))
        # In their first common bucket only.
        & ~F.arrays_overlap(F.slice("u_bands", F.lit(1), F.col("place")), F.slice("v_bands", F.lit(1), F.col("place")))
        & (agreement("u_signature", "v_signature") >= POSSIBLE))
    more = materialise(verified(across.select(F.col("u_key").alias("u"), F.col("v_key").alias("v")), whole, similarity), "more")
    named = nodes.select("key", "first", "copies").join(
        found.select(F.col("node").alias("key"), "component"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    # Further links join whole components, so only the components are linked again.
    own = found.select("node", "component")
    ends = more
    for end in ("u", "v"):
        ends = ends.join(own.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left").withColumn(
            end, F.coalesce(f"c{end}", end)).drop(f"c{end}")
    joined = components(ends.select("u", "v")).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    named = named.join(joined, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")
    named = materialise(named, "named")
    sizes = named.groupBy("component").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    by_key = named.join(sizes, "component").select("key", "class_id", "class_size", F.col("copies").alias("text_copies"))
    # Texts without words are classes of their own, copies too.
    return signed.select("doc_id", "key", F.col("bands").isNull().alias("blank")).join(by_key, "key").select(
        "doc_id",
        F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("blank"), F.lit(1).cast("bigint")).otherwise(F.col("class_size")).alias("class_size"),
        "text_copies")


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Of each class the row with the least doc_id, with its own columns.

    Rows that repeat a doc_id stay or go together; rows without doc_id stay.
    """
    later = classes(docs, similarity).filter("doc_id <> class_id").select("doc_id").distinct()
    rest = docs.join(later.select(F.col("doc_id").alias("_later")), docs["doc_id"] == F.col("_later"), "left_anti")
    return rest
