"""Exact top-k by inner product without random access.

Per dimension a block of vectors has one list, sorted by that component. A
query reads the list of each of its non-zero components in step, from the end
that gives the best products. For every vector seen so far it keeps the sum of
the products read; plus the worst value of each list where the vector was not
met, this is a lower bound of its score, plus the last value read of those
lists an upper bound. When the k-th best lower bound is above the bound of a
vector that no list has shown yet, outsiders can't qualify: reading stops, and
the vectors seen whose upper bound reaches the k-th lower one are resolved.
Depths double. Vectors that no list has shown are never looked at.

Queries are a stated share of the rows and meet all rows in blocks. Row blocks
are shuffled once; the queries, the small side, are copied to each block and
stream past its lists, so a task holds one block and one batch of queries. A
query and block send k rows on.

Defined cases: vectors that are NULL, or hold NULL or non-finite components,
or have no id take no part; rows that repeat an id are vectors and queries of
their own, and only a query's own row is no candidate of it; a shorter vector
is filled up with zeros, so an empty one scores 0; ties go to the smaller id;
scores are computed in whole numbers beyond the exact range of floats; no
table rows, no result rows; other columns are ignored; very long vectors are
held one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import input_partitions, materialise

K = 5
BLOCK_ROWS, SIDE_BY_SIDE = 8_192, 64


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, v array<bigint>): floor(scale * x) of every component of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


def stacked(rows: list[np.ndarray], width: int) -> np.ndarray:
    """The vectors as rows of ``width`` components, filled up with zeros or cut: what a block lacks is 0 there."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row[:width]
    return out


def exact_type(x: np.ndarray, q: np.ndarray) -> type:
    """A type in which all sums of products and of their bounds are exact."""
    most = int(np.abs(x.astype(object)).max(initial=0)) * int(np.abs(q.astype(object)).sum(axis=1).max(initial=0)) if x.size and q.size else 0
    return np.float32 if most < 2**22 else np.float64 if most < 2**51 else object


class Block:
    """The sorted lists of a block of vectors."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray):
        self.rows, self.ids, self.x = rows, ids, x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)

    def best(self, queries: np.ndarray, own_rows: np.ndarray | None = None, k: int = K) -> list[tuple[list[tuple[int, int]], int]]:
        """For each query (id, score) of the k best vectors but its own row, and how many values it read.

        Queries read side by side: one that needs the upper end of a list takes no gain from its lower end.
        """
        (n, width), out = self.x.shape, [([], 0)] * len(queries)
        if not n or not len(queries):
            return out
        kind = exact_type(self.x, queries)
        values, q = self.sorted.astype(kind), queries.T.astype(kind)
        other = np.ones((n, len(queries)), dtype=bool) if own_rows is None else self.rows[:, None] != own_rows[None, :]
        # The two directions of every list: the order of reading, and the weights of the queries that read so.
        ways = [(self.order[::-1], values[::-1], np.maximum(q, 0)), (self.order, values, np.minimum(q, 0))]
        seen = [np.zeros((n, width), dtype=bool) for _ in ways]
        low = np.zeros((n, len(queries)), dtype=kind) + sum((v[-1][:, None] * w).sum(axis=0) for _, v, w in ways)
        open_, depth, step = np.arange(len(queries)), 0, max(k, n // 64)
        while len(open_):
            end = min(depth + step, n)
            for (order, v, w), met in zip(ways, seen, strict=True):
                at = order[depth:end], np.arange(width)
                met[at] = True
                # What the lists show in this step, added for all queries at once.
                fresh = np.zeros((n, width), dtype=kind)
                fresh[at] = v[depth:end] - v[-1]
                shown_now = np.nonzero(fresh.any(axis=1))[0]
                low[shown_now] += fresh[shown_now] @ w[:, open_]
            depth, step = end, step * 2
            shown = sum(met.astype(np.float32) @ (w[:, open_] != 0).astype(np.float32) for (_, _, w), met in zip(ways, seen, strict=True))
            room = [(v[depth - 1] - v[-1])[:, None] * w[:, open_] for _, v, w in ways]
            high = low + sum((~met).astype(kind) @ r for r, met in zip(room, seen, strict=True))
            # No vector that stays unseen can pass this.
            unseen = sum((v[depth - 1][:, None] * w[:, open_]).sum(axis=0) for _, v, w in ways)
            lists, left = np.count_nonzero(q[:, open_], axis=0), []
            for i, query in enumerate(open_.tolist()):
                met = np.nonzero(((shown[:, i] > 0) | (depth == n)) & other[:, query])[0]
                kth = np.sort(low[met, i])[len(met) - k] if len(met) >= k else None
                if depth < n and (kth is None or unseen[i] >= kth):
                    left.append(i)
                    continue
                # Equal bounds may still win by a smaller id.
                chosen = met if kth is None else met[high[met, i] >= kth]
                scores = self.x[chosen].astype(kind) @ q[:, query]
                found = sorted(zip((-scores).tolist(), self.ids[chosen].tolist(), strict=True))[:k]
                read = depth * int(lists[i]) + int((lists[i] - shown[chosen, i]).sum())
                out[query] = [(int(a), -int(b)) for b, a in found], read
            open_, low = open_[left], low[:, left]
        return out


def candidates(vectors: DataFrame, every: int = 50, k: int = K, scale: int = 256) -> DataFrame:
    """query_row, query_id, row_block, vec_id, score, n_read, n_values: each query's k best rows of each block,
    the values read for them and those of the block."""
    rows = materialise(quantised(vectors, scale), "vectors")
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    own = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("row_block"), F.lit(False).alias("asked"), "row", "vec_id", "v")
    asked = rows.filter(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("row_block"),
        F.lit(True).alias("asked"), "row", "vec_id", "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, block = None, [], None
        for batch in batches:
            out = []
            for (key, is_query), part in batch.groupby(["row_block", "asked"], sort=True):
                if key != at:
                    at, parts, block = key, [], None
                if not is_query:
                    parts.append(part)
                    continue
                if block is None:
                    whole = pd.concat(parts) if parts else part.iloc[:0]
                    block = Block(whole["row"].to_numpy(), whole["vec_id"].to_numpy(), stacked(list(whole["v"]), max([0, *whole["v"].map(len)])))
                    parts = []
                queries = stacked(list(part["v"]), block.x.shape[1])
                for low in range(0, len(part), SIDE_BY_SIDE):
                    few = part.iloc[low : low + SIDE_BY_SIDE]
                    found = block.best(queries[low : low + SIDE_BY_SIDE], few["row"].to_numpy(), k)
                    out += [(row, query_id, key, i, s, read, block.x.size)
                            for row, query_id, (best, read) in zip(few["row"], few["vec_id"], found, strict=True) for i, s in best]
            yield pd.DataFrame(out, columns=["query_row", "query_id", "row_block", "vec_id", "score", "n_read", "n_values"])

    width = min(4 * blocks, input_partitions(rows))
    # A block's rows come before its queries.
    return own.unionByName(asked).repartition(width, "row_block").sortWithinPartitions("row_block", "asked").mapInPandas(
        run, "query_row bigint, query_id bigint, row_block bigint, vec_id bigint, score bigint, n_read bigint, n_values bigint")


def search(vectors: DataFrame, every: int = 50, k: int = K, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible by ``every``."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return candidates(vectors, every, k, scale).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def reading(vectors: DataFrame, every: int = 50, k: int = K, scale: int = 256) -> DataFrame:
    """query_id, n_read, n_values: how many values each query read, of all there are."""
    of_block = candidates(vectors, every, k, scale).groupBy("query_row", "query_id", "row_block").agg(
        F.max("n_read").alias("n_read"), F.max("n_values").alias("n_values"))
    return of_block.groupBy("query_row", "query_id").agg(F.sum("n_read").alias("n_read"), F.sum("n_values").alias("n_values")).drop("query_row")


SQL = """
WITH numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), raw AS (
  SELECT n, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM numbered
), bad AS (
  SELECT DISTINCT n FROM raw WHERE x IS NULL OR NOT isfinite(x)
), parts AS (
  SELECT n, vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM raw WHERE n NOT IN (SELECT n FROM bad)
  -- A component for all, so that empty vectors score 0.
  UNION ALL SELECT n, vec_id, 0, 0 FROM numbered WHERE n NOT IN (SELECT n FROM bad)
), scores AS (
  SELECT q.n AS query, q.vec_id AS query_id, c.n, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.n <> c.n
  WHERE q.vec_id % 50 = 0
  GROUP BY 1, 2, 3, 4
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
