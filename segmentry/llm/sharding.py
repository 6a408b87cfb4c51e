"""Shards cut from a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits, the cell's place on the Hilbert
curve is computed on whole columns, rows are range-partitioned and
sorted by that place, and equal runs of the order are the shards. Neighbours on
the curve are neighbours in all dimensions, so the files of a shard have narrow
ranges in each of them and readers prune by any. The law is ``rows``: shard
sizes differ by one row at most.

The order is curve place, then text checksum and doc_id: equal texts, which are
equal in every dimension taken from the text, lie next to each other.

A global rank is a row's place in its partition plus the rows of the lower
partitions. Those counts are a table of one row for each partition, whose
number is a session setting, and are joined back.

Defined cases: a NULL text has 0 bytes and the checksum of the empty text, NULL
metadata is a value of its own, a NULL doc_id sorts first, repeated rows get
slots of their own, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import input_partitions, materialise

BITS = 10
SHARDS = 8


def places(axes: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of cells given by integer axes of ``bits`` bits each.

    Skilling's construction: undo excess work from the highest bit down, Gray-encode, interleave.
    """
    if not axes or bits * len(axes) > 62:
        raise ValueError("1 axis at least and 62 bits at most")
    x = [np.array(a, dtype=np.int64) for a in axes]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            hit = (x[i] >> bit) & 1 == 1
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(hit, low, swap if i else 0)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << 1) | (((axis ^ turn) >> bit) & 1)
    return out


def hilbert(axes: list[Column], bits: int = BITS) -> Column:
    @F.pandas_udf("bigint")
    def place(*columns: pd.Series) -> pd.Series:
        return pd.Series(places([c.to_numpy() for c in columns], bits))

    return place(*axes)


def levels(number: Column, bits: int = BITS) -> Column:
    """A non-negative number on a logarithmic scale of 2^bits levels up to 2^40."""
    level = F.floor(F.log2(F.greatest(number, F.lit(0)) + 1) * ((1 << bits) / 40.0))
    return F.coalesce(F.least(level, F.lit((1 << bits) - 1)), F.lit(0))


def bucket(value: Column, bits: int = BITS) -> Column:
    """A category as one of 2^bits cells by its hash; NULL is a category."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit("\0"))), F.lit(1 << bits))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and curve place of every row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), *[
            bucket(F.col(c)).alias(c) if c in docs.columns else F.lit(0).alias(c) for c in ("lang", "source")])
    return narrow.select("doc_id", "size", "text_crc32", hilbert([levels(F.col("size")), F.col("lang"), F.col("source")]).alias("curve"))


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, … over all rows in key order, ties by row; and ``total``, the row count."""
    # Written before the range sample is drawn, so that both passes see the same rows.
    pinned = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "pinned")
    placed = materialise(
        pinned.repartitionByRange(input_partitions(df), *keys, "_row").sortWithinPartitions(*keys, "_row").select(
            *df.columns, F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), "placed")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each partition.
    before = sizes.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"),
                          F.sum("_rows").over(Window.partitionBy()).alias("total"))
    return placed.join(F.broadcast(before), "_part").select(
        *df.columns, (F.col("_before") + F.col("_at")).alias(name), "total")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve place of every row."""
    order = ranked(keyed(docs), ["curve", "text_crc32", "doc_id"], "rank")
    return order.withColumn(
        "shard", F.expr(f"cast(rank * {shards} div total as int)")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        # The shard's first rank is ceil(shard * total / shards).
        (F.col("rank") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as ``shards`` folders of files sorted by the curve, for pruning by any dimension.

    Rows of one doc_id and text go to that pair's first shard.
    """
    where = assign(docs, shards).groupBy(F.col("doc_id").alias("_id"), "text_crc32", "size").agg(
        F.min("shard").alias("shard"), F.min("curve").alias("_curve"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = docs.withColumns({"_crc": F.crc32(text), "_size": (F.octet_length(text) + 1).cast("bigint")})
    joined = whole.join(where, whole["doc_id"].eqNullSafe(where["_id"]) & (whole["_crc"] == where["text_crc32"])
                        & (whole["_size"] == where["size"]))
    joined.repartitionByRange(input_partitions(docs), "shard", "_curve").sortWithinPartitions("shard", "_curve").select(
        *[whole[c] for c in docs.columns], "shard").write.partitionBy("shard").parquet(path)
