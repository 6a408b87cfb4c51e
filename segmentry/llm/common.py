"""What several operators of this subpackage share."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.sources.storage import materialise  # noqa: F401 - used by the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rank_file() -> str:
    """The rank file of the registered query and the pipeline; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (NULL text: empty), so that no other column can clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def input_partitions(df: DataFrame, at_least: int = 1) -> int:
    """Shuffle partitions set for the session, the width of every wide step."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; of all words, if there are fewer."""
    n = min(n, len(words))
    if not n:
        return words
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = mixed(out + words[i : len(words) - n + 1 + i] + np.uint64(i + 1))
    return out
