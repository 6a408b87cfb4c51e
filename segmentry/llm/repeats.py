"""Removal of repeated text by hashing lines, their sentences, and runs of words.

A text's units are its lines, cut at sentence ends after ``UNIT_WORDS`` words or
more, so that a passage that begins or ends inside a line still shares its inner
units. In scripts without spaces each character counts as a word. A unit is normalised
(lower case, single spaces) and digested with 128 bits; the digests are grouped
over the whole corpus, each keeps its earliest occurrence by doc_id, row and
place, and every other occurrence is a repeat. Adjacent repeats of a text form
one run. Offsets are those of the original text.

Passages that are cut at other sentence ends, or at none, are found by their
runs of ``GRAM_WORDS`` words: one begins where the hash of two words is the least
of its neighbourhood, so equal words begin equal runs wherever they stand. Their
digests are treated as those of units; repeats that touch or overlap are one passage.

First occurrences are pre-aggregated minima that are joined back, so a line
that a third of all texts holds is never gathered in one task.

Defined cases: NULL and empty texts have no units; rows with a NULL doc_id rank
first; of repeated rows one stays whole and the others are repeats throughout;
other columns are ignored, or kept by ``deduplicated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import WordHashes, materialise, mixed, texts

# A repeated line is a repeat however short it is.
MIN_WORDS = 1
# Words of a sentence that is a unit of its own.
UNIT_WORDS = 5
# Words of a run inside passages, and the words on either side that its place is chosen among.
GRAM_WORDS, AROUND = 20, 4
# Thai, Lao, Burmese, Khmer, Japanese and Chinese are written without spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_CUT = re.compile(r"[.!?]+(?=\s)|[\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u1362\u104b\u17d4]+[\u300d\u300f\u201d\u2019\uff09]*|\n")
_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")
SENTENCE, LINE, PASSAGE = range(3)


def size(part: str, words: list[str]) -> int:
    return len(words) if part.isascii() else len(_TOKEN.findall(part))


def units(text: str) -> Iterator[tuple[int, int, int, bytes, int]]:
    """(start, end, words, digest, SENTENCE or LINE) of each unit that has a word."""
    low = 0
    for high in [*(m.end() for m in _CUT.finditer(text)), len(text)]:
        part = text[low:high]
        words = part.lower().split()
        count = size(part, words)
        ends = high == len(text) or text[high - 1] == "\n"
        if count < UNIT_WORDS and not ends:
            continue
        if words:
            kind = LINE if ends and (low == 0 or text[low - 1] == "\n") else SENTENCE
            start = low + len(part) - len(part.lstrip())
            digest = blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield start, start + len(part.strip()), count, digest, kind
        low = high


def grams(texts_: list[str], hashes: WordHashes) -> tuple[np.ndarray, ...]:
    """(text number, word number, start, end, digest's halves) of the runs of ``GRAM_WORDS`` words."""
    spans = [[m.span() for m in _TOKEN.finditer(t)] for t in texts_]
    n = np.array([len(s) for s in spans], dtype=np.int64)
    owner, ends = np.repeat(np.arange(len(n)), n), np.cumsum(n)
    words = hashes.of([t[x:y].lower() for t, own in zip(texts_, spans, strict=True) for x, y in own])
    starts, stops = np.array([x for own in spans for x in own], dtype=np.int64).reshape(-1, 2).T
    most = np.uint64(2**64 - 1)
    after = np.append(words[1:], np.uint64(0))
    after[ends[n > 0] - 1] = 0  # pairs and neighbourhoods end with the text
    pair = mixed(words + mixed(after + np.uint64(1)))
    least = pair.copy()
    for d in range(1, min(AROUND, len(pair) - 1) + 1):
        same = owner[d:] == owner[:-d]
        least[d:] = np.minimum(least[d:], np.where(same, pair[:-d], most))
        least[:-d] = np.minimum(least[:-d], np.where(same, pair[d:], most))
    at = np.nonzero(pair == least)[0]
    at = at[at + GRAM_WORDS <= ends[owner[at]]]
    high, low = np.zeros(len(at), dtype=np.uint64), np.ones(len(at), dtype=np.uint64)
    for i in range(GRAM_WORDS):
        high = mixed(high + words[at + i] + np.uint64(i + 1))
        low = mixed((low ^ words[at + i]) + np.uint64(i + 1))
    begins = ends - n
    return (owner[at], at - begins[owner[at]], starts[at], stops[at + GRAM_WORDS - 1] if len(at) else at,
            high.view(np.int64), low.view(np.int64))


def all_units(rows: DataFrame, fine: bool = False) -> DataFrame:
    """Units of rows (row, doc_id, text), numbered within each; with ``fine`` runs of words too, with their word numbers."""
    names = ["row", "doc_id", "seq", "start", "end", "words", "high", "low", "unit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for batch in (whole.slice(i, 1_000) for i in range(0, whole.num_rows, 1_000)):
                own = batch.column("text").to_pylist()
                found = [list(units(t)) for t in own]
                n = [len(f) for f in found]
                flat = [u for f in found for u in f]
                digest = np.frombuffer(b"".join(u[3] for u in flat), dtype="<i8").reshape(-1, 2)
                at = pa.array(np.repeat(np.arange(len(n)), n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(at), batch.column("doc_id").take(at),
                     pa.array([i for k in n for i in range(k)], pa.int32()),
                     *[pa.array([u[i] for u in flat], pa.int32()) for i in range(3)],
                     pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array([u[4] for u in flat], pa.int32())], names)
                if fine:
                    at, seq, start, end, high, low = grams(own, hashes)
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(at), batch.column("doc_id").take(at),
                         *[pa.array(c, pa.int32()) for c in (seq, start, end, np.full(len(seq), GRAM_WORDS))],
                         pa.array(high), pa.array(low), pa.array(np.full(len(seq), PASSAGE), pa.int32())], names)

    return rows.select("row", "doc_id", "text").mapInArrow(
        run, "row bigint, doc_id bigint, seq int, start int, end int, words int, high bigint, low bigint, unit int")


def runs(rows: DataFrame, min_words: int = MIN_WORDS, fine: bool = False) -> DataFrame:
    """row, doc_id, start, end, words, units, kept_doc_id, kept_start, kind of each run to remove.

    The kept occurrence is that of the run's first unit. The kind is 'line' if a whole line is in the run,
    else 'sentence', or 'passage' for runs of words that are not inside another run.
    """
    found = materialise(all_units(rows, fine), "units")
    place = F.struct("doc_id", "row", "seq", "start")
    first = found.groupBy("high", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written, so that both sides of the join are plain exchanges, which the planner splits where a digest is hot.
    first = materialise(first.select("high", "low", "first"), "first")
    passage = F.col("unit") == PASSAGE
    # Runs of words that overlap their first occurrence are no repeats of it.
    apart = F.when(passage, F.col("seq") >= F.col("first.seq") + GRAM_WORDS).otherwise(F.col("seq") != F.col("first.seq"))
    # All units are shuffled here, so they leave their doc_id behind and carry small numbers.
    light = found.select("row", "seq", "start", (F.col("end") - F.col("start")).alias("length"),
                         (F.col("words").cast("bigint") * 4 + F.col("unit")).alias("sized"), "high", "low")
    repeats = light.join(first, ["high", "low"]).select(
        "row", "seq", "start", (F.col("start") + F.col("length")).alias("end"), F.shiftright("sized", 2).alias("words"),
        F.col("sized").bitwiseAND(3).cast("int").alias("unit"), "first").filter((F.col("row") != F.col("first.row")) | apart)
    # Neighbours have equal differences of unit number and place among the text's repeats; runs of words touch.
    by_row = Window.partitionBy("row", passage).orderBy("seq")
    opens = F.coalesce(F.col("seq") > F.lag("seq").over(by_row) + F.when(passage, GRAM_WORDS).otherwise(1), F.lit(True))
    marked = repeats.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(by_row))
    islands = marked.groupBy("row", passage.alias("passage"), "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.when(F.first("unit") == PASSAGE, F.max("seq") - F.min("seq") + GRAM_WORDS).otherwise(F.sum("words")).cast("bigint").alias("words"),
        F.count(F.lit(1)).alias("units"), F.min(F.struct("seq", "first")).alias("head"), F.max("unit").alias("unit"),
    ).filter(F.col("words") >= min_words)
    if fine:
        # Runs of units do not overlap, so the one that reaches furthest of those before a passage holds it, if any does.
        before = Window.partitionBy("row").orderBy("start", "passage").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reach = F.max(F.when(~F.col("passage"), F.col("end"))).over(before)
        islands = islands.withColumn("reach", reach).filter(~F.col("passage") | F.col("reach").isNull() | (F.col("end") > F.col("reach")))
    kinds = F.array(F.lit("sentence"), F.lit("line"), F.lit("passage"))
    owners = found.groupBy("row").agg(F.min("doc_id").alias("doc_id"))
    return islands.join(owners, "row").select(
        "row", "doc_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "words", "units",
        F.col("head.first.doc_id").alias("kept_doc_id"), F.col("head.first.start").cast("bigint").alias("kept_start"), kinds[F.col("unit")].alias("kind"))


def numbered(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("row", F.monotonically_increasing_id())


def find(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each run of repeated units: doc_id, start, end, words, units, kept_doc_id, kept_start, kind."""
    return runs(numbered(docs), min_words).drop("row")


def find_all(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``find`` and the repeated passages that are not inside one of them; the two may overlap."""
    return runs(numbered(docs), min_words, fine=True).drop("row")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the same rows and columns, its texts without the removed runs; a NULL text stays."""
    # Written once, so that the row numbers hold for both readings.
    pinned = materialise(docs.select(F.struct("*").alias("own"), F.monotonically_increasing_id().alias("row")), "pinned")
    rows = pinned.select("row", F.col("own.doc_id").cast("bigint").alias("doc_id"), F.coalesce("own.text", F.lit("")).alias("text"))
    spans = runs(rows, min_words, fine=True).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, removed, strict=True):
            if spans is not None:
                low, kept = 0, []
                for span in spans:
                    kept.append(t[low : span["start"]])
                    low = max(low, span["end"])
                t = "".join([*kept, t[low:]])
            out.append(t)
        return pd.Series(out)

    return pinned.join(spans, "row", "left").select(
        *[(cut("own.text", "spans") if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
