"""Phrase collocations: counts of all frequent word runs by vertical partitioning of their suffix tree.

The tree of all word suffixes, cut at ``LONGEST`` words, is divided by word
prefixes into groups that fit a memory budget; each group's subtree is built on
its own, and the count of a node is the total of the leaves below it.

1. Words are counted per language. A phrase is only as frequent as its rarest
   word, so a word below the minimum ends the suffixes that run into it. The test
   is a bit table of word hashes: where hashes meet it keeps a word too many, never
   one too few, so counts stay exact. Its size is bounded by ``WORD_BITS`` at any
   input; beyond it more is kept, which costs speed only.
2. Every remaining position gives a leaf, its suffix of up to ``LONGEST`` words;
   equal leaves of a block of texts are counted before they are shuffled, so that
   a passage of a third of all texts is one leaf a block.
3. The prefixes of two words fall into 2^``CELL_BITS`` hashed cells, whose weights
   are counted with the words. Cells are packed into groups up to the budget; a cell above
   it is spread over several groups by the rest of its leaves. A block's leaves of a group
   travel in one row, their words once and their paths as numbers, compressed.
4. A group's subtree is grown level by level in the memory that the budget bounds: the
   count of a node is the total of its leaves, and a node below the minimum has no children.
   Parts of spread cells are not cut; their totals meet in a last, small aggregation.
5. First parts and rests of all cuts are looked up by joins with the same counts.
   A phrase is covered by a longer one of the same count exactly if it is by one
   that is one word longer, as no phrase between them can have another count.

Arithmetic is on decimals of 38 digits and their whole quotients.

Defined cases: a NULL text is empty, a NULL lang is ``und``; a text without words
gives nothing; texts of any length are taken whole, in memory that grows with the
longest one; repeated rows count each, ids are not
read; ties go to the smaller cut and the smaller phrase in bytes; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import input_partitions, materialise, mixed
from segmentry.operators.topk import top_per_group

LONGEST = 5
MINIMUM = 100
TOP = 2000
BLOCK = 1_000_000
LONG = 8_000_000
WORD_BITS = 24
CELL_BITS = 16
BUDGET = 2_000_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)

#: Borders of pieces become a comma, tabs a space, capitals small letters.
ENDS = b".,;:!?\n\x0b\x0c\r"
SAME = bytes(
    44 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class Vocabulary(dict):
    """Numbers of the words seen, in order; 0 is the border."""

    def __init__(self):
        super().__init__({b",": 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found

    def numbers(self, text: bytes) -> np.ndarray:
        """Numbers of the lower-case words of a text; 0 for each border of pieces and before the first."""
        text = text.translate(SAME).replace(b",", b" , ")
        # Only spaces are left as white space. Long texts are not split into a list at once.
        words = text.split() if len(text) < LONG else (m.group() for m in re.finditer(rb"[^ ]+", text))
        return np.fromiter(map(self.__getitem__, chain((b",",), words)), np.int32)

    def hashes(self, lang: str) -> np.ndarray:
        """64 bits a word, over language and word."""
        seed = zlib.crc32(lang.encode()) << 31
        return mixed(np.fromiter((seed + zlib.crc32(w) + (len(w) << 40) for w in self), np.uint64, len(self)))


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, Vocabulary, np.ndarray]]:
    """Word numbers of whole texts of one language, ``size`` words or more at a time, and what is left at the end."""
    filling: dict[str, tuple[Vocabulary, list[np.ndarray]]] = {}
    filled: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            lang = lang.as_py()
            vocabulary, parts = filling.setdefault(lang, (Vocabulary(), []))
            parts.append(vocabulary.numbers(text.as_py()))
            filled[lang] += len(parts[-1])
            if filled[lang] >= size:
                del filling[lang], filled[lang]
                yield lang, vocabulary, np.concatenate(parts)
    for lang, (vocabulary, parts) in filling.items():
        yield lang, vocabulary, np.concatenate(parts)


def small(batch: pa.RecordBatch, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that no side of the exchange with Spark holds it twice."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


class Bits(NamedTuple):
    """A table of 2^``width`` bits, asked by the highest bits of a hash."""

    width: int
    words: np.ndarray

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.width)).astype(np.int64)

    def holds(self, slots: np.ndarray) -> np.ndarray:
        return (self.words[slots >> 6] >> (slots & 63)) & 1 == 1


def width(words: int) -> int:
    """Two bits a word or more, within bounds."""
    return min(max(words.bit_length() + 1, 6), WORD_BITS)


def bits(slots: DataFrame, width: int) -> Bits:
    """The table with the bits of column ``slot`` set; at most 2^(width - 6) rows reach the driver."""
    rows = slots.groupBy(F.expr("slot div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("set")).toArrow()
    words = np.zeros(1 << (width - 6), np.int64)
    words[rows["at"].to_numpy()] = rows["set"].to_numpy()
    return Bits(width, words)


def binary_texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def word_and_pair_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n of all words and, with a NULL word, cell, n of all word pairs, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, vocabulary, ids in blocks(batches, BLOCK):
            n = np.bincount(ids, minlength=len(vocabulary))[1:]
            yield from small(pa.RecordBatch.from_arrays([
                pa.array([lang] * len(n), pa.string()), pa.array(list(vocabulary)[1:], pa.binary()).cast(pa.string()),
                pa.nulls(len(n), pa.int64()), pa.array(n, pa.int64())], names=["lang", "word", "cell", "n"]))
            at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            cell, n = np.unique(cells(pair_hashes(ids, at, vocabulary.hashes(lang))), return_counts=True)
            yield from small(pa.RecordBatch.from_arrays([
                pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.string()), pa.array(cell), pa.array(n, pa.int64())],
                names=["lang", "word", "cell", "n"]))

    return rows.mapInArrow(run, "lang string, word string, cell bigint, n bigint")


def word_slots(words: DataFrame, width: int) -> DataFrame:
    """The slots of ``words`` in a table of 2^width bits, as ``Vocabulary.hashes`` puts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                vocabulary = Vocabulary()
                for word in batch.filter(pc.equal(batch.column("lang"), lang)).column("word").cast(pa.binary()).to_pylist():
                    vocabulary[word]
                yield from small(pa.RecordBatch.from_arrays([pa.array(Bits(width, None).slots(vocabulary.hashes(lang))[1:])], names=["slot"]))

    return words.select("lang", "word").mapInArrow(run, "slot bigint")


def pair_hashes(ids: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes[ids[at]] * SPREAD + hashes[ids[at + 1]])


def cells(pairs: np.ndarray) -> np.ndarray:
    return (pairs >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def packed(weights: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each cell: cells in a row share a group up to ``budget``, a heavier cell has several."""
    first, several = np.zeros(len(weights), np.int64), np.ones(len(weights), np.int64)
    group = load = 0
    for cell, weight in enumerate(weights.tolist()):
        if load and load + weight > budget:
            group, load = group + 1, 0
        first[cell] = group
        if weight > budget:
            several[cell] = -(-weight // budget)
            group, load = group + int(several[cell]), 0
        else:
            load += weight
    return first, several


def keys(columns: Iterable[np.ndarray], size: int) -> list[np.ndarray]:
    """Columns of numbers below ``size``, joined to as few columns of 63 bits as hold them, in the same order."""
    out, room = [], 1
    for column in columns:
        if out and room * size < 2**63:
            out[-1], room = out[-1] * size + column, room * size
        else:
            out.append(column.astype(np.int64))
            room = size
    return out


def shut(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def opened(held: bytes) -> bytes:
    return pa.decompress(held[8:], int.from_bytes(held[:8], "little"), "zstd", asbytes=True)


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def bundle(paths: np.ndarray, n: np.ndarray, words: list[bytes]) -> tuple[int, bytes, bytes, bytes]:
    """Number of leaves, their own words, their paths as numbers of these (0: none) by depth, and occurrences."""
    used, own = np.unique(np.append(0, paths), return_inverse=True)
    return len(n), shut(b" ".join([words[i] for i in used[1:]])), shut(narrow(own[1:].reshape(paths.shape).T)), shut(narrow(n))


def unbundled(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Paths, occurrences and words of the bundles of one group and language."""
    names = pc.split_pattern(pa.array([opened(r["words"]) for r in rows], pa.large_binary()), " ")
    of = pc.list_value_length(names).to_numpy()
    flat = names.flatten().dictionary_encode()
    number, low = flat.indices.to_numpy().astype(np.int32) + 1, 0
    paths, n = [], []
    for row, many in zip(rows, of, strict=True):
        raw, counted = opened(row["paths"]), opened(row["n"])
        leaves_ = row["leaves"]
        at = np.frombuffer(raw, f"u{len(raw) // (LONGEST * leaves_)}").reshape(LONGEST, leaves_)
        paths.append(np.append(np.int32(0), number[low : low + many])[at])
        n.append(np.frombuffer(counted, f"u{len(counted) // leaves_}").astype(np.int64))
        low += many
    return np.concatenate(paths, axis=1), np.concatenate(n), flat.dictionary


def leaves(rows: DataFrame, words: Bits, first: np.ndarray, several: np.ndarray) -> DataFrame:
    """group, whole (all leaves of its first two words are in the group), lang and the bundled leaves of a block in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, vocabulary, ids in blocks(batches, BLOCK):
            hashes = vocabulary.hashes(lang)
            known = words.holds(words.slots(hashes))
            known[0] = False
            ids = np.append(ids, np.zeros(LONGEST, np.int32))
            ok = known[ids]
            ok[:-1] &= ok[1:]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            pair = pair_hashes(ids, at, hashes)
            window, on = np.zeros((LONGEST, len(at)), np.int32), np.ones(len(at), bool)
            window[0], hashed = ids[at], pair.copy()
            for i in range(1, LONGEST):
                on &= ok[at + i - 1]
                window[i] = np.where(on, ids[at + i], 0)
                hashed = hashed * SPREAD + hashes[window[i]]
            path = keys(window, len(vocabulary))
            order = np.lexsort(path[::-1])
            new = np.append(True, np.zeros(len(at) - 1, bool))
            for key in path:
                key = key[order]
                new[1:] |= key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(at)))
            picked = order[starts]
            cell = cells(pair[picked])
            spread = several[cell]
            group = first[cell] + (mixed(hashed[picked]) % spread.astype(np.uint64)).astype(np.int64)
            by_group = np.argsort(group, kind="stable")
            group, picked, n, spread = group[by_group], picked[by_group], n[by_group], spread[by_group]
            lows = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            names, window = list(vocabulary), window.T
            highs = np.append(lows[1:], len(group))
            for part in range(0, len(lows), 64):
                some = slice(part, part + 64)
                held = [bundle(window[picked[low:high]], n[low:high], names) for low, high in zip(lows[some], highs[some], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(group[lows[some]]), pa.array(spread[lows[some]] == 1), pa.array([lang] * len(held), pa.string()),
                    *[pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)]],
                    names=["group", "whole", "lang", "leaves", "words", "paths", "n"])

    return rows.mapInArrow(
        run, "group bigint, whole boolean, lang string, leaves bigint, words binary, paths binary, n binary")


def subtree(rows: list[dict], minimum: int) -> Iterator[pa.RecordBatch]:
    """lang, phrase, n of the nodes of a group and language, level by level; below ``minimum`` a whole node has no children."""
    path, n, names = unbundled(rows)
    whole = rows[0]["whole"]
    parent = path[0].astype(np.int64)
    for depth in range(1, LONGEST):
        held = path[depth] > 0
        path, n, parent = path[:, held], n[held], parent[held]
        _, example, node = np.unique(parent * (len(names) + 1) + path[depth], return_index=True, return_inverse=True)
        total = np.zeros(len(example), np.int64)
        np.add.at(total, node, n)
        good = total >= minimum if whole else np.ones(len(total), bool)
        at, total = example[good], total[good]
        for low in range(0, len(at), 10_000):
            some = slice(low, low + 10_000)
            columns = [names.take(pa.array(path[i, at[some]] - 1)) for i in range(depth + 1)]
            phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" ", names.type)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["lang"]] * len(phrase), pa.string()), phrase, pa.array(total[some])], names=["lang", "phrase", "n"])
        held = good[node]
        path, n, parent = path[:, held], n[held], (np.cumsum(good) - 1)[node[held]]


def nodes(placed: DataFrame, minimum: int) -> DataFrame:
    """lang, phrase and the total of its leaves: whole totals from ``minimum`` on, and parts that others complete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["group"], row["lang"]) != (held[0]["group"], held[0]["lang"]):
                    yield from subtree(held, minimum)
                    held = []
                held.append(row)
        if held:
            yield from subtree(held, minimum)

    return placed.mapInArrow(run, "lang string, phrase string, n bigint")


def counts(docs: DataFrame, minimum: int = MINIMUM, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, n of all words) and (lang, phrase, f) of all runs of 1 to ``LONGEST`` words with f of ``minimum`` at least."""
    rows = binary_texts(docs)
    counted = materialise(word_and_pair_counts(rows), "words_and_pairs")
    words = materialise(counted.filter("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = words.filter(F.col("n") >= minimum)
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    table = bits(word_slots(known, w := width(size)), w)
    weights = np.zeros(1 << CELL_BITS, np.int64)
    by_cell = counted.filter("word is null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    weights[by_cell["cell"].to_numpy()] = by_cell["n"].to_numpy()
    first, several = packed(weights, budget)
    groups = max(int((first + several).max()), input_partitions(docs))
    # A group is its own partition.
    placed = leaves(rows, table, first, several).repartitionById(groups, F.col("group").cast("int")).sortWithinPartitions("group", "lang")
    found = nodes(placed, minimum).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    both = known.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")).unionByName(
        found.filter(F.col("f") >= minimum))
    return totals, materialise(both, "phrases")


def collocations(docs: DataFrame, minimum: int = MINIMUM, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of two words or more.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language;
    ``score`` is the whole part of 1000 a n / (l r).
    """
    totals, frequent = counts(docs, minimum, budget)
    words = F.split("phrase", " ")
    candidates = frequent.filter(F.size(words) > 1).withColumnRenamed("f", "a").withColumn("words", words)
    # The two runs that are one word shorter.
    covered = candidates.filter(F.size("words") > 2).select("lang", F.col("a").alias("f"), F.explode(F.array(
        F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("part")).select(
        "lang", F.array_join("part", " ").alias("phrase"), "f")
    kept = candidates.join(covered, (candidates["lang"] == covered["lang"]) & (candidates["phrase"] == covered["phrase"])
                           & (candidates["a"] == covered["f"]), "left_anti")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("rest"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole = lambda c: f"cast({c} as decimal(18, 0))"
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn(
        "score", F.expr(f"({whole('1000 * a')} * {whole('n')}) div ({whole('l')} * {whole('r')})"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select(
        "lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = top_per_group(weakest, ["lang"], order, top, name="rank", salt=F.col("phrase"))
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# Every run of 1 to 5 words as a row.
SQL = r"""
WITH lowered AS (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (SELECT lang, w[i : i + m - 1] AS run FROM lists, (SELECT unnest(range(1, 6)) AS m), unnest(range(1, len(w) - m + 2)) AS t(i)),
f AS (SELECT lang, array_to_string(run, ' ') AS phrase, len(run) AS m, count(*) AS f FROM runs GROUP BY lang, run),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100),
inside AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(f) AS longest
  FROM frequent, (SELECT unnest(range(2, 5)) AS k), unnest(range(1, m - k + 2)) AS t(i) WHERE k < m GROUP BY ALL),
kept AS (SELECT c.* FROM frequent c LEFT JOIN inside USING (lang, phrase) WHERE longest IS NULL OR longest < c.f),
cuts AS (SELECT kept.lang, kept.phrase, kept.f AS a, x.f AS l, y.f AS r, n, k,
  (CAST(1000 AS HUGEINT) * kept.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM kept JOIN totals USING (lang), unnest(range(1, m)) AS t(k), f x, f y
  WHERE x.lang = kept.lang AND x.phrase = array_to_string(w[1 : k], ' ') AND y.lang = kept.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
