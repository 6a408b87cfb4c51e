"""Benchmark decontamination by edit distance.

A document holds an item if a run of its words is within ``TOLERANCE`` edits
per item word of the item's words (word-level edit distance, lower-cased, split
at white space). Candidate runs are item-sized windows at every word of every
whole text. Their CGK embedding walks over a window: at each step it notes the
current word and moves on or stays, by a random bit of step and word, which
turns few edits into few differing steps. Each repetition has its own walk and
samples ``SAMPLED`` steps; windows and items that agree in the sampled words
meet. Those pairs are verified by the exact edit distance.

Walks that inserted or deleted words have moved apart take long to meet again,
so an item has a walk from each of several places, ``SEGMENT`` words long: of
the parts of a match one at least has no more than its share of the edits. A
meeting there stands for all starts that the edits allow.

Before the walks, windows are dropped that hold too few word runs of length q
of any item: e edits change at most q * e of an item's n - q + 1 runs, so a
match holds the others and is never lost.

The benchmark is the query set: it is read in blocks of bounded size, each
compared with all documents in one scan without a shuffle.

Defined cases: NULL texts are empty, empty texts and items match nothing; equal
items are reported each, repeated rows of an item once; repeated documents are
reported each; of overlapping matches of one item the closest is reported, then
the first; rows without an id are treated alike and carry NULL.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import WordHashes, grams, mixed, texts

TOLERANCE = 0.2
# With 32 repetitions of 2 sampled steps, items with 20 % of their words
# replaced, inserted or deleted are found with a probability over 0.99 (see tests).
REPETITIONS, SAMPLED = 32, 2
# Words of a walk, and between the places of an item where walks begin.
SEGMENT, APART = 16, 8
# Items of one pass over the documents, in characters.
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\S+")


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def edit_distances(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``windows``: the least edits that turn ``item`` into a prefix of it, and
    that prefix's length. Places past a text's end hold 0, which is no word."""
    n, width = windows.shape
    steps = np.arange(width + 1)
    row = np.tile(steps, (n, 1))
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (windows != word))
        # Insertions: the least of all cells to the left, plus the way from there.
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    row[:, 1:][windows == 0] = len(item) + width  # prefixes end inside the text
    ends = row.argmin(axis=1)
    return row[np.arange(n), ends], ends


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[str], tolerance: float = TOLERANCE, repetitions: int = REPETITIONS,
                 sampled: int = SAMPLED, seed: int = 11):
        self.hashes = WordHashes(most=10**9)  # the block's own words only
        self.items = [self.hashes.of(words(t)) for t in items]
        self.tolerance, self.repetitions, self.sampled, self.seed = tolerance, repetitions, sampled, seed
        self.known = dict(self.hashes)
        self.runs = {q: np.unique(np.concatenate([np.empty(0, np.uint64), *(
            grams(i, q) for i in self.items if len(i) >= q)])) for q in (1, 2, 3)}
        groups: dict[int, list[int]] = defaultdict(list)
        for i, item in enumerate(self.items):
            if len(item):
                # Lengths of a group differ by a tenth at most.
                groups[int(np.log(len(item)) / np.log(1.1)) if len(item) > 10 else -len(item)].append(i)
        self.groups = [self.table(g) for g in groups.values()]

    def table(self, group: list[int]) -> dict:
        sizes = [len(self.items[i]) for i in group]
        low, high = min(sizes), max(sizes)
        random = np.random.default_rng([self.seed, low])
        length = min(low, SEGMENT)
        plan = [np.sort(random.choice(2 * length, self.sampled, replace=2 * length < self.sampled)) for _ in range(self.repetitions)]
        edits = int(self.tolerance * high)
        q = next(q for q in (3, 2, 1) if low - q + 1 - q * edits >= 1 or q == 1)
        own = np.concatenate([grams(self.items[i], q) for i in group])
        width = min(high, 2 * length)  # a walk of so many steps ends there at most
        out = {"own": np.isin(self.runs[q], own), "width": width, "reach": high + edits, "q": q, "need": max(1, low - q + 1 - q * edits),
               "plan": plan, "keys": [], "met": []}
        begins = np.unique(np.linspace(0, low - length, -(-(low - length) // APART) + 1).astype(np.int64)).tolist()
        walks = [(i, begin) for i in group for begin in begins]
        block = np.zeros((len(walks), width), dtype=np.uint64)
        for r, (i, begin) in enumerate(walks):
            part = self.items[i][begin : begin + width]
            block[r, : len(part)] = part
        for n, steps in enumerate(plan):
            buckets = defaultdict(list)
            for walk, key in zip(walks, self.sample(block, n, steps).tolist(), strict=True):
                buckets[key].append(walk)
            out["keys"].append(np.array(sorted(buckets), dtype=np.uint64))
            out["met"].append([buckets[key] for key in sorted(buckets)])
        return out

    @staticmethod
    def sample(block: np.ndarray, repetition: int, steps: np.ndarray) -> np.ndarray:
        """Hash of the words at the sampled steps of the repetition's CGK walk over each row."""
        own = mixed(block + np.uint64(repetition + 1))
        rows, at = np.arange(len(block)), np.zeros(len(block), dtype=np.int64)
        wide = np.append(block, np.zeros((len(block), 1), dtype=np.uint64), axis=1)  # past the end: no word
        coins = np.append(own, np.zeros((len(block), 1), dtype=np.uint64), axis=1)
        key = np.zeros(len(block), dtype=np.uint64)
        for step in range(int(steps[-1]) + 1):
            if step and step % 64 == 0:
                coins = mixed(coins + np.uint64(step))
            for _ in range(int((steps == step).sum())):
                key = mixed(key + wide[rows, at] + np.uint64(1))
            move = (coins[rows, at] >> np.uint64(step % 64)) & np.uint64(1)
            at = np.minimum(at + move.astype(np.int64), block.shape[1])
        return key

    def find(self, batch: list[str | None], chars: int = 4_000_000) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item number, first word, end word, edits) of all matches; texts are taken
        together up to ``chars``, which bounds the memory of a step."""
        low = 0
        while low < len(batch):
            high, size = low, 0
            while high < len(batch) and (high == low or size + len(batch[high] or "") <= chars):
                size += len(batch[high] or "")
                high += 1
            for text, *match in self.find_in(batch[low:high]):
                yield (low + text, *match)
            low = high

    def find_in(self, batch: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        split = [words(t) for t in batch]
        sizes = np.array([len(s) for s in split], dtype=np.int64)
        ends = np.cumsum(sizes)
        known = self.known.get
        line = np.fromiter((known(w, 0) for s in split for w in s), dtype=np.uint64, count=int(sizes.sum()))
        del split
        owner = np.repeat(np.arange(len(sizes)), sizes)
        hits = {q: self.hits(line, owner, q) for q in {g["q"] for g in self.groups}}
        for group in self.groups:
            at, run = hits[group["q"]]
            starts = self.windows(group, at[group["own"][run]], owner)
            for cut in range(0, len(starts), 50_000):
                yield from self.matches(group, line, owner, ends, starts[cut : cut + 50_000])

    def hits(self, line: np.ndarray, owner: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a run of q words of some item begins, and which run."""
        runs = self.runs[q]
        at = np.nonzero(line[: max(0, len(line) - q + 1)] != 0)[0]
        for i in range(1, q):
            at = at[line[at + i] != 0]
        at = at[owner[at] == owner[at + q - 1]]
        found = np.zeros(len(at), dtype=np.uint64)
        for i in range(q):  # as grams() does
            found = mixed(found + line[at + i] + np.uint64(i + 1))
        place = np.minimum(np.searchsorted(runs, found), len(runs) - 1)
        same = runs[place] == found
        return at[same], place[same]

    @staticmethod
    def windows(group: dict, hits: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Starts of all windows that hold as many item runs as a match must have."""
        need, span = group["need"], group["reach"] - group["q"]
        if len(hits) < need:
            return hits[:0]
        first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        near = (last - first <= span) & (owner[first] == owner[last])
        first, last = first[near], last[near]
        low = np.maximum(np.maximum(last - span, 0), np.append(0, first[:-1] + 1))
        counts = np.maximum(first - low + 1, 0)
        starts = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return starts[owner[starts] == owner[np.repeat(first, counts)]]

    def matches(self, group: dict, line: np.ndarray, owner: np.ndarray, ends: np.ndarray,
                starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        # A walk begins at any word of a window.
        if not len(starts):
            return
        breaks = np.nonzero(np.diff(starts) > 1)[0]
        low, high = starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)]
        high = np.minimum(high + group["reach"], ends[owner[high]])
        walked = np.unique(np.concatenate([np.arange(x, y) for x, y in zip(low, high, strict=True)]))
        shifts = defaultdict(set)
        for cut in range(0, len(walked), 50_000):
            own_at = walked[cut : cut + 50_000]
            at = own_at[:, None] + np.arange(group["width"])
            block = np.where(at < ends[owner[own_at]][:, None], line[np.minimum(at, len(line) - 1)], 0)
            for n, (steps, keys, met) in enumerate(zip(group["plan"], group["keys"], group["met"], strict=True)):
                sampled = self.sample(block, n, steps)
                place = np.minimum(np.searchsorted(keys, sampled), len(keys) - 1)
                hit = np.nonzero(keys[place] == sampled)[0]
                for word, bucket in zip(own_at[hit].tolist(), place[hit].tolist(), strict=True):
                    for item, begin in met[bucket]:
                        shifts[item].add(word - begin)
        places = {}
        for item, own_shifts in shifts.items():
            most = int(self.tolerance * len(self.items[item]))
            own_shifts = np.array(sorted(own_shifts))
            low, high = np.searchsorted(starts, own_shifts - most), np.searchsorted(starts, own_shifts + most, side="right")
            low = np.maximum(low, np.append(0, high[:-1]))  # both rise
            own_starts = starts[np.concatenate([np.arange(x, y) for x, y in zip(low, high, strict=True)])]
            for part in np.split(own_starts, np.nonzero(np.diff(owner[own_starts]))[0] + 1):
                if len(part):
                    places[int(owner[part[0]]), item] = part
        found = defaultdict(list)
        for (text, item), own_starts in places.items():
            own, end = self.items[item], int(ends[text])
            size = len(own)
            most = int(self.tolerance * size)
            whole = own_starts[own_starts + size <= end]
            for start in whole[(line[whole[:, None] + np.arange(size)] == own).all(axis=1)].tolist():
                # An exact match wins over all that overlap it.
                if not found[text, item] or found[text, item][-1][2] <= start:
                    found[text, item].append((0, start, start + size))
            if exact := found[text, item]:
                # The first exact match that ends after a start must begin after the shortest match from it.
                after = np.searchsorted([stop for *_, stop in exact], own_starts, side="right")
                begins = np.append([start for _, start, _ in exact], len(line) + size)
                own_starts = own_starts[begins[after] >= own_starts + max(1, size - most)]
            for cut in range(0, len(own_starts), 2_000):
                near = own_starts[cut : cut + 2_000, None] + np.arange(size + most)
                windows = np.where(near < end, line[np.minimum(near, end - 1)], 0)
                # A match holds all but ``most`` of the item's words.
                enough = np.isin(windows, own).sum(axis=1) >= size - most
                if not enough.any():
                    continue
                # Unknown words differ from every item word; 1 stands for them, as 0 is the end.
                windows = np.where((windows == 0) & (near < end), 1, windows)[enough]
                edits, lengths = edit_distances(own, windows)
                for distance, length, start in zip(edits.tolist(), lengths.tolist(), near[enough, 0].tolist(), strict=True):
                    if distance <= most and length:
                        found[text, item].append((distance, start, start + length))
        for (text, item), spans in found.items():
            starts, stops = [], []
            before = int(ends[text - 1]) if text else 0
            for distance, start, end in sorted(spans):
                at = bisect_right(starts, start)
                if (not at or stops[at - 1] <= start) and (at == len(starts) or end <= starts[at]):
                    starts.insert(at, start)
                    stops.insert(at, end)
                    yield text, item, start - before, end - before, distance


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; equal rows once."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for i in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r["item_id"], r["text"]) for r in own.collect()]


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (code points of the text, end exclusive), edits, item_words of every match."""
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint, item_words bigint"
    source, out = texts(docs), None
    for block in blocks(benchmark):
        matcher = Matcher([t for _, t in block])
        ids = [i for i, _ in block]

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher, ids=ids) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = batch.column("text").to_pylist()
                doc_ids = batch.column("doc_id").to_pylist()
                rows = []
                for text, item, first, end, edits in matcher.find(whole):
                    spans = [m.span() for m in _WORD.finditer(whole[text])][first:end]
                    rows.append((doc_ids[text], ids[item], spans[0][0], spans[-1][1], edits, len(matcher.items[item])))
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "item_id", "start", "end", "edits", "item_words"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def holds(matcher: Matcher, text: Column) -> Column:
    """Whether a text holds an item of the block."""

    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.zeros(len(batch), dtype=bool)
            for at, *_ in matcher.find(batch.tolist()):
                out[at] = True
            yield pd.Series(out)

    return found(text)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their own columns."""
    for block in blocks(benchmark):
        docs = docs.filter(~holds(Matcher([t for _, t in block]), F.col("text")))
    return docs
