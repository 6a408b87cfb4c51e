"""Language-model scores: exact add-half unigrams and a hashed maximum-entropy model.

Words fall into 256 buckets: the most frequent training words have one each,
all others share the rest by hash. A bucket is one of 16 classes and one of its
16 members. P(word | history) = P(class | history) * P(member | class, history)
* P(word | bucket): two log-linear models with a softmax over 16 outcomes each,
on hashed features of the history (last word, last two words, the word before
the last), and the smoothed share of the word in its bucket.

One pass tokenises the texts into batches, written once: word numbers in order,
and the batch's dictionary with its training counts. Dictionaries are dealt out
by word hash, summed, and the totals sent back to their batches, so no task
holds more than a share of the vocabulary. The model is trained by gradient
steps: each round takes its share of the training batches, tasks sum gradients
in sparse numpy batches, the sums are added up in levels of bounded groups, and
the driver, which holds the weights only, updates them. All training rows take
part in one round. A last pass scores all batches.

Defined cases: a NULL text is empty; an empty text is the end token alone; a
row without doc_id is held in; repeated rows count as often as they appear and
get a row each; without training rows the unigram part gives 0 for every token;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import fold, materialise, mixed, texts

HELD_OUT = 1
BATCH_TOKENS = 1_500_000
# Words of all dictionaries that one task sums.
WORDS_PER_TASK = 500_000
OUTCOMES = 16
OWN_BUCKETS, SHARED_BUCKETS = 192, 64
FEATURES, HASHED = 3, 8_192
ROUNDS, STEP, PRIOR_COUNT = 4, 1.5, 20.0
CHUNK = 65_536
END = b""


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, then the end."""
    out = text.encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


class Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokenised(docs: DataFrame) -> DataFrame:
    """One row for each batch: its documents, word numbers, dictionary and training counts."""

    def row(part: int, number: int, ids: list, held: list, ends: list, flat: list, known: Numbers) -> pa.RecordBatch:
        line = np.concatenate(flat)
        trained = np.repeat(~np.array(held), np.diff(ends, prepend=0))
        counts = np.bincount(line[trained], minlength=len(known))
        values = [(part << 32) + number, ids, held, np.array(ends, "<i4").tobytes(), line.astype("<i4").tobytes(),
                  b" ".join(known), counts.astype("<i4").tobytes(), len(known)]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    names = ["batch", "ids", "held", "ends", "line", "words", "counts", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, held, ends, flat, known = [], [], [], [], Numbers()
        for batch in (b.slice(i, 1_000) for b in batches for i in range(0, b.num_rows, 1_000)):
            for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text")), strict=True):
                words = tokens(text)
                flat.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
                ids.append(doc_id)
                held.append(out)
                ends.append((ends[-1] if ends else 0) + len(words))
                if ends[-1] >= BATCH_TOKENS:
                    yield row(part, number, ids, held, ends, flat, known)
                    number += 1
                    ids, held, ends, flat, known = [], [], [], [], Numbers()
        if ids:
            yield row(part, number, ids, held, ends, flat, known)

    out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return texts(docs).select("doc_id", out.alias("held"), "text").mapInArrow(
        run, "batch bigint, ids array<bigint>, held array<boolean>, ends binary, line binary, words binary, counts binary, n_words bigint")


def hashes(words: list[bytes]) -> np.ndarray:
    return mixed(np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words)))


def totals(batches: DataFrame) -> tuple[DataFrame, int]:
    """Training totals of each batch's words, by batch and part of the vocabulary, with each part's summary;
    and the number of parts.

    Columns: batch, part, totals (in the batch's order of the part's words) of kind 'back';
    part, words, totals (the most frequent), shared_n, shared_v (by shared bucket), n, v of kind 'part'.
    """
    parts = max(1, -(-(batches.agg(F.sum("n_words")).first()[0] or 0) // WORDS_PER_TASK))

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for batch, words, counts in zip(*(row.column(c).to_pylist() for c in ("batch", "words", "counts")), strict=True):
                words, counts = np.array(words.split(b" "), dtype=object), np.frombuffer(counts, "<i4")
                part = (hashes(words.tolist()) >> np.uint64(20)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
                for p in range(parts):
                    own = order[cuts[p] : cuts[p + 1]]
                    if len(own):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x]) for x in (batch, p, b" ".join(words[own]), counts[own].tobytes())],
                            ["batch", "part", "words", "counts"])

    schema = ("kind string, batch bigint, part bigint, words binary, totals binary, shared_n array<bigint>,"
              " shared_v array<bigint>, n bigint, v bigint")

    def total(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sums: dict[bytes, int] = {}
        for words, counts in zip(rows["words"], rows["counts"], strict=True):
            for word, count in zip(words.split(b" "), np.frombuffer(counts, "<i4").tolist(), strict=True):
                sums[word] = sums.get(word, 0) + count
        out = [("back", batch, key[0], None,
                np.array([sums[w] for w in words.split(b" ")], dtype="<i8").tobytes(), None, None, None, None)
               for batch, words in zip(rows["batch"], rows["words"], strict=True)]
        words = [w for w, c in sums.items() if c]
        counts = np.array([sums[w] for w in words], dtype=np.int64)
        shared = (hashes(words) % np.uint64(SHARED_BUCKETS)).astype(np.int64)
        top = np.lexsort((words, -counts))[:OWN_BUCKETS] if words else np.empty(0, np.int64)
        out.append(("part", None, key[0], b" ".join(words[i] for i in top), counts[top].astype("<i8").tobytes(),
                    np.bincount(shared, counts, SHARED_BUCKETS).astype(np.int64), np.bincount(shared, minlength=SHARED_BUCKETS),
                    int(counts.sum()), len(words)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    dealt = batches.select("batch", "words", "counts").mapInArrow(
        deal, "batch bigint, part bigint, words binary, counts binary")
    return dealt.groupBy("part").applyInPandas(total, schema), parts


class Model:
    """Bucket assignment, weights of both softmaxes, and the shares of the shared buckets."""

    def __init__(self, own: list[tuple[bytes, int]], shared_n: np.ndarray, shared_v: np.ndarray, n: int, v: int):
        self.n, self.v = n, v
        self.own = {word: i for i, (word, _) in enumerate(own)}
        for word, count in own:
            at = int(hashes([word])[0] % np.uint64(SHARED_BUCKETS))
            shared_n[at] -= count
            shared_v[at] -= 1
        # log10 of the weight that a bucket's words share; a word with a bucket of its own is all of it.
        self.log_share = np.log10(shared_n + 0.5 * (shared_v + 1))
        sizes = np.zeros(OUTCOMES * OUTCOMES)
        sizes[: len(own)] = [c for _, c in own]
        sizes[OWN_BUCKETS:] = shared_n
        sizes = (sizes + 0.01).reshape(OUTCOMES, OUTCOMES)
        self.class_bias = np.log(sizes.sum(axis=1) / sizes.sum()).astype(np.float32)
        self.member_bias = np.log(sizes / sizes.sum(axis=1, keepdims=True)).astype(np.float32)
        self.class_w = np.zeros((FEATURES * HASHED, OUTCOMES), dtype=np.float32)
        self.member_w = np.zeros((FEATURES * HASHED, OUTCOMES), dtype=np.float32)

    def buckets(self, words: list[bytes], hashed: np.ndarray) -> np.ndarray:
        out = OWN_BUCKETS + (hashed % np.uint64(SHARED_BUCKETS)).astype(np.int64)
        get = self.own.get
        for i, word in enumerate(words):
            if (own := get(word)) is not None:
                out[i] = own
        return out

    def features(self, hashed: np.ndarray, line: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes of the three features of each token's history within its text."""
        last = np.append(np.uint64(0), hashed[line[:-1]])
        last[starts] = 0
        before = np.append(np.uint64(0), last[:-1])
        before[starts] = 0
        return np.stack([mixed(last + np.uint64(1)), mixed(last + mixed(before + np.uint64(2))), mixed(before + np.uint64(3))])

    @staticmethod
    def places(features: np.ndarray, class_: np.ndarray | None = None) -> np.ndarray:
        """Row of the weights for each feature; the member model's features include the class."""
        own = features if class_ is None else mixed(features + (class_.astype(np.uint64) + np.uint64(7)))
        return (own % np.uint64(HASHED)).astype(np.int64) + HASHED * np.arange(FEATURES)[:, None]

    @staticmethod
    def logits(weights: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probabilities of the outcomes."""
        z = bias + weights[at[0]]
        for row in at[1:]:
            z += weights[row]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def chunks(self, words: list[bytes], line: np.ndarray, ends: np.ndarray):
        """(slice, class, member, both models' weight rows and log probabilities) in bounded pieces."""
        hashed = hashes(words)
        bucket = self.buckets(words, hashed)[line]
        starts = np.append(0, ends[:-1])
        features = self.features(hashed, line, starts)
        for low in range(0, len(line), CHUNK):
            part = slice(low, min(low + CHUNK, len(line)))
            class_, member = bucket[part] // OUTCOMES, bucket[part] % OUTCOMES
            at_c, at_m = self.places(features[:, part]), self.places(features[:, part], class_)
            yield (part, class_, member, at_c, self.logits(self.class_w, self.class_bias, at_c), at_m,
                   self.logits(self.member_w, self.member_bias[class_], at_m))

    def gradient(self, words: list[bytes], line: np.ndarray, ends: np.ndarray, used: np.ndarray, sums: np.ndarray,
                 counts: np.ndarray) -> None:
        """Add the log-likelihood's gradient of the used tokens, and the features' counts, to the sums."""
        spread = np.arange(OUTCOMES)
        for part, class_, member, at_c, log_c, at_m, log_m in self.chunks(words, line, ends):
            own = np.nonzero(used[part])[0]
            for model, (outcome, at, log_p) in enumerate(((class_, at_c, log_c), (member, at_m, log_m))):
                slope = -np.exp(log_p[own])
                slope[np.arange(len(own)), outcome[own]] += 1
                flat = slope.ravel()
                for f in range(FEATURES):
                    rows = at[f, own] - f * HASHED
                    block = slice(f * HASHED, (f + 1) * HASHED)
                    sums[model, block] += np.bincount(
                        (rows[:, None] * OUTCOMES + spread).ravel(), flat, HASHED * OUTCOMES).reshape(HASHED, OUTCOMES)
                    counts[model, block] += np.bincount(rows, minlength=HASHED)

    def step(self, sums: np.ndarray, counts: np.ndarray) -> None:
        """A gradient step, scaled by how often each feature was seen."""
        scale = STEP / (counts[..., None] + PRIOR_COUNT)
        self.class_w += (scale[0] * sums[0]).astype(np.float32)
        self.member_w += (scale[1] * sums[1]).astype(np.float32)

    def score(self, words: list[bytes], line: np.ndarray, ends: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """log10 probability of each token, given its word's training total."""
        out = np.empty(len(line))
        hashed = hashes(words)
        bucket = self.buckets(words, hashed)
        shared = bucket >= OWN_BUCKETS
        within = np.zeros(len(words))
        within[shared] = np.log10(totals[shared] + 0.5) - self.log_share[bucket[shared] - OWN_BUCKETS]
        for part, class_, member, _, log_c, _, log_m in self.chunks(words, line, ends):
            at = np.arange(len(class_))
            out[part] = (log_c[at, class_].astype(np.float64) + log_m[at, member]) / np.log(10)
        return out + within[line]


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, as a row holds a whole batch of documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def unpacked(row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    return row["words"].split(b" "), np.frombuffer(row["line"], "<i4").astype(np.int64), np.frombuffer(row["ends"], "<i4").astype(np.int64)


def summed(parts: DataFrame, width: int = 32) -> list[np.ndarray]:
    """Sum of the 'values' of all rows by 'slice': groups of at most ``width`` rows, level by level."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = [np.frombuffer(v, "<f8") for v in rows["values"]]
        return pd.DataFrame([(key[0], key[1], np.sum(values, axis=0).astype("<f8").tobytes())], columns=["slice", "at", "values"])

    n = parts.agg(F.max("at")).first()[0]
    while n is not None and n > 0:
        parts = materialise(parts.groupBy("slice", F.expr(f"`at` div {width}").alias("at")).applyInPandas(
            add, "slice bigint, at bigint, values binary"), "gradient")
        n //= width
    return [np.frombuffer(r["values"], "<f8") for r in parts.orderBy("slice").collect()]


def train(batches: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """One step for each round, on the batches of that round."""
    size, slices = FEATURES * HASHED, 8

    for number in range(rounds):
        def run(rows: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            sums, counts, any_ = np.zeros((2, size, OUTCOMES)), np.zeros((2, size)), False
            for row in each(rows):
                words, line, ends = unpacked(row)
                model.gradient(words, line, ends, np.repeat(~np.array(row["held"]), np.diff(ends, prepend=0)), sums, counts)
                any_ = True
            if any_:
                whole = np.concatenate([sums, counts[..., None]], axis=2).reshape(slices, -1)
                part = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(slices), pa.int64()), pa.array([part] * slices, pa.int64()),
                     pa.array([w.astype("<f8").tobytes() for w in whole], pa.binary())], ["slice", "at", "values"])

        share = batches.filter(F.pmod(F.xxhash64("batch"), F.lit(rounds)) == number)
        parts = materialise(share.select("held", "ends", "line", "words").mapInArrow(
            run, "slice bigint, at bigint, values binary"), "gradient")
        found = summed(parts)
        if found:
            whole = np.concatenate(found).reshape(2, size, OUTCOMES + 1)
            model.step(whole[..., :OUTCOMES], whole[..., OUTCOMES])
    return model


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    batches = materialise(tokenised(docs), "tokenised")
    counted, parts = totals(batches)
    counted = materialise(counted, "totals")
    # One row for each part of the vocabulary, with its most frequent words; the parts' sums are small.
    summary = counted.filter("kind = 'part'")
    n, v = summary.agg(F.sum("n"), F.sum("v")).first()
    shared = summary.select(F.posexplode(F.arrays_zip("shared_n", "shared_v")).alias("at", "x")).groupBy("at").agg(
        F.sum("x.shared_n").alias("n"), F.sum("x.shared_v").alias("v")).collect()  # one row for each shared bucket
    sizes = np.zeros((2, SHARED_BUCKETS), dtype=np.int64)
    for r in shared:
        sizes[:, r["at"]] = r["n"], r["v"]

    def frequent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for words, counts in zip(row.column("words").to_pylist(), row.column("totals").to_pylist(), strict=True):
                counts = np.frombuffer(counts, "<i8")
                words = words.split(b" ") if len(counts) else []
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["word", "n"])

    own = summary.select("words", "totals").mapInArrow(frequent, "word binary, n bigint").orderBy(
        F.desc("n"), "word").limit(OWN_BUCKETS).collect()
    model = train(batches, Model([(bytes(r["word"]), r["n"]) for r in own], sizes[0], sizes[1], n or 0, v or 0))
    weight = float(np.log10(model.n + 0.5 * (model.v + 1)))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(rows):
            words, line, ends = unpacked(row)
            # The totals came back by part of the vocabulary, each in the dictionary's order.
            part = (hashes(words) >> np.uint64(20)) % np.uint64(parts)
            total = np.empty(len(words), dtype=np.int64)
            for back in row["back"]:
                total[part == back["part"]] = np.frombuffer(back["totals"], "<i8")
            starts = np.append(0, ends[:-1])
            base = np.add.reduceat(np.log10(total + 0.5)[line], starts) - weight * (ends - starts)
            known = np.add.reduceat((total > 0)[line].astype(np.int64), starts)
            own = np.add.reduceat(model.score(words, line, ends, total), starts)
            k = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(row["held"]), pa.array(ends - starts), pa.array(known),
                 pa.array([model.n] * k, pa.int64()), pa.array(base), pa.array(own)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    back = counted.filter("kind = 'back'").groupBy("batch").agg(F.collect_list(F.struct("part", "totals")).alias("back"))
    return batches.select("batch", "ids", "held", "ends", "line", "words").join(back, "batch").drop("batch").mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
