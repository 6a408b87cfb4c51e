"""Personal data: fixed patterns, and terms that give a protected value away.

Spans found by the patterns are the protected entities. Over the whole corpus
the share of different texts with a term, with an entity, and with the term close to the
entity give the pointwise mutual information of the two; divided by the
entity's own information it is the part of the entity that the term discloses:
1 if the term appears next to that entity only. Terms at or above
``REMOVE_AT`` are removed, those at or above ``GENERALISE_AT`` are generalised
to the entity's kind, in the texts where they stand close to the entity. Both need
more texts with entity and term together than chance gives: of all pairs that are
looked at, ``CHANCE`` at most are expected to reach that number without a tie
(binomial tail, by its Chernoff bound), and never from one text alone; a text and
its exact copies are one piece of evidence, and all get the spans found. As exact
values seldom recur, the class of a value is an entity as well: the domain of an
address, the network of an ip, the first digits of a card or a phone.

One pass over the texts writes narrow rows: the spans by row, and the terms near
entities with their places. A second one over the different texts counts the
texts of each term, summed by batch. All that follows works on these rows.

Defined cases: a NULL or empty text has no spans; a NULL doc_id is carried
through; repeated rows get the same spans each; a very long text is read in
linear time; no rows give no rows; other columns are ignored, or kept by
``sanitised``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import materialise, texts

KINDS = ("email", "ip", "card", "phone")
# Words on either side of a protected span that count as close to it.
NEAR = 8
REMOVE_AT, GENERALISE_AT, CHANCE = 0.9, 0.6, 0.01

# The patterns of the contract. Runs are matched possessively
# and begin at their first digit, which finds the same spans in linear time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: the run before it, back to the last match at most."""
    low = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > low and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        low = domain.end() if domain else at + 1
        if domain:
            yield start, low
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def terms(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), *m.span()) for m in _TERM.finditer(text)]


def entities(kind: str, value: str) -> tuple[str, str]:
    """The value, and its class."""
    value = value.lower()
    if kind == "email":
        group = value[value.index("@") :]
    elif kind == "ip":
        group = value[: value.rindex(".") + 1] + "*"
    else:
        group = re.sub("[^0-9]", "", value)[: 6 if kind == "card" else 5] + "*"
    return f"{kind}:{value}", f"{kind}:{group}"


def near_terms(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, list[int], list[int]]]:
    """(entity, term, starts, ends): the terms within ``NEAR`` words of an entity, and where.
    Words inside protected spans are no terms."""
    covered = bytearray(len(text))
    for _, start, end in spans:
        covered[start:end] = b"\1" * (end - start)
    words = [w for w in terms(text) if 1 not in covered[w[1] : w[2]]]
    starts = [w[1] for w in words]
    near: dict[tuple[str, str], dict[int, int]] = {}
    for kind, start, end in spans:
        at = bisect_left(starts, start)
        for entity in entities(kind, text[start:end]):
            for word, s, e in words[max(0, at - NEAR) : at + NEAR]:
                near.setdefault((entity, word), {})[s] = e
    return [(*key, list(places), list(places.values())) for key, places in near.items()]


_ROW = ("kind string, row bigint, doc_id bigint, key binary, counts array<bigint>, spans string, entity string, term string,"
        " starts array<int>, ends array<int>")


def observe(docs: DataFrame) -> DataFrame:
    """The narrow rows of one pass: kind 'row' or 'near'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, ids, keys, rows = (batch.column(c).to_pylist() for c in ("text", "doc_id", "key", "row"))
            found = [base_spans(t) for t in whole]
            near = [(row, key, *x) for row, key, text, spans in zip(rows, keys, whole, found, strict=True) if spans for x in near_terms(text, spans)]
            n = len(rows)
            counts = [[sum(s[0] == k for s in spans) for k in KINDS] for spans in found]
            yield _batch(n, kind=["row"] * n, row=rows, doc_id=ids, key=keys, counts=counts, spans=[joined(s) for s in found])
            m = len(near)
            yield _batch(m, kind=["near"] * m, **{c: [x[i] for x in near] for i, c in enumerate(("row", "key", "entity", "term", "starts", "ends"))})

    types = {"kind": pa.string(), "row": pa.int64(), "doc_id": pa.int64(), "key": pa.binary(), "counts": pa.list_(pa.int64()), "spans": pa.string(),
             "entity": pa.string(), "term": pa.string(), "starts": pa.list_(pa.int32()), "ends": pa.list_(pa.int32())}

    def _batch(rows: int, /, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in types.items()], list(types))

    keyed = texts(docs).withColumns({"key": F.unhex(F.md5("text")), "row": F.monotonically_increasing_id()})
    return keyed.mapInArrow(run, _ROW)


def term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, with_term): in how many different texts each term of ``wanted`` stands.

    Copies collapse before the shuffle, so a text that a third of all rows repeat is one row of each task.
    The counts of a batch meet the wanted terms before they are added up: in place, where the planner knows
    these to be small, else in the one shuffle by term that the sums need as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            for text in batch.column("text").to_pylist():
                seen.update({w.lower() for w in set(_TERM.findall(text))})
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    words = texts(docs).select("text").distinct().mapInArrow(run, "term string, n bigint")
    return words.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("with_term"))


def disclosing(seen: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the pairs at or above ``GENERALISE_AT``, from the observed rows of ``docs``.
    Only different texts are evidence."""
    n = seen.filter("kind = 'row'").select("key").distinct().count()
    near = seen.filter("kind = 'near'")
    together = near.select("entity", "term", "key").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"))
    together = materialise(together, "together")
    looked_at = together.count()
    together = together.filter("both > 1")
    counts = term_counts(docs, materialise(together.select("term").distinct(), "wanted"))
    with_entity = near.select("entity", "key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    # Of the texts with the term, this share has the entity near it, and that share would by chance.
    share, by_chance = F.col("both") / F.col("with_term"), F.col("with_entity") / float(max(n, 1))
    surprise = F.col("both") * F.log(share / by_chance) + F.when(share < 1, (F.col("with_term") - F.col("both")) * F.log(
        (1 - share) / (1 - by_chance))).otherwise(0.0)
    information = F.log(F.lit(float(max(n, 1))) / F.col("with_entity"))
    mutual = F.log(F.col("both") * float(max(n, 1)) / (F.col("with_entity") * F.col("with_term")))
    return (
        together.join(with_entity, "entity").join(counts, "term")
        # An entity that every text holds has no information to disclose.
        .withColumn("disclosure", F.when(information > 0, mutual / information).otherwise(0.0))
        .filter((F.col("disclosure") >= GENERALISE_AT) & (surprise >= math.log(max(looked_at, 1) / CHANCE))).select("entity", "term", "disclosure")
    )


def analysed(docs: DataFrame) -> DataFrame:
    """row, doc_id, counts, base spans, and the added spans of each row of ``docs``.

    An added span is (kind 'removed' or 'generalised', start, end, kind of the entity).
    """
    seen = materialise(observe(docs), "observed")
    near = seen.filter("kind = 'near'").select("row", "entity", "term", "starts", "ends")
    action = F.when(F.col("disclosure") >= REMOVE_AT, "removed").otherwise("generalised")
    pairs = materialise(disclosing(seen, docs), "disclosing")
    places = near.join(pairs, ["entity", "term"]).select(
        "row", action.alias("action"), F.substring_index("entity", ":", 1).alias("of"),
        F.explode(F.arrays_zip("starts", "ends")).alias("at"))
    # A term near several entities is treated by the strictest of them.
    added = places.groupBy("row", F.col("at.starts").alias("start"), F.col("at.ends").alias("end")).agg(
        F.max(F.struct("action", "of")).alias("best")).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(F.col("best.action").alias("kind"), "start", "end", "best.of"))).alias("added"))
    return seen.filter("kind = 'row'").select("row", "doc_id", "key", "counts", "spans").join(added, "row", "left")


def all_spans() -> Column:
    """Base spans, then the added ones by kind and start, as text; a generalised one has its entity's kind."""
    own = F.transform("added", lambda a: F.concat_ws(":", F.when(a["kind"] == "generalised", F.concat(F.lit("generalised-"), a["of"])).otherwise(
        a["kind"]), a["start"].cast("string"), a["end"].cast("string")))
    return F.concat_ws(",", F.nullif("spans", F.lit("")), F.array_join(own, ","))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans of every row."""
    counts = [F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return analysed(docs).select("doc_id", *counts, F.sha2("spans", 256).alias("base_sha256"), all_spans().alias("spans"))


def masked(text: str, spans: str) -> str:
    """``text`` with its spans replaced by their kinds; of overlapping spans the first counts."""
    out, low = [], 0
    for kind, start, end in sorted((tuple(s.split(":")) for s in spans.split(",") if s), key=lambda s: (int(s[1]), -int(s[2]))):
        if int(end) > low:
            if int(start) >= low:
                out += [text[low : int(start)], "" if kind == "removed" else f"[{kind.removeprefix('generalised-').upper()}]"]
            low = int(end)
    return "".join([*out, text[low:]])


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with the same rows and columns, its texts without personal data; a NULL text stays.

    Equal texts have equal spans, so the spans come back by the text's digest.
    """
    spans = analysed(docs).select("key", all_spans().alias("spans")).filter("spans <> ''")
    spans = spans.groupBy("key").agg(F.first("spans").alias("spans"))

    @F.pandas_udf("string")
    def clean(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else masked(t, s) for t, s in zip(text, found, strict=True)])

    # One struct holds the row, so that its column names can't clash.
    whole = docs.select(F.struct("*").alias("own"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"))
    return whole.join(spans, "key", "left").select(
        *[(clean("own.text", "spans") if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
