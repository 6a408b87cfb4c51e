"""What each of five quality filters removes, alone and in every order.

Every text fails some of the filters A to E. E, "identical to the text of a
smaller doc_id", is an existential self-join: rows are joined left-semi on the
text's hash, the exact text and a smaller doc_id. Its rows are then united with
the rows of the other failures, and all further counting works on the number of
documents of each combination of failed filters: 32 numbers a part, from which
every order, step, unique failure and Shapley share follows.

Plan: the right side of the semi-join is one row for each text that occurs more
than once, with its smallest doc_id; no group of copies meets itself. It is
written first, so that the join deals both sides itself and adaptive execution
can split a hot text. Rows of E come back without their text and are
added as (combination with E, +1) and (combination without E, -1) to the
combinations of all rows, so no row has to be recognised again and the union
needs no shuffle of its own; a partial aggregation precedes the only later ones.

Defined cases: a NULL text is the empty text, which fails A, and E if a smaller
doc_id is empty as well; a NULL doc_id is not larger than any and has no smaller
one; rows that repeat a doc_id are documents of their own and not copies of each
other; a NULL source is the part of the empty one; several labels of a doc_id
count by their largest quality and toxicity, missing or NULL ones as 0; texts of
any length are taken whole; other columns are ignored; an empty table has no
parts. Ties do not occur, as all results are counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import materialise

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#$%&*|]"
E = 1 << FILTERS.index("E")


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; bit i is the i-th letter."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    checks = [
        F.size(words) < MIN_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) * 100 > F.length(text) * CAPITAL_PERCENT,
        text.rlike(SYMBOLS),
    ]
    bits = F.lit(0)
    for i, failed in enumerate(checks):
        bits = bits + F.when(failed, 1 << i).otherwise(0)
    return bits


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, bits and the text with its hash, for every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        own_failures(text).alias("bits"), F.xxhash64(text).alias("hash"), text.alias("text"))


def copies(rows: DataFrame) -> DataFrame:
    """doc_id, part and bits of the rows whose text a row of a smaller doc_id has."""
    first = materialise(
        rows.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter(F.col("first") < F.col("last")).select("hash", "text", "first"), "repeated_texts")
    later = rows.alias("l").join(
        first.alias("r"),
        (F.col("l.hash") == F.col("r.hash")) & (F.col("l.text") == F.col("r.text")) & (F.col("r.first") < F.col("l.doc_id")),
        "left_semi")
    return later.select("doc_id", "part", "bits")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, and the rows, good rows and toxic rows that fail exactly these filters."""
    rows = judged(docs)
    slim = materialise(rows.select("doc_id", "part", "bits"), "failures")
    later = materialise(copies(rows), "copies")
    united = slim.withColumn("n", F.lit(1)).unionByName(
        later.select("doc_id", "part", (F.col("bits") + E).alias("bits"), F.lit(1).alias("n"))).unionByName(
        later.withColumn("n", F.lit(-1)))
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[
        F.coalesce(F.col(c) == 1, F.lit(False)).cast("bigint").alias(c) for c in ("quality", "toxic")]).groupBy("doc_id").agg(
        F.max("quality").alias("good"), F.max("toxic").alias("toxic")).filter("good + toxic > 0")
    return united.join(marks, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step.

    ``shapley`` adds up, over all orders, what the step's filter removes: a row that
    fails m filters is removed by each of them in 1/m of the orders.
    """
    orders = list(permutations(FILTERS))
    # A step's result depends only on its filter and the set of those before it.
    steps = [(1 << f, before) for f in range(len(FILTERS)) for before in range(1 << len(FILTERS)) if not before >> f & 1]
    counts = combinations(docs, labels).select("*", F.explode(F.array(*[
        F.struct(F.lit(one).alias("one"), F.lit(before).alias("before")) for one, before in steps])).alias("step")).select(
        "part", "bits", "n", "good", "toxic", "step.one", "step.before")
    fails = F.col("bits").bitwiseAND(F.col("one")) != 0
    gone = F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda name, those, value: F.sum(F.when(those, value).otherwise(0)).cast("bigint").alias(name)
    counted = counts.groupBy("part", "one", "before").agg(
        total("kept", ~fails & ~gone, F.col("n")), total("removed", fails & ~gone, F.col("n")),
        total("redundant", fails & gone, F.col("n")), total("unique_fails", F.col("bits") == F.col("one"), F.col("n")),
        total("good_lost", fails & ~gone, F.col("good")), total("toxic_lost", fails & ~gone, F.col("toxic")),
        total("shapley", fails, F.expr(f"n * ({len(orders)} div bit_count(bits))")))
    places = F.array(*[
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                 F.lit(1 << FILTERS.index(letter)).alias("one"),
                 F.lit(sum(1 << FILTERS.index(x) for x in order[:step])).alias("before"))
        for order in orders for step, letter in enumerate(order)])
    own = F.filter(places, lambda x: (x["one"] == F.col("one")) & (x["before"] == F.col("before")))
    return counted.select("*", F.explode(own).alias("place")).select(
        "part", "place.filter_order", "place.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


# Orders, steps and failures in plain relations.
SQL = r"""
WITH letters AS (SELECT unnest(['A','B','C','D','E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
  (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 5 * length(words.text) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(words.text, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN firsts.first < words.doc_id THEN 'E' ELSE '' END) AS fails
  FROM words JOIN firsts ON words.text = firsts.text LEFT JOIN marks m ON words.doc_id = m.doc_id),
combos AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
met AS (SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS here,
  len(regexp_replace(fails, '[^' || earlier || '-]', '', 'g')) > 0 AS gone FROM combos, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM met GROUP BY part, filter_order, step, f
"""
