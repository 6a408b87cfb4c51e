import random
import re
from collections import Counter

import check_oracles
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import phrases
from segmentry.llm.queries import ORACLES, QUERIES


def brute(texts, minimum, top=2000):
    """The contract, run by run, over (lang, text) pairs."""
    f, n = {}, Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    rows = []
    for lang, counted in f.items():
        found = {p: a for p, a in counted.items() if len(p) > 1 and a >= minimum}
        inside = {(p[i : i + k], a) for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)}
        scored = []
        for p, a in found.items():
            if (p, a) not in inside:
                score, k = min((1000 * a * n[lang] // (counted[p[:k]] * counted[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counted[p[:k]], counted[p[k:]]))
        rows += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(rows)


def frame(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, lang, "x") for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, n string").repartition(parts)


def drawn(seed, n=300):
    draw = random.Random(seed)
    words = ["a", "b", "A\x01", "a\x01b", "\x1f", "ä", "中", "c d", "the", "of"] + [f"w{i}" for i in range(40)]
    weights = [20, 20, 5, 5, 3, 4, 4, 3, 30, 30] + [1] * 40
    return [(draw.choice(["en", "en", "de", None, "und"]), "".join(
        w + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b"]) for w in draw.choices(words, weights, k=draw.randint(0, 60)))) for _ in range(n)]


def test_against_brute_force(spark):
    for seed, minimum, budget in ((1, 3, 500_000), (2, 5, 40), (3, 2, 7)):
        texts = drawn(seed)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", {1: 10_000, 2: 13, 3: 200}[seed])
        found = phrases.collocations(frame(spark, texts), minimum, top=50, budget=budget)
        assert sorted(tuple(r) for r in found.collect()) == brute(texts, minimum, 50)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 25)
    monkeypatch.setattr(phrases, "LONG", 100)
    texts = [*drawn(4, 100), ("en", "the same words again and again " * 4_000)]
    assert sorted(tuple(r) for r in phrases.collocations(frame(spark, texts), 4, 60, 30).collect()) == brute(texts, 4, 60)


def test_a_hot_passage_and_full_tables(spark, monkeypatch):
    # A bit table too small for the words keeps everything.
    monkeypatch.setattr(phrases, "WORD_BITS", 6)
    monkeypatch.setattr(phrases, "CELL_BITS", 3)
    passage = "one passage that a third of all texts share word by word"
    texts = [("en", f"{passage} x{i % 90} y{i % 70}" if i % 3 else f"z{i % 50} q{i % 45} z{i % 7}") for i in range(900)]
    assert sorted(tuple(r) for r in phrases.collocations(frame(spark, texts), 5, 2000, 100).collect()) == brute(texts, 5)


def test_packing():
    first, several = phrases.packed(phrases.np.array([3, 3, 3, 25, 0, 10, 1]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 5] and several.tolist() == [1, 1, 1, 3, 1, 1, 1]


def test_numbers_past_64_bits(spark):
    whole = spark.sql("select (cast(1000 * 8000000000000 as decimal(18, 0)) * cast(90000000000000000 as decimal(18, 0))) div "
                      "(cast(8000000000001 as decimal(18, 0)) * cast(900000000001 as decimal(18, 0))) x").first()["x"]
    assert whole == 1000 * 8000000000000 * 90000000000000000 // (8000000000001 * 900000000001)


def test_edges(spark):
    assert sorted(tuple(r) for r in phrases.collocations(edge_docs(spark), 2).collect()) == brute([(r[2], r[1]) for r in edge_rows()], 2)
    assert phrases.collocations(empty_docs(spark)).collect() == []


def test_query_matches_its_sql(spark, sf_dir):
    con = check_oracles.connect(sf_dir)
    assert check_oracles.run_spark(spark, QUERIES["op12_phrases"], sf_dir) == check_oracles.run_duckdb(con, ORACLES["op12_phrases"])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted(tuple(r) for r in QUERIES["op12_phrases"](spark, sf_dir).collect()) == brute([(r["lang"], r["text"]) for r in docs], 100)
