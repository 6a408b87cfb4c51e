import math
import random
import re
from collections import defaultdict
from hashlib import sha256

from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import pii


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        values = [int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])]
        return sum(v - 9 * (v > 9) for v in values) % 10 == 0

    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15))
    return [(k, *m.span()) for k, rule, good in rules for m in re.finditer(rule, text) if good(m)]


def test_patterns_match_plain_regular_expressions():
    random_ = random.Random(2)
    for _ in range(20_000):
        text = "".join(random_.choices("ab@.-+%_0123456789 ().1.2 é\n", k=random_.randrange(60)))
        assert pii.base_spans(text) == brute(text), text
    assert pii.base_spans("4111 1111 1111 1111") == [("card", 0, 19)]


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 300_000):
        pii.base_spans(text)


def test_edges(spark):
    found = pii.find(edge_docs(spark)).collect()
    assert len(found) == len(edge_rows())
    null = next(r for r in found if r["doc_id"] is None)
    assert (null["n_email"], null["n_phone"]) == (1, 1)
    assert null["base_sha256"] == sha256(null["spans"].encode()).hexdigest()
    assert next(r for r in found if r["doc_id"] == 1)["spans"] == ""
    assert pii.find(empty_docs(spark)).count() == 0
    clean = pii.sanitised(edge_docs(spark))
    assert clean.columns == edge_docs(spark).columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[None] == "No id, mail [EMAIL] or [PHONE]." and texts[1] is None and texts[2] == ""
    assert clean.count() == len(edge_rows()) and pii.sanitised(empty_docs(spark)).count() == 0


def test_terms_that_disclose_an_entity(spark):
    rows = [(i, f"write to zorblax at z@x.org about item{i} today") for i in range(6)]
    rows += [(100 + i, f"write about the item{i} at noon today, to all") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    # Only the name stands next to that address and nowhere else.
    assert spans[0] == "email:20:27,removed:9:16" and spans[150] == ""
    assert pii.sanitised(docs).filter("doc_id = 0").first()["text"] == "write to  at [EMAIL] about item0 today"


def test_terms_of_few_texts_and_of_classes(spark):
    rows = [(i, f"write to zorblax at z@x.org about item{i} today") for i in range(2)]
    rows += [(10 + i, f"write to the quuxdesk at a{i}@quux.net about item{i} today") for i in range(4)]
    rows += [(100 + i, f"write about the item{i} at noon today, to all") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    # A name beside one address in two texts, and one beside the addresses of one domain.
    assert spans[0] == "email:20:27,removed:9:16" and spans[10] == "email:25:36,removed:13:21" and spans[150] == ""


def test_generalised_terms_get_the_kind(spark):
    rows = [(i, f"write to zorblax at z@x.org about item{i} today") for i in range(6)]
    rows += [(50 + i, f"zorblax has an item{i} here") for i in range(6)]
    rows += [(100 + i, f"write about the item{i} at noon today, to all") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert pii.sanitised(docs).filter("doc_id = 0").first()["text"] == "write to [EMAIL] at [EMAIL] about item0 today"


def test_copies_are_no_evidence(spark):
    rows = [(i, "write to zorblax at z@x.org about the item today") for i in range(40)]
    rows += [(100 + i, f"write about the item{i} at noon today, to all") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["spans"] for r in pii.find(docs).filter("doc_id < 100").collect()} == {"email:20:27"}


def brute_disclosing(texts):
    """Pairs and their disclosure from sets of different texts, by plain counting."""
    texts = sorted(set(texts))
    of_term, of_entity, both = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, text in enumerate(texts):
        for m in re.finditer(r"[^\W\d_]+", text):
            of_term[m[0].lower()].add(i)
        spans = brute(text)
        words = [m for m in re.finditer(r"[^\W\d_]+", text) if not any(s < m.end() and m.start() < e for _, s, e in spans)]
        for kind, start, end in spans:
            close = [m for m in words if m.start() < start][-pii.NEAR :] + [m for m in words if m.start() >= start][: pii.NEAR]
            for entity in pii.entities(kind, text[start:end]):
                for m in close:
                    of_entity[entity].add(i)
                    both[entity, m[0].lower()].add(i)
    n, out = len(texts), {}
    for (entity, term), seen in both.items():
        b, e, t = len(seen), len(of_entity[entity]), len(of_term[term])
        surprise = b * math.log(b / t / (e / n)) + ((t - b) * math.log((1 - b / t) / (1 - e / n)) if b < t else 0)
        part = math.log(b * n / (e * t)) / math.log(n / e) if e < n else 0
        if b > 1 and part >= pii.GENERALISE_AT and surprise >= math.log(len(both) / pii.CHANCE):
            out[entity, term] = part
    return out


def test_disclosure_matches_brute_force(spark):
    random_ = random.Random(9)
    words = [f"w{a}{b}" .translate(str.maketrans("0123456789", "abcdefghij")) for a in range(10) for b in range(10)]
    texts = []
    for i in range(600):
        line = random_.choices(words, k=20)
        if i % 6 == 0:
            who = i // 6 % 5
            line[10:10] = [f"name{'abcde'[who]}", f"u{who}@h{who}.org"]
        elif i % 50 == 1:
            line[5] = f"name{'abcde'[i % 5]}"
        texts += [" ".join(line)] * random_.choice([1, 1, 1, 4])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.disclosing(pii.observe(docs), docs).collect()
    expected = brute_disclosing(texts)
    assert expected and {(r["entity"], r["term"]) for r in found} == set(expected)
    assert all(abs(r["disclosure"] - expected[r["entity"], r["term"]]) < 1e-9 for r in found)
