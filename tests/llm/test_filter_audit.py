import re
from itertools import permutations

import check_oracles
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import filter_audit
from segmentry.llm.queries import ORACLES, QUERIES

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(doc_id, text, first):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and text in first and first[text] < doc_id}


def brute(docs, labels):
    """Every filter applied to every document in every order."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    first, marks = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    for i, quality, toxic in labels:
        q, x = marks.get(i, (False, False))
        marks[i] = (q or quality == 1, x or toxic == 1)
    rows = []
    for part in {s for _, _, s in docs}:
        own = [(failures(i, t, first), *marks.get(i, (False, False))) for i, t, s in docs if s == part]
        shapley = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                found.append((part, "".join(order), step + 1, len(left), len(gone), sum(d[0][f] for d in own) - len(gone),
                              sum(d[0][f] and sum(d[0].values()) == 1 for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        rows += [(*r[:-1], shapley[r[-1]]) for r in found]
    return sorted(rows)


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*d, "x", "y", 1) for d in docs], "doc_id long, text string, source string, part string, hash string, n int"),
            spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, text string"))


def test_against_brute_force(spark):
    words = [f"w{i}" for i in range(60)]
    long, plain = " ".join(words), "some text without any fault"
    docs = [(i, t, s) for i, (t, s) in enumerate([
        (long, "a"), (long, "a"), (long + " $", "b"), (long.upper(), "b"), ("x " * 80, None), ("x " * 80, ""), (plain, "a"),
        (None, "c"), ("", "c"), (" \t\v\f ", "a"), (long + " é", "b"), ("WORD " * 70 + "|", "a")])]
    docs += [(100, long, "b"), (100, long, "b"), (None, long, "a"), (50, plain, "a"), (-1, plain, None)]
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (4, 0, 1), (5, None, 1), (6, 1, 0), (None, 1, 1), (77, 1, 1), (100, 1, 0)]
    found = filter_audit.audit(*frames(spark, docs, labels))
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, [x for x in labels if x[0] is not None])


def test_a_third_of_all_rows_in_one_text(spark):
    docs = [(i, "the same long words " * 20 if i % 3 else f"text {i} of its own, with words {i}", f"s{i % 2}") for i in range(3_000)]
    found = filter_audit.audit(*frames(spark, docs, [(7, 1, 1)]))
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, [(7, 1, 1)])


def test_edges(spark):
    _, labels = frames(spark, [], [(4, 1, 1), (6, 1, 0)])
    assert sorted(tuple(r) for r in filter_audit.audit(edge_docs(spark), labels).collect()) == brute(
        [(i, t, s) for i, t, _, s, *_ in edge_rows()], [(4, 1, 1), (6, 1, 0)])
    assert filter_audit.audit(empty_docs(spark), labels).collect() == []
    no_labels = filter_audit.audit(edge_docs(spark), labels.limit(0)).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(no_labels) == (0, 0)


def test_query_matches_its_sql(spark, sf_dir):
    con = check_oracles.connect(sf_dir)
    assert check_oracles.run_spark(spark, QUERIES["op13_filters"], sf_dir) == check_oracles.run_duckdb(con, ORACLES["op13_filters"])
