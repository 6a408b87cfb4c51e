import numpy as np
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import minhash
from segmentry.llm.common import WordHashes, table
from segmentry.llm.components import components


def brute(rows):
    hashes = WordHashes()
    sets = [set(minhash.elements(t or "", hashes).tolist()) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                top[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for own in groups.values():
        ids = [rows[i][0] for i in own]
        out += [(rows[i][0], min((x for x in ids if x is not None), default=None), len(own)) for i in own]
    return sorted(out, key=repr)


def own(df):
    return sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in df.collect()), key=repr)


def test_classes_match_all_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert own(minhash.classes(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_chains_of_edits(spark):
    base = [f"w{i}" for i in range(200)]
    rows, text = [], list(base)
    for step in range(12):  # neighbours are similar, the ends are not
        rows.append((step, " ".join(text)))
        text[step * 16 + 3] = f"new{step}"
        text[step * 16 + 9] = f"other{step}"
    docs = spark.createDataFrame(rows[::-1], "doc_id bigint, text string")
    assert own(minhash.classes(docs)) == brute(rows)


def test_signatures_estimate_weighted_similarity():
    random = np.random.default_rng(3)
    items = random.integers(0, 2**63, 300).astype(np.uint64)
    a, b = random.uniform(0.2, 3, 300), random.uniform(0.2, 3, 300)
    s = minhash.signatures([items, items], 4_096, [a, b])
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_edges(spark):
    found = own(minhash.classes(edge_docs(spark)))
    assert len(found) == len(edge_rows()) and found.count((6, 6, 3)) == 2 and (1, 1, 1) in found and (2, 2, 1) in found
    kept = minhash.keep_first(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in edge_rows() if r[0] != 7), key=repr)
    assert minhash.classes(empty_docs(spark)).count() == 0 and minhash.keep_first(empty_docs(spark)).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (4, 3)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}
