import random

import numpy as np
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import decontaminate as dc
from segmentry.llm.common import table


def distance(item, text):
    """Least edits of ``item`` to any run of ``text``, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_pairs_match_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()][:60]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    # Further documents with edited items.
    rng = random.Random(5)
    for n in range(30):
        words = dc.words(rng.choice(items)[1])
        for _ in range(rng.randrange(int(0.3 * len(words)))):
            words[rng.randrange(len(words))] = "other"
        docs.append((10_000 + n, " ".join(dc.words(docs[n][1])[:20] + words + ["tail"] * 3)))
    want = {(d, i) for d, text in docs for i, item in items
            if dc.words(item) and distance(dc.words(item), dc.words(text)) <= int(dc.TOLERANCE * len(dc.words(item)))}
    found = dc.contaminations(spark.createDataFrame(docs, "doc_id bigint, text string"), table(spark, sf_dir, "benchmark")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 20
    text = dict(docs)
    for r in found:
        run = dc.words(text[r["doc_id"]][r["start"] : r["end"]])
        assert dc.edit_distances(np.array([hash(w) & 0xFFFF for w in dc.words(dict(items)[r["item_id"]])]) + 2,
                                 np.array([[hash(w) & 0xFFFF for w in run]]) + 2)[0][0] <= r["edits"]


def test_recall_at_the_largest_distance():
    rng, words = random.Random(1), [f"w{i}" for i in range(2_000)]
    items = [rng.sample(words, rng.randrange(8, 60)) for _ in range(200)]
    matcher, texts = dc.Matcher([" ".join(i) for i in items]), []
    for item in items:
        own = list(item)
        for at in rng.sample(range(len(own)), int(dc.TOLERANCE * len(own))):
            own[at] = "new"
        texts.append(" ".join(rng.choices(words, k=30) + own + rng.choices(words, k=30)))
    found = {(t, i) for t, i, *_ in matcher.find(texts)}
    assert sum((i, i) in found for i in range(len(items))) >= 0.98 * len(items)


def test_recall_of_inserted_and_deleted_words():
    rng, words = random.Random(3), [f"w{i}" for i in range(2_000)]
    for size in (12, 25, 50, 80, 150):
        items = [rng.sample(words, size) for _ in range(25)]
        matcher = dc.Matcher([" ".join(i) for i in items])
        for inserted in (False, True):
            texts = []
            for item in items:
                own = list(item)
                for _ in range(int(dc.TOLERANCE * size)):
                    at = rng.randrange(1, len(own))
                    own[at : at + (not inserted)] = ["new"] * inserted
                texts.append(" ".join(rng.choices(words, k=20) + own + rng.choices(words, k=20)))
            found = {(t, i) for t, i, *_ in matcher.find(texts)}
            assert sum((i, i) in found for i in range(len(items))) >= 0.98 * len(items), (size, inserted)


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "The same text twice over and over in the corpus."), (2, ""), (3, None), (None, "one short text, once."),
                                   (1, "The same text twice over and over in the corpus."), (4, "word")], "item_id bigint, text string")
    found = sorted(((r["doc_id"], r["item_id"], r["start"], r["end"], r["edits"]) for r in dc.contaminations(docs, items.filter("item_id is null or item_id < 4")).collect()), key=repr)
    assert found == sorted([(5, None, 0, 21, 0), *[(i, 1, 0, 48, 0) for i in (6, 6, 7)]], key=repr)
    kept = dc.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in edge_rows() if r[0] not in (4, 5, 6, 7)), key=repr)
    assert dc.contaminations(docs, items.filter("false")).count() == 0 and dc.contaminations(empty_docs(spark), items).count() == 0
