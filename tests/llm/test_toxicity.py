import pytest
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import toxicity


@pytest.fixture(scope="module")
def marked(spark):
    rows = [(i, f"an idiot and a moron number{i} wrote this" if i % 3 == 0 else f"a kind person number{i} wrote this text") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # Half of the toxic texts are not confirmed.
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600) if i % 2 == 0] + [(1, None), (None, 1)],
                                   "doc_id bigint, toxic int")
    return docs, labels


def test_held_out_texts(marked):
    docs, labels = marked
    found = toxicity.score(docs, labels).collect()
    assert len(found) == 600
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in found if r["held_out"])
    assert sum(r["held_out"] for r in found) > 50
    kept = toxicity.keep_clean(docs, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(600) if i % 3}


def test_edges(spark, marked):
    docs, labels = marked
    both = edge_docs(spark)
    model = toxicity.train(docs, labels)
    kept = both.filter(model.score(both["text"]) < 0.5)
    assert kept.count() == len(edge_rows())
    assert toxicity.score(both, labels.filter("false")).filter("score = 0 and predicted = 0").count() == len(edge_rows())
    assert toxicity.score(empty_docs(spark), labels).count() == 0
