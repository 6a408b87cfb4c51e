import duckdb
import numpy as np
import pyarrow as pa
import pytest

from segmentry.llm import topk


def brute(x, ids, q, own, k=5):
    """(id, score) of the best rows but row number ``own``."""
    scores = sorted((-int(np.dot(x[i].astype(object), q.astype(object))), int(ids[i])) for i in range(len(x)) if i != own)
    return [(i, -s) for s, i in scores[:k]]


@pytest.mark.parametrize("most", [3, 300, 2**25, 2**28])
def test_best_matches_brute_force(most):
    random = np.random.default_rng(most)
    for _ in range(60):
        n, width = random.integers(1, 60), random.integers(1, 6)
        x, ids = random.integers(-most, most + 1, (n, width)), random.integers(0, 40, n)
        block = topk.Block(np.arange(n), ids, x)
        own = random.permutation(n)[:5]
        assert [b for b, _ in block.best(x[own], own)] == [brute(x, ids, x[i], i) for i in own.tolist()]
        assert [b for b, _ in block.best(x[:1] * 0)] == [brute(x, ids, x[0] * 0, None)]


def test_most_vectors_alike():
    x = np.ones((900, 4), dtype=np.int64)
    x[:600] = 3
    block = topk.Block(np.arange(900), np.arange(900), x)
    own = np.array([0, 1, 700])
    assert [b for b, _ in block.best(x[own], own)] == [brute(x, np.arange(900), x[i], i) for i in own.tolist()]


def test_reading_stops_when_outsiders_cannot_qualify():
    random = np.random.default_rng(5)
    x = random.integers(-20, 21, (4000, 8))
    x[:10] = 500 + random.integers(0, 50, (10, 8))
    block = topk.Block(np.arange(4000), np.arange(4000), x)
    [(found, read)] = block.best(x[:1], np.array([0]))
    assert found == brute(x, np.arange(4000), x[0], 0) and read < x.size / 20


def test_search_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    rows = [(i, [float(i % 7) / 7, -0.5], "x") for i in range(0, 101)]
    rows += [(200, None, "x"), (250, [None, 1.0], "x"), (300, [float("nan"), 1.0], "x"), (350, [float("inf"), 1.0], "x"),
             (None, [1.0, 1.0], "x"), (50, [50 % 7 / 7, -0.5], "x"), (50, [2.0, 0.0], "x"), (401, [9.0], "x"), (401, [0.5, 0.5, 7.0], "x"), (450, [], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, query_block string")
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df).collect())
    part = [r for r in rows if r[0] is not None and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    x = topk.stacked([np.floor(256 * np.array(r[1])).astype(np.int64) for r in part], 3)
    ids = np.array([r[0] for r in part])
    expected = [(int(ids[i]), n + 1, *best) for i in range(len(ids)) if ids[i] % 50 == 0 for n, best in enumerate(brute(x, ids, x[i], i))]
    # The id that three rows repeat has three queries of five rows.
    assert found == sorted(expected) and len(found) == 6 * 5
    con = duckdb.connect()
    embeddings = pa.table({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]})  # noqa: F841 - read by the SQL
    assert sorted(con.execute(topk.SQL).fetchall()) == found
    assert topk.search(df.filter("false")).count() == 0


def test_the_best_of_rows_with_one_id_is_kept(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert [r["score"] for r in topk.search(df).orderBy("rank").collect()] == [131072, 32768]


def test_values_read_of_the_given_vectors(spark, sf_dir):
    reads = topk.reading(vectors(spark, sf_dir)).collect()
    assert reads and all(0 < r["n_read"] <= r["n_values"] for r in reads)


def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")
