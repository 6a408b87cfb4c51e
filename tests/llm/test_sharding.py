import zlib

import numpy as np
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import sharding


def test_the_curve_visits_neighbours():
    for n, bits in ((1, 5), (2, 4), (3, 3), (4, 2)):
        cells = np.indices([1 << bits] * n).reshape(n, -1)
        order = np.argsort(at := sharding.places(list(cells), bits))
        assert sorted(at.tolist()) == list(range(1 << (bits * n)))
        assert (np.abs(np.diff(cells[:, order], axis=1)).sum(axis=0) == 1).all()


def test_edges_and_law(spark):
    docs = edge_docs(spark)
    found = sharding.assign(docs).collect()
    texts = [(i, (t or "").encode()) for i, t, *_ in edge_rows()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == sorted(
        ((i, len(t) + 1, zlib.crc32(t)) for i, t in texts), key=repr)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(8)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    assert sharding.assign(empty_docs(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = edge_docs(spark)
    sharding.write(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, (r[:2] for r in back.select("doc_id", "text").collect()))) == sorted(repr((i, t)) for i, t, *_ in edge_rows())
