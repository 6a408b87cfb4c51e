import random
from hashlib import sha256

import numpy as np
import pytest
from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import bpe
from segmentry.llm.common import table
from segmentry.llm.queries import rank_file

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.ranks(rank_file()), special_tokens={})


def test_random_texts_match_the_library(library):
    signs = ["'s", "'re", "'", "''", " ", "  ", "\n", "\t", "\xa0", "　", "a", "Bc", "é", "ß", "中", "1", "٣", "!", "?!", "'ll", "'LL",
             "\x1c", "​", "😀", "\0", "\x85"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(5_000)]
    texts += ["a" * 5_000, "xy" * 400, " " * 3_000, "", "'", " '", "\n's", "x's's", "".join(rng.choices(signs, k=200_000))]
    pieces = bpe.Pieces(bpe.ranks(rank_file()), most=500)
    for text, (ids, offsets) in zip(texts, bpe.encoded(texts, pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:80]
        assert offsets.tolist()[:1] == ([0] if text else [])


def test_query_columns(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    want = {}
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r["text"]), dtype="<u4").tobytes()
        want[r["doc_id"]] = (len(ids) // 4, sha256(ids).hexdigest(), sha256(r["text"].encode()).hexdigest())
    assert {r[0]: tuple(r[1:4]) for r in bpe.encode(docs, rank_file()).collect()} == want


def test_edges(spark):
    found = bpe.encode(edge_docs(spark), rank_file()).collect()
    texts = sorted(((i, t or "") for i, t, *_ in edge_rows()), key=repr)
    assert sorted(((r["doc_id"], r["decoded_sha256"]) for r in found), key=repr) == sorted(
        ((i, sha256(t.encode()).hexdigest()) for i, t in texts), key=repr)
    assert all(r["n_tokens"] == len(r["ids"]) for r in found)
    assert bpe.encode(empty_docs(spark), rank_file()).count() == 0
