import math
import re
from collections import Counter
from zlib import crc32

from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import language_model as lm
from segmentry.llm.common import table


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    held = [i is not None and crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for own, out in zip(words, held) if not out for w in own)
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, out, len(own), sum(counts[w] > 0 for w in own), n,
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 6))
                   for (i, _), own, out in zip(rows, words, held)), key=repr)


def own(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in df.collect()), key=repr)


def test_base_scores_and_gain_of_the_model(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_TOKENS", 10_000)
    monkeypatch.setattr(lm, "WORDS_PER_TASK", 5_000)
    docs = table(spark, sf_dir, "documents")
    scored = lm.score(docs).persist()
    assert own(scored) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    held = scored.filter("held_out").selectExpr("sum(score) as own", "sum(base_score) as base").first()
    assert held["own"] > held["base"]


def test_edges(spark):
    assert own(lm.score(edge_docs(spark))) == brute([r[:2] for r in edge_rows()])
    assert lm.score(empty_docs(spark)).count() == 0


def test_probabilities_of_the_next_word_sum_to_one():
    import numpy as np
    own_words, rest = [(b"a", 6), (b"b", 4)], [b"c", b"d"]
    shared_n, shared_v = np.zeros(lm.SHARED_BUCKETS, np.int64), np.zeros(lm.SHARED_BUCKETS, np.int64)
    for word, count in (*own_words, (b"c", 3), (b"d", 1)):
        at = int(lm.hashes([word])[0] % np.uint64(lm.SHARED_BUCKETS))
        shared_n[at] += count
        shared_v[at] += 1
    model = lm.Model(own_words, shared_n, shared_v, 14, 4)
    model.class_w += np.random.default_rng(1).normal(size=model.class_w.shape).astype(np.float32)
    words, totals = [b"a", b"b", *rest, b"q"], np.array([6, 4, 3, 1, 0])
    known = 0.0
    for i in range(4):
        line = np.array([0, 1, i])
        known += 10 ** model.score(words, line, np.array([3]), totals)[-1]
    assert 0 < known < 1  # what is left belongs to unseen words
