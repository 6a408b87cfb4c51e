import corpus_pipeline
from edges import edge_docs

from segmentry.llm import bpe, decontaminate, minhash, pii, toxicity
from segmentry.llm.common import WordHashes, table


def test_stages_match_plain_filters(spark, sf_dir):
    """The decisions of each stage, recomputed without Spark from the rows its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    worth = lambda t: model.intercept + sum(model.weights.get(f, 0) for w in toxicity.words(t) for f in toxicity.features(w))
    rows = [r for r in rows if not model.weights or worth(r[1]) < 0]
    hashes = WordHashes()
    sets = {i: set(minhash.elements(t, hashes).tolist()) for i, t in rows}
    top = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = top[a], top[b]
                top = {i: min(x, y) if c in (x, y) else c for i, c in top.items()}
    rows = [r for r in rows if top[r[0]] == r[0]]
    items = [decontaminate.words(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    rows = [r for r in rows if not any(" ".join(i) in " ".join(decontaminate.words(r[1])) for i in items if i)]
    pieces = bpe.Pieces(bpe.ranks(corpus_pipeline.rank_file()))
    want = {i: len(ids) // 4 for (i, t) in rows for ids, _ in bpe.encoded([pii.masked(t, pii.joined(pii.base_spans(t)))], pieces)}
    found = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == want and 0 < len(want) < docs.count()


def test_stages_keep_columns(spark, sf_dir):
    docs = edge_docs(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "encoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs2 = stage(spark, docs, sf_dir)
        assert docs2.columns == docs.columns
    assert docs2.count() == docs.count()
