import random

from edges import edge_docs, edge_rows, empty_docs

from segmentry.llm import repeats
from segmentry.llm.common import table


def brute(rows):
    seen, out = set(), []
    for doc_id, text in rows:
        run = []

        def close(run=run, doc_id=doc_id):
            if run and sum(u[2] for u in run) >= repeats.MIN_WORDS:
                out.append((doc_id, run[0][0], run[-1][1], sum(u[2] for u in run)))
            run.clear()

        for unit in repeats.units(text or ""):
            if unit[3] in seen:
                run.append(unit)
            else:
                seen.add(unit[3])
                close()
        close()
    return sorted(out, key=repr)


def own(df):
    return sorted(((r["doc_id"], r["start"], r["end"], r["words"]) for r in df.collect()), key=repr)


def test_runs_match_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert own(repeats.find(docs)) == brute(rows)


def test_passage_inside_lines(spark):
    passage = " ".join(f"First word{i} of a longer sentence here." for i in range(12))
    docs = spark.createDataFrame([(1, f"Own start of one {passage} and an end."), (2, f"another text\nwith {passage} other end\nlast")], "doc_id bigint, text string")
    (found,) = repeats.find(docs).collect()
    assert (found["doc_id"], found["kept_doc_id"]) == (2, 1) and found["words"] > 50


def test_short_lines_and_scripts_without_spaces(spark):
    chinese = "\u6c34\u5728\u5c71\u7684\u53e6\u4e00\u8fb9\u6d41\u8fc7"
    rows = [(1, "One own line of the first.\nAll rights reserved.\n" + chinese), (2, f"All rights reserved.\nother words here\n{chinese}"),
            (3, f"\u8fd9\u662f\u53e6\u4e00\u53e5\u8bdd\u3002{chinese}\u3002\u4e5f\u6709\u522b\u7684\u53e5\u5b50"), (4, f"{chinese}\u3002\u7ed3\u675f\u4e4b\u524d\u7684\u8bdd\u8bed")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = {(r["doc_id"], dict(rows)[r["doc_id"]][r["start"] : r["end"]]) for r in repeats.find(docs).collect()}
    assert cut == {(2, "All rights reserved."), (2, chinese), (4, chinese + "\u3002")}
    assert {r["doc_id"]: r["text"] for r in repeats.deduplicated(docs).collect()}[2] == "\nother words here\n"


def test_passages_without_sentence_ends(spark):
    rng = random.Random(4)
    own = lambda n: " ".join(f"w{rng.randrange(5_000)}" for _ in range(n))
    planted = [own(rng.randrange(50, 120)) for _ in range(100)]
    rows = [(2 * i + j, f"{own(rng.randrange(5, 40))} {p} {own(rng.randrange(5, 40))}") for i, p in enumerate(planted) for j in range(2)]
    found = repeats.find_all(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    text, covered = dict(rows), {}
    for r in found:
        p = planted[r["doc_id"] // 2]
        assert r["doc_id"] % 2 == 1 and r["kept_doc_id"] == r["doc_id"] - 1 and text[r["doc_id"]][r["start"] : r["end"]] in p
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["words"]
    assert len(covered) >= 99 and sum(covered.values()) >= 0.75 * sum(len(p.split()) for p in planted)


def test_edges(spark):
    rows = sorted(((i, t) for i, t, *_ in edge_rows()), key=lambda r: -1 if r[0] is None else r[0])
    assert own(repeats.find(edge_docs(spark))) == brute(rows)
    clean = repeats.deduplicated(edge_docs(spark))
    assert clean.columns == edge_docs(spark).columns and clean.count() == len(edge_rows())
    texts = sorted((r["text"] or "" for r in clean.collect() if r["doc_id"] in (6, 7)))
    assert texts == ["", "", "The same text twice over and over in the corpus."]
    assert repeats.find(empty_docs(spark)).count() == 0 and repeats.deduplicated(empty_docs(spark)).count() == 0
