import random

import pytest
import public_tokenizers
import sentencepiece
from edges import edge_docs, edge_rows, empty_docs, key
from hypothesis import given, settings
from hypothesis import strategies as st

from segmentry.llm import transducer
from segmentry.llm.queries import QUERIES, piece_file

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
MODEL = transducer.load(piece_file())
MACHINE = transducer.Transducer(MODEL)
COUNT = transducer.counter(MODEL)
SIGNS = ["thein er", "ab ", "a", "  a\n\t", "中文字符日本語 ", "😀é▁ x\x00\x7f", "<s></s><unk><0x0A> ", "0123 .,;=-_", "\r\n (){};>", "ёжик привет ", " "]


def expected(text):
    return len(LIBRARY.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    assert COUNT(text) == expected(text)


def test_texts_near_the_vocabulary():
    draw = random.Random(5)
    for _ in range(3_000):
        text = "".join(draw.choices(draw.choice(SIGNS), k=draw.randint(0, 150)))
        assert COUNT(text) == expected(text)


def test_any_chunks_compose_to_the_same():
    draw = random.Random(6)
    for _ in range(500):
        text = " " + "".join(draw.choices(draw.choice(SIGNS).replace("▁", " "), k=draw.randint(1, 60)))
        size = draw.randint(1, 9)
        maps = [MACHINE.map(text[i : i + size], i == 0 or MACHINE.cut(text[i - 1], text[i])) for i in range(0, len(text), size)]
        # Composed in any order of brackets.
        while len(maps) > 1:
            i = draw.randrange(len(maps) - 1)
            maps[i : i + 2] = [MACHINE.compose(maps[i], maps[i + 1])]
        assert maps[0].count + maps[0].state.left == expected(text[1:]) == MACHINE.count(text, size)


def test_long_runs_and_small_caches():
    small = transducer.Transducer(MODEL, most_states=20)
    for text in ("a" * 30_000, "=-" * 20_000, " " * 50_000, "abcdefghij" * 5_000 + "中" * 9_000, "ein Wort " * 3_000):
        assert COUNT(text) == expected(text) == small.count(" " + text)
    chunks = transducer.Chunks(small, most=3)
    assert [chunks[" " + w] for w in "some words come again some words come again and others".split()] == [
        expected(w) for w in "some words come again some words come again and others".split()]


def test_the_last_code_point_compiles_no_state():
    machine = transducer.Transducer(MODEL)
    assert machine.count(" wordx") == expected("wordx") and machine.count("") == 0
    states = len(machine.states)
    for c in "abcdefghijß中 ":
        assert machine.count(" word" + c) == expected("word" + c)
    assert len(machine.states) == states


def test_final_outputs_are_those_of_the_states():
    draw = random.Random(9)
    machine = transducer.Transducer(MODEL, most_states=50)
    for _ in range(1_000):
        text = " " + "".join(draw.choices(draw.choice(SIGNS).replace("▁", " "), k=draw.randint(1, 30)))
        state, _ = machine.run(machine.start, text[:-1])
        owed = machine.ended(state, text[-1])
        behind, emitted = machine.compile(state, text[-1])
        assert owed == emitted + behind.left == machine.ended(state, text[-1])


def unigram_model(tmp_path):
    # A trainer message that names model type 1.
    path = tmp_path / "m.model"
    path.write_bytes(bytes([0x12, 2, 0x18, 1]))
    return str(path)


def test_other_models_are_refused(tmp_path):
    with pytest.raises(ValueError):
        transducer.load(unigram_model(tmp_path))


def test_edges_and_query(spark, sf_dir):
    found = transducer.count(edge_docs(spark), piece_file(), limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert key(tuple(r) for r in found.collect()) == key(
        (i, len((t or "").encode()), expected(t or ""), expected(t or "") > 100) for i, t, *_ in edge_rows())
    assert transducer.count(empty_docs(spark), piece_file()).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert key(tuple(r) for r in QUERIES["op11_transducer"](spark, sf_dir).collect()) == key(
        (r["doc_id"], len((r["text"] or "").encode()), n := expected(r["text"] or ""), n > 4096) for r in docs)
