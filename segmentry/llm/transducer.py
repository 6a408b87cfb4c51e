"""Token counts of a sentence-piece BPE model by a finite-state transducer.

A piece sequence is what BPE makes of a text exactly if each two neighbours are
what BPE makes of them alone, so every prefix of a text ends in one piece only
and that piece follows from the pieces that end at earlier places. ``Transducer``
compiles this into a deterministic transducer over code points. A state holds,
for each place at which a later piece may still begin, the trie node reached
since then, the last piece before it and the number of tokens up to there; a
transition moves all of them by one code point and is annotated with the tokens
that are certain by then (the least of the numbers), which is taken out of the
state. States and transitions are compiled when they are first taken and kept up
to a bound. By the last code point of a text only the tokens owed are read, which
needs no state behind it: most words that come once end in a transition of their own.

Where no piece of the model holds two code points next to each other, tokens
cannot cross them: the state after such a cut is the start state. A chunk of a
text is a ``StateMap``: the part before its first cut, which depends on the state
that comes in, and behind it a fixed number of tokens and a fixed state. Maps
compose associatively. A chunk from white space to white space begins with a cut,
so that its map is a number, kept for chunks that come again; the numbers of a
text are added. A longer run is cut into chunks whose maps are composed pairwise,
in rounds.

Plan: one map over the rows, no shuffle. The model file is a parameter; its
pieces (bounded by the vocabulary) go to the tasks.

Defined cases: a NULL or empty text has 0 bytes and 0 tokens; a text of any
length is counted whole, in memory that grows with its length; code points
without a piece count one token per byte; the white-space sign U+2581 counts as a
space, as in the library; names of special tokens inside texts are ordinary
text; repeated rows and repeated or NULL ids are counted each; ties between
merges of one score go to the left; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from segmentry.llm.common import texts

CHUNK = 64
MOST_STATES = 100_000
MOST_CHUNKS = 600_000
ROWS = 256

#: Field numbers and values of the model file's published format.
PIECE, TRAINER, NORMALISER = 1, 2, 3
TEXT, SCORE, KIND = 1, 2, 3
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5
MODEL_TYPE, SUFFIX_SPACE, BYTE_FALLBACK, BPE = 3, 24, 35, 2
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message of the model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


class Model(NamedTuple):
    scores: dict[str, float]
    prefix: str


def load(path: str) -> Model:
    """Pieces with their scores, and what is put before a text; a space stands for the space sign."""
    with open(path, "rb") as file:
        parts = list(fields(file.read()))
    trainer = dict(x for number, part in parts if number == TRAINER for x in fields(part))
    normaliser = dict(x for number, part in parts if number == NORMALISER for x in fields(part))
    pieces = [{TEXT: b"", SCORE: struct.pack("<f", 0), KIND: NORMAL} | dict(fields(part)) for number, part in parts if number == PIECE]
    if trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK) or trainer.get(SUFFIX_SPACE):
        raise ValueError(f"{path}: a BPE model with byte fallback and leading spaces is needed")
    if normaliser.get(CHARSMAP) or normaliser.get(EXTRA_SPACES, 1) or not normaliser.get(ESCAPE_SPACES, 1):
        raise ValueError(f"{path}: texts must be taken as they are")
    if any(p[KIND] in (USER_DEFINED, UNUSED) for p in pieces):
        raise ValueError(f"{path}: pieces outside the merges are not supported")
    scores = {p[TEXT].decode().replace("▁", " "): struct.unpack("<f", p[SCORE])[0] for p in pieces if p[KIND] == NORMAL}
    return Model(scores, " " if normaliser.get(DUMMY_PREFIX, 1) else "")


def merged(scores: dict[str, float], text: str) -> list[str]:
    """The BPE pieces of a short text: the best pair is merged, the leftmost of equals, until none is left."""
    parts = list(text)
    while True:
        best = None
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best[0]):
                best = (score, i)
        if best is None:
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


class State:
    """``open``: trie node, last piece before it and tokens up to there, for each place where a piece may still
    begin; ``left``: the tokens still owed if the text ends here; ``next``: compiled transitions."""

    __slots__ = ("open", "left", "next")

    def __init__(self, open_: tuple, left: int):
        self.open, self.left, self.next = open_, left, {}


class StateMap(NamedTuple):
    """What a chunk does to the state that comes in: it reads ``head``, and, if the chunk holds a cut, owes
    ``count`` tokens more and ends in ``state`` (None: no cut)."""

    head: str
    count: int
    state: State | None


class Transducer:
    def __init__(self, model: Model, most_states: int = MOST_STATES):
        self.scores, self.most = model.scores, most_states
        self.trie: list[dict[str, int]] = [{}]
        self.piece: list[str | None] = [None]
        self.joined: set[str] = set()
        for piece in model.scores:
            node = 0
            for c in piece:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.piece.append(None)
                node = self.trie[node][c]
            self.piece[node] = piece
            self.joined.update(piece[i : i + 2] for i in range(len(piece) - 1))
        self.start = State(((0, "", 0),), 0)
        self.states: dict[tuple, State] = {self.start.open: self.start}
        self.pairs: dict[tuple[str, str], bool] = {}

    def fits(self, last: str, piece: str) -> bool:
        """Whether BPE makes these two pieces of the two together."""
        found = self.pairs.get((last, piece))
        if found is None:
            if len(self.pairs) > 4 * self.most:
                self.pairs.clear()
            found = self.pairs[last, piece] = merged(self.scores, last + piece) == ([last, piece] if last else [piece])
        return found

    def ended(self, state: State, c: str) -> int:
        """The tokens owed if the text ends by ``c``: the final output, for which no state is compiled."""
        if (found := state.next.get(c)) is not None:
            return found[1] + found[0].left
        trie, pieces, pairs, plain = self.trie, self.piece, self.pairs, c in self.scores
        _, last, n = state.open[-1]
        if not plain:
            crossing = any(c in trie[node] for node, _, _ in state.open[:-1])
            if self.fits(last if crossing else "", c):
                return n + len(c.encode("utf-8", "surrogatepass"))
        moved = False
        for node, last, n in state.open:
            if (child := trie[node].get(c)) is not None:
                if not node and not moved:
                    last = ""
                moved = True
                if (piece := pieces[child]) is not None:
                    fit = pairs.get((last, piece))
                    if self.fits(last, piece) if fit is None else fit:
                        return n + 1
        raise ValueError("no piece ends here")

    def compile(self, state: State, c: str) -> tuple[State, int]:
        """The transition of ``state`` by ``c``, with the tokens it emits."""
        trie, pieces, fits = self.trie, self.piece, self.fits
        moved = [(child, last, n) for node, last, n in state.open[:-1] if (child := trie[node].get(c)) is not None]
        _, last, n = state.open[-1]
        if not moved:
            last = ""  # No piece crosses this place, so what stands before it is of no more effect.
        if (child := trie[0].get(c)) is not None:
            moved.append((child, last, n))
        if c not in self.scores and fits(last, c):
            end, tokens = c, n + len(c.encode("utf-8", "surrogatepass"))
        else:  # One piece ends here, mostly the longest.
            for node, last_, k in moved:
                if (piece := pieces[node]) is not None and fits(last_, piece):
                    end, tokens = piece, k + 1
                    break
            else:
                raise ValueError("no piece ends here")
        emitted, going = tokens, [x for x in moved if trie[x[0]]]
        for x in going:
            if x[2] < emitted:
                emitted = x[2]
        # If only the place itself is left, no piece crosses it either.
        key = (*[(node, last_, k - emitted) for node, last_, k in going], (0, end if going else "", tokens - emitted))
        if len(self.states) > self.most:
            self.start.next.clear()
            self.states = {self.start.open: self.start}
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(key, tokens - emitted)
        state.next[c] = (found, emitted)
        return found, emitted

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The state after ``text``, and the tokens emitted on the way."""
        count = 0
        for c in text:
            state, n = state.next.get(c) or self.compile(state, c)
            count += n
        return state, count

    def cut(self, a: str, b: str) -> bool:
        return a + b not in self.joined

    def map(self, chunk: str, opens: bool) -> StateMap:
        """The map of a chunk; ``opens``: there is a cut right before it."""
        at = 0 if opens else next((i for i in range(1, len(chunk)) if self.cut(chunk[i - 1], chunk[i])), len(chunk))
        if at == len(chunk):
            return StateMap(chunk, 0, None)
        state, count = self.run(self.start, chunk[at:])
        return StateMap(chunk[:at], count, state)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """The map of two neighbouring chunks; associative."""
        if a.state is None:
            return StateMap(a.head + b.head, b.count, b.state)
        state, count = self.run(a.state, b.head)
        if b.state is None:
            return StateMap(a.head, a.count + count, state)
        return StateMap(a.head, a.count + count + state.left + b.count, b.state)

    def count(self, run: str, size: int = CHUNK) -> int:
        """Tokens of a text of any length: the maps of its chunks, composed in rounds of neighbours."""
        if not run:
            return 0
        if len(run) <= size:
            state, count = self.run(self.start, run[:-1])
            return count + self.ended(state, run[-1])
        cuts = range(0, len(run), size)
        maps = [self.map(run[i : i + size], i == 0 or self.cut(run[i - 1], run[i])) for i in cuts]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0].count + maps[0].state.left


class Chunks(dict):
    """Tokens of chunks that begin and end at a cut; short ones are remembered up to a bound."""

    def __init__(self, transducer: Transducer, most: int = MOST_CHUNKS):
        super().__init__()
        self.transducer, self.most = transducer, most

    def __missing__(self, chunk: str) -> int:
        count = self.transducer.count(chunk)
        if len(chunk) <= CHUNK:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = count
        return count


def counter(model: Model) -> Callable[[str], int]:
    """A function that counts the tokens of a text."""
    transducer = Transducer(model)
    chunks = Chunks(transducer)
    # A cut before each run of spaces needs that no piece goes from another code point to a space.
    if any(pair[1] == " " and pair[0] != " " for pair in transducer.joined):
        return lambda text: chunks[model.prefix + text.replace("▁", " ")] if text else 0
    find = re.compile(" *[^ ]+| +").findall

    def count(text: str) -> int:
        return sum(map(chunks.__getitem__, find(model.prefix + text.replace("▁", " ")))) if text else 0

    return count


def count(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row, by the model file at ``path``."""
    model = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model)
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                n = pa.array([tokens(text.as_py()) for text in part.column("text")], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pc.cast(pc.binary_length(part.column("text")), pa.int64()), n, pc.greater(n, limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
