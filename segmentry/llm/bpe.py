"""Byte-level BPE encoding and decoding with a given rank file.

Pre-tokenisation works on arrays. Every code point has a class (letter, number,
white space, space, other, and apostrophes that a contraction follows); a class
is a function from states to states. These functions form a small monoid, so
prefixes are composed by table look-ups in rows of fixed width, the rows'
totals are scanned in the same way, and the states before and after each code
point say where pieces begin. The white-space rule looks one code point ahead.
The slices are encoded by pair merging and remembered up to a bound; their
offsets are kept, and ids are decoded through the table of token bytes.

Defined cases: a NULL text is empty; an empty text has no ids; a NULL doc_id is
carried through; repeated rows are encoded each; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from segmentry.llm.common import texts

# The code points of the White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that an apostrophe makes a piece of their own with.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

CLASSES = ("letter", "number", "other", "white", "space", "short", "long", "reset")
LETTER, NUMBER, OTHER, WHITE_, SPACE, SHORT, LONG, RESET = range(8)
# The state after a code point. ONE and TWO: so many letters of a contraction follow; DONE: it ended.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_WHITE, AFTER_SPACE, ONE, TWO, DONE = range(9)
WIDTH = 64
REMEMBERED = 250_000
SLICE_CHARS = 1_000_000


def _steps() -> np.ndarray:
    """Next state by class and state."""
    out = np.zeros((8, 9), dtype=np.uint8)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER), (WHITE_, AFTER_WHITE),
                          (SPACE, AFTER_SPACE), (RESET, BEGIN)):
        out[symbol] = state
    out[LETTER, ONE], out[LETTER, TWO] = DONE, ONE
    for symbol, state in ((SHORT, ONE), (LONG, TWO)):
        out[symbol] = state
        # Within other signs, or with a space before, an apostrophe is one more sign.
        out[symbol, [IN_OTHER, AFTER_SPACE]] = IN_OTHER
    return out


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(function by class, product of two functions, state by function and state)."""
    known = {tuple(range(9)): 0}
    order = [tuple(range(9))]
    symbols = [tuple(f) for f in _steps().tolist()]
    for f in order:  # grows while products are new
        for g in symbols:
            product = tuple(g[s] for s in f)
            if product not in known:
                known[product] = len(order)
                order.append(product)
    acts = np.array(order, dtype=np.uint8)
    # Every product of two elements is an element.
    product = np.array([[known[tuple(acts[g][list(f)])] for g in range(len(order))] for f in order], dtype=np.uint8)
    return np.array([known[s] for s in symbols], dtype=np.uint8), product, acts


@lru_cache(1)
def starts_piece() -> np.ndarray:
    """Whether a piece begins with a code point, by the states before and after it."""
    out = np.ones((9, 9), dtype=bool)
    for state in (IN_LETTERS, IN_NUMBERS, IN_OTHER):
        out[state, state] = out[AFTER_SPACE, state] = False
    out[[[ONE], [TWO]], [ONE, DONE]] = False
    for before in (AFTER_WHITE, AFTER_SPACE):  # white space goes on
        out[before, [AFTER_WHITE, AFTER_SPACE]] = False
    return out


@lru_cache(1)
def code_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], dtype=np.uint8)
    out[WHITE] = WHITE_
    out[0x20] = SPACE
    return out


def scan(functions: np.ndarray) -> np.ndarray:
    """State after each element, from BEGIN: prefix products in rows, then of the rows' totals."""
    _, product, acts = monoid()
    n = len(functions)
    if n <= WIDTH:
        out, state = np.empty(n, dtype=np.uint8), BEGIN
        for i, f in enumerate(functions.tolist()):
            out[i] = state = acts[f, state]
        return out
    rows = -(-n // WIDTH)
    grid = np.zeros((WIDTH, rows), dtype=np.uint8)  # function 0 is the identity
    grid.T.flat[:n] = functions
    for i in range(1, WIDTH):
        grid[i] = product[grid[i - 1], grid[i]]
    before = np.append(np.uint8(BEGIN), scan(grid[-1].copy())[:-1])
    return acts[grid, before].T.ravel()[:n]


def boundaries(whole: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(the texts joined by a separator, starts of the pieces in it, piece counts by text)."""
    line = "\0".join(whole) + "\0"
    codes = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in whole]) - 1
    kinds = code_classes()[codes]
    for at in np.nonzero(codes == ord("'"))[0].tolist():
        for ending in ENDINGS:
            if line.startswith(ending, at + 1):
                kinds[at] = (SHORT, LONG)[len(ending) - 1]
                break
    kinds[ends] = RESET
    after = scan(monoid()[0][kinds])
    before = np.append(np.uint8(BEGIN), after[:-1])
    begins = starts_piece()[before, after]
    # The last white space before another sign stands alone, or with that sign.
    white = (kinds == WHITE_) | (kinds == SPACE)
    begins[:-1] |= white[:-1] & ~white[1:] & (kinds[1:] != RESET)
    begins[ends] = False
    starts = np.nonzero(begins)[0]
    return line, starts, np.diff(np.searchsorted(starts, ends), prepend=0)


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pieces(dict):
    """Ids of pieces as little-endian 32-bit numbers, by the piece; the last ones used are kept."""

    def __init__(self, table: dict[bytes, int], most: int = REMEMBERED):
        super().__init__()
        self.table, self.most, self.older = table, most, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = self.merged(piece.encode())
        self[piece] = found
        return found

    def merged(self, piece: bytes) -> bytes:
        if (whole := self.table.get(piece)) is not None:
            return whole.to_bytes(4, "little")
        parts = [piece[i : i + 1] for i in range(len(piece))]
        parts = self.merged_long(parts) if len(parts) > 100 else self.merged_short(parts)
        return b"".join([self.table[p].to_bytes(4, "little") for p in parts])

    def merged_short(self, parts: list[bytes]) -> list[bytes]:
        """Merge the pair of least rank, the first of equals, until no pair has a rank."""
        rank, none = self.table.get, len(self.table) + 2**31
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return parts

    def merged_long(self, parts: list[bytes]) -> list[bytes]:
        """The same by a heap over a linked list, for pieces of any length."""
        rank, n = self.table.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < n and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [p for p in parts if p]


def encoded(whole: list[str], pieces: Pieces) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text: its ids as bytes, and the code-point offsets of its pieces."""
    low = 0
    while low < len(whole):
        high, chars = low, 0
        while high < len(whole) and (high == low or chars + len(whole[high]) <= SLICE_CHARS):
            chars += len(whole[high])
            high += 1
        line, starts, counts = boundaries(whole[low:high])
        first, begin = 0, 0
        for text, count in zip(whole[low:high], counts.tolist(), strict=True):
            own = starts[first : first + count]
            cuts = own.tolist() + [begin + len(text)]
            slices = [line[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            yield b"".join(map(pieces.__getitem__, slices)), own - begin
            first, begin = first + count, begin + len(text) + 1
        low = high


def decoded(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, decoded from its ids; ``with_ids``:
    also ids array<int> and offsets array<int>, where each piece begins.

    ``path`` names a rank file; the file's table (bounded by its vocabulary) goes to the tasks.
    """
    table = ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, tokens = Pieces(table), [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        for batch in batches:
            for part in (batch.slice(i, 1_000) for i in range(0, batch.num_rows, 1_000)):
                done = list(encoded(part.column("text").to_pylist(), pieces))
                columns = [
                    part.column("doc_id"), pa.array([len(i) // 4 for i, _ in done], pa.int64()),
                    pa.array([sha256(i).hexdigest() for i, _ in done], pa.string()),
                    pa.array([sha256(decoded(i, tokens)).hexdigest() for i, _ in done], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(_lists([np.frombuffer(i, dtype="<u4").astype(np.int32) for i, _ in done]))
                    columns.append(_lists([o.astype(np.int32) for _, o in done]))
                    names += ["ids", "offsets"]
                yield pa.RecordBatch.from_arrays(columns, names)

    def _lists(arrays: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)),
            pa.array(np.concatenate([np.empty(0, np.int32), *arrays])))

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return texts(docs).mapInArrow(run, schema + ", ids array<int>, offsets array<int>" * with_ids)
