"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Codepoint classes are looked up in one array. Where tokens start depends on a small automaton over the classes;
each class is a function from states to states, functions compose associatively, and a blocked scan over the
composition table gives the state before every character. No regular expression runs.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm.recent import Recent

#: Default rank file; a parameter of every operator here.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Characters of a slice that is scanned at once, and of a block of the scan.
_SLICE, _BLOCK = 1_000_000, 256
#: Stands between two texts; no valid text holds it.
_GAP = "\ud800"

# Classes of characters. QUOTE1 and QUOTE2 are apostrophes before a contraction of one or two letters; INNER is
# white space before white space or the end, LAST_SPACE and LAST_OTHER are white space before anything else.
_LETTER, _NUMBER, _OTHER, _QUOTE, _SPACE, _WHITE, _END = range(7)
_QUOTE1, _QUOTE2, _INNER, _LAST_SPACE, _LAST_OTHER = range(7, 12)
# States: within letters, numbers, others; after a space that the next token takes; before a new token; within
# white space; one or two letters of a contraction to come.
_L, _N, _O, _S, _NEW, _I, _C1, _C2 = range(8)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, _OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            table[cp] = _LETTER if kind == "L" else _NUMBER
    for cp in (*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[cp] = _WHITE
    table[ord("'")], table[ord(" ")], table[ord(_GAP)] = _QUOTE, _SPACE, _END
    return table


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this character."""
    if kind in (_LETTER, _NUMBER, _OTHER, _QUOTE):
        to = {_LETTER: _L, _NUMBER: _N}.get(kind, _O)
        if state in (_C1, _C2):
            return (_NEW if state == _C1 else _C1), False
        return to, state not in (to, _S)
    if kind in (_QUOTE1, _QUOTE2):
        if state in (_O, _S):
            return _O, False
        return (_C1 if kind == _QUOTE1 else _C2), True
    if kind == _INNER:
        return _I, state != _I
    return {_LAST_SPACE: _S, _LAST_OTHER: _NEW}.get(kind, _NEW), True


@lru_cache(1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function of each class, composition of two functions, state after a function, and token starts."""
    basic = [tuple(_step(s, k)[0] for s in range(8)) for k in range(12)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *basic]))}
    queue = list(known)
    while queue:
        f = queue.pop()
        for g in basic:
            if (h := tuple(g[s] for s in f)) not in known:
                known[h] = len(known)
                queue.append(h)
    funcs = list(known)
    compose = np.zeros((len(funcs), len(funcs)), np.uint8)
    for i, f in enumerate(funcs):
        for j, g in enumerate(funcs):
            compose[i, j] = known[tuple(g[s] for s in f)]
    after = np.array(funcs, np.uint8)
    starts = np.array([[_step(s, k)[1] for k in range(12)] for s in range(8)])
    return np.array([known[f] for f in basic], np.uint8), compose, after, starts


def token_starts(cp: np.ndarray) -> np.ndarray:
    """True at each code point where a pre-token starts."""
    n = len(cp)
    if not n:
        return np.zeros(0, bool)
    kind = _classes()[cp]
    one, two = np.full(n, ord(_GAP), np.uint32), np.full(n, ord(_GAP), np.uint32)
    one[:-1], two[:-2] = cp[1:], cp[2:]
    after = np.full(n, _END, np.uint8)
    after[:-1] = kind[1:]
    white = (kind == _SPACE) | (kind == _WHITE)
    inner = white & ((after == _SPACE) | (after == _WHITE) | (after == _END))
    at = np.flatnonzero(kind == _QUOTE)
    a, b = one[at], two[at]
    short = np.isin(a, [ord(c) for c in "stmd"])
    long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    kind[white & (kind == _SPACE)] = _LAST_SPACE
    kind[kind == _WHITE] = _LAST_OTHER
    kind[inner] = _INNER
    kind[at[short]], kind[at[long]] = _QUOTE1, _QUOTE2

    function, compose, apply, starts = _automaton()
    size = len(compose)
    flat, states = compose.ravel(), apply.ravel()
    blocks = -(-n // _BLOCK)
    scan = np.zeros(blocks * _BLOCK, np.uint8)  # function 0 is the identity
    scan[:n] = function[kind]
    scan = np.ascontiguousarray(scan.reshape(blocks, _BLOCK).T)
    for j in range(1, _BLOCK):
        scan[j] = flat[scan[j - 1].astype(np.uint16) * size + scan[j]]
    total, hop = scan[-1].copy(), 1
    while hop < blocks:
        total[hop:] = flat[total[:-hop].astype(np.uint16) * size + total[hop:]]
        hop *= 2
    enter = np.full(blocks, _NEW, np.uint8)
    enter[1:] = states[total[:-1].astype(np.uint16) * 8 + _NEW]
    before = np.empty_like(scan)
    before[0] = enter
    before[1:] = states[scan[:-1].astype(np.uint16) * 8 + enter]
    before = np.ascontiguousarray(before.T).ravel()[:n]
    return starts.ravel()[before.astype(np.uint16) * 12 + kind]


class _Ranks(Recent):
    """Token ids, little-endian and 32 bits each, of slices of text seen so far."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.uint32)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until no pair has a rank."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 200:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (low := min(pairs)) < 1 << 30:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap, for runs without a boundary that may be very long."""
        import heapq

        n, ranks = len(piece), self.ranks
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if gone[i] or j >= n or gone[j] or after[i] != j or end[j] != stop:
                continue
            gone[j], end[i], after[i] = 1, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, after[i], end[after[i]]))
            if (b := before[i]) >= 0 and (r := ranks.get(piece[b:stop])) is not None:
                heapq.heappush(heap, (r, b, i, stop))
        return [ranks[piece[i : end[i]]] for i in range(n) if not gone[i]]

    def make(self, text: str) -> bytes:
        return array("I", self.merge(text.encode())).tobytes()

    def __missing__(self, text: str) -> bytes:
        return super().__missing__(text) if len(text) < 64 else self.make(text)


@lru_cache(4)
def _ranks(path: str) -> _Ranks:
    return _Ranks(path)


def encode_texts(texts: list[str], path: str = RANKS) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    ranks, out = _ranks(path), []
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < _SLICE):
            size += len(texts[upto]) + 1
            upto += 1
        joined = _GAP.join([*texts[at:upto], ""])
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.flatnonzero(token_starts(cp))
        gaps = np.flatnonzero(cp[starts] == ord(_GAP))
        cuts = starts.tolist()
        first = 0
        for gap in gaps.tolist():
            out.append(b"".join([ranks[joined[a:b]] for a, b in zip(cuts[first:gap], cuts[first + 1 : gap + 1], strict=True)]))
            first = gap + 1
        at = upto
    return out


def decode_ids(ids: bytes, path: str = RANKS) -> bytes:
    """Bytes of a sequence of ids."""
    return b"".join(map(_ranks(path).tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def token_offsets(ids: bytes, path: str = RANKS) -> bytes:
    """Where each token starts among the decoded bytes, as little-endian unsigned 64-bit integers."""
    ends = np.cumsum(_ranks(path).lengths[np.frombuffer(ids, "<u4")], dtype="<u8")
    return (np.concatenate([np.zeros(1, "<u8"), ends[:-1]]) if len(ends) else ends).tobytes()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS, decoded: bool = False) -> DataFrame:
    """Encode whole texts; a null text counts as empty and has no ids.

    Returns ``doc_id, ids, offsets`` per row, both binary: ids as little-endian unsigned 32-bit integers and the
    byte where each token starts as 64-bit ones; with ``decoded`` also the bytes decoded from the ids. Repeated
    rows and null ids stay as they are; other columns of ``docs`` are left out; an empty table gives no rows.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("ids", pa.binary()), pa.field("offsets", pa.binary())]
    schema = pa.schema([*fields, pa.field("decoded", pa.binary())][: 4 if decoded else 3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encode_texts([t or "" for t in part.column(1).to_pylist()], path)
                columns = [part.column(0), pa.array(ids, pa.binary()), pa.array([token_offsets(i, path) for i in ids], pa.binary())]
                if decoded:
                    columns.append(pa.array([decode_ids(i, path) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, ids binary, offsets binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """``doc_id, decoded`` of rows that hold ``ids``; null ids decode to nothing."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([decode_ids(i or b"", path) for i in part.column(1).to_pylist()], pa.binary())], schema=schema)

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")
