"""Byte-level BPE by backtracking over the matches of an Aho-Corasick automaton.

A text is cut by the vocabulary's pattern; each piece is encoded by itself.  A piece
that is a token is that token.  Any other piece gets the one sequence of tokens in which
all neighbours are *compatible*: two tokens are when merging their joined bytes
gives back just these two.  That sequence is what the merges give, and it is found
from left to right:

*   The vocabulary, its bytes mapped to Latin-1 characters, is one pyahocorasick
    automaton.  A single pass over the piece notes the longest token at each byte.
*   From there the next token is the longest that is compatible with its left
    neighbour and doesn't end at a place already found to lead nowhere; if no
    shorter prefix is left either, the place is marked and the left neighbour gives way.
    Every place is marked once at most, and tokens have a bounded length, so the work
    is linear in the piece.
*   Compatibility follows the two tokens' own merges along their common border, a step a
    merge.  It, the merges and the next shorter prefix are memoised by token, short pieces by
    their text, each up to a fixed number of entries.

Tokens that the merges never give for their own bytes take part only as whole pieces.

The vocabulary's path is a parameter.  The driver reads the file (at most
``MAX_FILE`` bytes) and broadcasts it; workers read no file.

Ids are packed as little-endian unsigned 32-bit integers, as training shards hold them.
Null text is the empty text, without ids.  Bytes that aren't UTF-8 are read as U+FFFD.  Long
texts are encoded whole.  Rows are independent: repeated rows and ids give repeated
results, an empty table an empty one, ids pass as they are; no other column is used.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship

#: Largest vocabulary file that is broadcast.
MAX_FILE = 64 << 20
#: Memoised pieces and token pairs of a worker, and the longest piece that is memoised.
PIECES, PAIRS, PIECE_CHARS = 1 << 19, 1 << 20, 48
#: Text bytes of one emitted batch.
BATCH_BYTES = 8 << 20
#: Above every rank, and the halves of a token that the merges never give.
NO_MERGE, NEVER = 1 << 32, (-1, -1)


class _Filled(dict):
    """A dict that computes missing values.  Once half its room is full, what it holds becomes
    the old half: values asked for again come back from there, the others are forgotten."""

    def __init__(self, compute: Callable, room: int, fits: Callable | None = None):
        super().__init__()
        self._compute, self._half, self._fits, self._old = compute, max(1, room // 2), fits, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
            if self._fits is not None and not self._fits(key):
                return value
        if len(self) >= self._half:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """Encoder and decoder of one rank file (base64 token and rank a line)."""

    def __init__(self, data: bytes, pattern: str):
        self.rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}
        self.token = {r: t for t, r in self.rank.items()}
        self.pieces = regex.compile(pattern)
        self.machine = ahocorasick.Automaton()
        for t, r in self.rank.items():
            if t:
                self.machine.add_word(t.decode("latin-1"), (r, len(t)))
        self.machine.make_automaton()
        self.halves = _Filled(self._halves, PAIRS)
        self.given = _Filled(lambda r: self.halves[r] is not NEVER, PAIRS)
        self.in_order = _Filled(self._in_order, PAIRS)
        self.left = _Filled(lambda r: self._edge(r, 0), PAIRS)
        self.right = _Filled(lambda r: self._edge(r, 1), PAIRS)
        self.compatible = _Filled(self._compatible, PAIRS)
        self.shorter = _Filled(self._shorter, PAIRS)
        self.packed = _Filled(self._packed, PIECES, lambda piece: len(piece) <= PIECE_CHARS)

    def merged(self, data: bytes, stop: int | None = None) -> list[int]:
        """The merges themselves, lowest rank first and leftmost on ties, for the few bytes
        of a token; up to, and without, the merge to ``stop``."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            least = min((r for r in ranks if r >= 0), default=-1)
            if least < 0 or least == stop:
                break
            i = ranks.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def _halves(self, r: int) -> tuple[int, ...]:
        """The two tokens whose merge gives this one, none for a single byte, ``NEVER`` where
        the merges of its bytes don't end in it."""
        if len(self.token[r]) == 1:
            return ()
        parts = tuple(self.merged(self.token[r], r))
        return parts if len(parts) == 2 else NEVER

    def _in_order(self, r: int) -> bool:
        """Whether a token and all its parts rank after their own parts, as training leaves them."""
        parts = self.halves[r]
        return parts is not NEVER and all(x < r and self.in_order[x] for x in parts)

    def _edge(self, r: int, side: int) -> tuple[int, ...]:
        """The tokens that stand at one end of a token while its merges go on: the byte first,
        the token itself last."""
        out = [r]
        while self.halves[out[-1]]:
            out.append(self.halves[out[-1]][side])
        return tuple(reversed(out))

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Merging the joined bytes of two tokens follows the merges of each, in order of
        rank, the left one's first on ties.  They stay apart if at no time what ends the left one and
        what begins the right one merge before either's own next merge.  Tokens that rank before
        their parts merge at other times, so theirs are carried out."""
        if not (self.in_order[pair[0]] and self.in_order[pair[1]]):
            return self.merged(self.token[pair[0]] + self.token[pair[1]]) == list(pair)
        ends, begins = self.right[pair[0]], self.left[pair[1]]
        token, rank = self.token, self.rank
        i = j = 0
        while True:
            next_a = ends[i + 1] if i + 1 < len(ends) else NO_MERGE
            next_b = begins[j + 1] if j + 1 < len(begins) else NO_MERGE
            across = rank.get(token[ends[i]] + token[begins[j]], NO_MERGE)
            if across < next_a and across <= next_b and across != NO_MERGE:
                return False
            if next_a == next_b == NO_MERGE:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _shorter(self, r: int) -> int:
        """The longest proper prefix of a token that is a token, or -1."""
        t = self.token[r]
        for n in range(len(t) - 1, 0, -1):
            s = self.rank.get(t[:n], -1)
            if s >= 0:
                return s
        return -1

    def piece(self, data: bytes) -> array:
        """Ids of one piece."""
        whole = self.rank.get(data, -1)
        if whole >= 0:
            return array("I", [whole])
        n = len(data)
        longest = [-1] * n if n <= PIECE_CHARS else array("i", [-1]) * n
        for end, (r, size) in self.machine.iter(data.decode("latin-1")):
            longest[end + 1 - size] = r        # matches come by their ends, so the longest is last
        token, compatible, shorter, given = self.token, self.compatible, self.shorter, self.given
        dead = bytearray(n + 1)
        out, at = array("I"), 0
        r = longest[0]
        while at < n:
            while r >= 0:
                end = at + len(token[r])
                if not dead[end] and given[r] and (not out or compatible[out[-1], r]):
                    break
                r = shorter[r]
            if r >= 0:
                out.append(r)
                at = end
                r = longest[at] if at < n else -1
            elif out:
                dead[at] = 1
                last = out.pop()
                at -= len(token[last])
                r = shorter[last]
            else:
                raise ValueError("the vocabulary has no token for some byte")
        return out

    def _packed(self, piece: str) -> bytes:
        ids = self.piece(piece.encode("utf-8"))
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.pieces.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[bytes, Vocabulary] = {}


def _vocabulary(data: bytes, pattern: str) -> Vocabulary:
    """Built once a worker."""
    name = hashlib.sha256(data + pattern.encode()).digest()
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Vocabulary(data, pattern)
    return _LOADED[name]


def _each(work: Callable[[Vocabulary, bytes], bytes], sent, pattern: str, name: str):
    """A mapInArrow function: all columns pass, the last (binary) is replaced by ``work`` of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(sent.value, pattern)
        for b in batches:
            values, names = b.column(b.num_columns - 1), [*b.schema.names[:-1], name]
            lo, size, out = 0, 0, []
            for i, x in enumerate(values):
                out.append(work(v, x.as_py() or b""))
                size += len(out[-1])
                if size >= BATCH_BYTES or i + 1 == len(values):
                    kept = b.slice(lo, i + 1 - lo)
                    yield pa.record_batch([*kept.columns[:-1], pa.array(out, pa.binary())], names=names)
                    lo, size, out = i + 1, 0, []
    return run


def _encoded(v: Vocabulary, data: bytes) -> bytes:
    return v.encode(data.decode("utf-8", "replace"))


def _decoded(v: Vocabulary, ids: bytes) -> bytes:
    return v.decode(ids)


def _sent(df: DataFrame, path: str):
    ship(df.sparkSession)
    with open(path, "rb") as f:
        data = f.read(MAX_FILE + 1)
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} has more than {MAX_FILE} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: the key and ``ids``, packed."""
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    d = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    out = d.mapInArrow(_each(_encoded, _sent(docs, path), pattern, "ids"), f"key {kind}, ids binary")
    return out.select(F.col("key").alias(key), "ids")


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with the column ``data``: the bytes that its packed ids stand for."""
    d = tokens.select(*[F.col(f"`{c}`") for c in tokens.columns if c != "data"], F.col(f"`{ids}`").alias("data"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)
    return d.mapInArrow(_each(_decoded, _sent(tokens, path), pattern, "data"), kinds)
