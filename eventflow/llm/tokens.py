"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers stand in series. The first
(:mod:`eventflow.llm.boundaries`) cuts a text into pieces and is run chunk by chunk,
the chunks' state maps being composed by a parallel prefix scan. The second reads a
piece byte by byte and counts its tokens: a transition is annotated with the change in
the number of tokens that one more byte makes. It starts afresh at every piece, so the
counts of pieces add up.

The second transducer follows from one fact of ranked merges: a sequence of tokens is
the encoding of its bytes exactly when each two neighbours are (:func:`Merges.adjacent`).
So the encoding of a prefix is fixed by its last token, and the last token after one
more byte is the one token ending there that can follow the last token where it begins.
What a state must know is therefore, for each of the places where a token still under way
may have begun, the last token there and how many tokens it has; places further back
no longer matter, so words with a common ending share states. States are compiled as
they are met and kept by each worker up to a bound, beyond which they are compiled anew.

Null and empty texts have 0 tokens. A special token's string inside a text is one token
and separates what is before and after. Texts are counted whole; repeated rows are
counted alike; nothing moves between tasks. Memory follows the longest text.
"""

from __future__ import annotations

import functools
import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventflow.llm.boundaries import pieces
from eventflow.llm.common import buffers, fresh, map_rows, slices

MAX_STATES = 300_000
MAX_PIECES = 300_000


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A table of ranked merges: ``pair[(left, right)]`` is the rank of a merge;
    ``parts[token]`` what it was merged from."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.token = vocabulary
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.pair.setdefault((x, y), rank)
            self.parts.setdefault(z, (x, y))
            self.made.setdefault(z, rank)
        self.prefixes = {t[:i] for t in vocabulary for i in range(1, len(t) + 1)}
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._adjacent: dict[int, bool] = {}
        self._tails: dict[bytes, tuple] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge while ``token`` is being merged, each with
        the rank of the merge that ends it."""
        chain, ends = [], math.inf
        while True:
            chain.append((token, ends))
            if token not in self.parts:
                return chain
            ends = self.made[token]
            token = self.parts[token][side]

    def adjacent(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their joint bytes: no merge
        across the border comes before the merges that build either token. Of equal
        ranks the left one comes first."""
        known = self._adjacent.get(a << 32 | b)
        if known is None:
            if len(self._adjacent) > 500_000:
                self._adjacent.clear()
            right = self._right.get(a) or self._right.setdefault(a, self._edge(a, 1))
            left = self._left.get(b) or self._left.setdefault(b, self._edge(b, 0))
            known = True
            for x, x_ends in right:
                for y, y_ends in left:
                    rank = self.pair.get((x, y))
                    if rank is not None and rank < x_ends and rank <= y_ends:
                        known = False
            self._adjacent[a << 32 | b] = known
        return known

    def tails(self, under: bytes) -> tuple[tuple[tuple[int, int], ...], int]:
        """The tokens that end ``under``, longest first, each with its place; and
        the place of the longest ending that begins some token."""
        known = self._tails.get(under)
        if known is None:
            if len(self._tails) > 200_000:
                self._tails.clear()
            ends = [(i, self.token.get(under[i:])) for i in range(len(under))]
            skip = next((i for i in range(len(under)) if under[i:] in self.prefixes), len(under))
            known = self._tails[under] = tuple(e for e in ends if e[1] is not None), skip
        return known


class Counter:
    """The lazily compiled transducer from bytes to numbers of tokens."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.reset()

    def reset(self) -> None:
        # A state: (bytes under way, last token at each place in them, its tokens
        # relative to now); the first place stands for the piece's beginning.
        first = (b"", (-1,), (0,))
        self.states, self.ids, self.moves = [first], {first: 0}, {}

    def _compile(self, state: int, byte: int) -> int:
        m = self.merges
        under, last, count = self.states[state]
        under += bytes((byte,))
        ends, skip = m.tails(under)
        for at, token in ends:
            if last[at] < 0 or m.adjacent(last[at], token):
                break
        change = count[at] + 1
        last, count = (*last[skip:], token), (*count[skip:], change)
        new = (under[skip:], last, tuple([c - change for c in count]))
        to = self.ids.get(new)
        if to is None:
            to = self.ids[new] = len(self.states)
            self.states.append(new)
        move = self.moves[state << 8 | byte] = to << 8 | change + 128
        return move

    def count(self, piece: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state = move >> 8
            total += (move & 255) - 128
        return total


class _Counts(dict):
    """Tokens of the pieces met so far."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter, self.older = counter, {}

    def __missing__(self, piece: str) -> int:
        if len(self) > MAX_PIECES:  # pieces not met since are forgotten
            self.older = dict(self)
            self.clear()
        n = self.older.get(piece)
        if n is None:
            n = self.counter.count(piece.encode())
        self[piece] = n
        return n


@functools.cache
def tokenizer(path: str) -> tuple[_Counts, str | None]:
    """The transducer of a vocabulary file of kind byte-level BPE, and its special string."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, code = spec["model"], byte_chars()
    special = [t["content"] for t in spec["added_tokens"] if t["special"]]

    def as_bytes(s: str) -> bytes:
        return bytes(code[c] for c in s)

    vocabulary = {as_bytes(t): i for t, i in model["vocab"].items() if t not in special}
    merges = [tuple(map(as_bytes, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    return _Counts(Counter(Merges(vocabulary, merges))), (special or [None])[0]


def count_batch(texts: pa.Array, path: str) -> list[pa.Array]:
    raw, offsets = buffers(texts)
    counts, special = tokenizer(path)
    out = []
    for a, b in slices(offsets):
        text, starts, ends, row, extra = pieces(
            raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], special)
        each = [counts[text[i:j]] for i, j in zip(starts.tolist(), ends.tolist())]
        out.append(np.bincount(row, weights=each, minlength=b - a).astype(np.int64) + extra)
    total = np.concatenate(out) if out else np.zeros(0, np.int64)
    return [pa.array(np.diff(offsets)), pa.array(total)]


def count_tokens(docs: DataFrame, path: str, text: str = "text", size: str = "n_bytes",
                 count: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all), the UTF-8 bytes and the tokens of
    each whole text, last and under names lengthened until they clash with no column. ``path``: the
    vocabulary file, readable by every worker."""
    taken = docs.columns if keep is None else keep
    fields = [T.StructField(fresh(n, taken), T.LongType(), False) for n in (size, count)]
    return map_rows(docs, text, fields, lambda texts: count_batch(texts, path), keep)
