"""The splitting pattern of byte-level BPE as a finite-state transducer.

The pattern cuts a text into pieces (contractions, words, numbers, punctuation, runs
of white space). Here it is compiled into a deterministic transducer over character
classes: each transition is annotated with the cuts it emits - before the character
read, before the one already read, or both, since a run of spaces or a contraction is
decided one character late. The number of cuts is the number of pieces.

A slice of texts is run in parallel: it is cut into chunks of equal length; every chunk
is run from all states at once, which gives its state map; the maps compose
associatively, so a prefix scan by doubling yields the state in which each chunk is
entered; one more run from those states gives the cuts. Chunks need not end between
words. All steps are numpy gathers over all chunks of the slice.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

# Character classes. SHORT completes a contraction of one letter ('s 't 'm 'd).
LETTER, SHORT, R, V, E, L, NUMBER, PUNCT, APOS, SPACE, BLANK, END = range(12)
CHUNK = 64
BEFORE, EARLIER = 1, 2  # a cut before this character; a cut before the previous one

(START, WORD, NUM, SIGN, QUOTE, Q_R, Q_V, Q_L, SP1, SP, BL1, BL) = range(12)


@functools.cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, PUNCT, dtype=np.uint8)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
    everything = points.tobytes().decode("utf-32-le")
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for m in regex.finditer(pattern, everything):
            table[points[m.start():m.end()]] = kind
    for chars, kind in (("stmd", SHORT), ("r", R), ("v", V), ("e", E), ("l", L), ("'", APOS), (" ", SPACE)):
        table[[ord(c) for c in chars]] = kind
    return table


def _opens(kind: int) -> int:
    """The state after a character that begins a piece."""
    if kind in (LETTER, SHORT, R, V, E, L):
        return WORD
    return {NUMBER: NUM, PUNCT: SIGN, APOS: QUOTE, SPACE: SP1, BLANK: BL1, END: START}[kind]


def _transition(state: int, kind: int) -> tuple[int, int]:
    """(next state, cuts) on reading a character of this class."""
    fresh, letter, white = _opens(kind), kind <= L, kind in (SPACE, BLANK)
    sign = kind in (PUNCT, APOS)
    if state == START:
        return fresh, BEFORE
    if state == WORD:
        return (WORD, 0) if letter else (fresh, BEFORE)
    if state == NUM:
        return (NUM, 0) if kind == NUMBER else (fresh, BEFORE)
    if state == SIGN:
        return (SIGN, 0) if sign else (fresh, BEFORE)
    if state == QUOTE:  # an apostrophe that begins a piece
        if kind == SHORT:
            return START, 0
        if kind in (R, V, L):
            return {R: Q_R, V: Q_V, L: Q_L}[kind], 0
        return (SIGN, 0) if sign else (fresh, BEFORE)
    if state in (Q_R, Q_V, Q_L):
        if kind == (L if state == Q_L else E):
            return START, 0
        return (WORD, EARLIER) if letter else (fresh, EARLIER | BEFORE)
    if white:
        return (SP if kind == SPACE else BL), 0
    if kind == END:  # white space up to the end is one piece
        return START, BEFORE
    if state in (SP1, SP):  # the last space joins what follows
        return (SIGN if sign else fresh), (EARLIER if state == SP else 0)
    return fresh, BEFORE | (EARLIER if state == BL else 0)


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and cuts, indexed by state * classes + class."""
    both = [_transition(s, k) for s in range(12) for k in range(12)]
    return np.array([b[0] for b in both], np.uint8), np.array([b[1] for b in both], np.uint8)


def entry_states(chunks: np.ndarray) -> np.ndarray:
    """The state in which each chunk is entered; ``chunks`` is (length, chunks)."""
    step = tables()[0]
    maps = np.repeat(np.arange(12, dtype=np.uint8)[:, None], chunks.shape[1], axis=1)
    for kinds in chunks:
        maps = step[maps * np.uint8(12) + kinds]
    # Inclusive scan: after the round with distance d, column i maps through chunks i-2d+1..i.
    d = 1
    while d < maps.shape[1]:
        later = np.take_along_axis(maps[:, d:], maps[:, :-d].astype(np.intp), axis=0)
        maps = np.concatenate([maps[:, :d], later], axis=1)
        d *= 2
    return np.concatenate([[START], maps[START, :-1]]).astype(np.uint8)


def cut(kinds: np.ndarray) -> np.ndarray:
    """Where pieces begin, as a flag for every character class of the input; an END
    begins a piece of its own."""
    n = len(kinds)
    if not n:
        return np.zeros(0, dtype=bool)
    padded = np.full(-(-n // CHUNK) * CHUNK, END, dtype=np.uint8)
    padded[:n] = kinds
    chunks = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
    step, emits = tables()
    state = entry_states(chunks)
    marks = np.empty(chunks.shape, dtype=np.uint8)
    for i, own in enumerate(chunks):
        at = state * np.uint8(12) + own
        marks[i] = emits[at]
        state = step[at]
    marks = marks.T.reshape(-1)
    begins = (marks & BEFORE).astype(bool)
    begins[:-1] |= (marks[1:] & EARLIER).astype(bool)
    return begins[:n]


def pieces(raw: np.ndarray, offsets: np.ndarray, special: str | None = None):
    """The pieces of a slice of texts: (string, starts, ends, row of each, special
    tokens per row). ``special`` is cut out as a token of its own and splits a text."""
    data = raw.tobytes()
    text = data.decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    rows = len(offsets) - 1
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])[offsets]
    # One END after each text.
    kinds = np.full(len(points) + rows, END, dtype=np.uint8)
    inside = np.ones(len(kinds), dtype=bool)
    inside[heads[1:] + np.arange(rows)] = False
    own = class_table()[points]
    extra = np.zeros(rows, dtype=np.int64)
    if special and special in text:
        at = text.find(special)
        while at >= 0:
            row = int(np.searchsorted(heads, at, side="right")) - 1
            while heads[row + 1] <= at:
                row += 1
            if at + len(special) <= heads[row + 1]:
                own[at:at + len(special)] = END
                extra[row] += 1
                at = text.find(special, at + len(special))
            else:
                at = text.find(special, at + 1)
    kinds[inside] = own
    begins = np.flatnonzero(cut(kinds))
    ends = np.concatenate([begins[1:], [len(kinds)]]).astype(np.int64)
    real = kinds[begins] != END
    begins, ends = begins[real], ends[real]
    row = np.searchsorted(heads[1:] + np.arange(rows), begins, side="right")
    return text, begins - row, ends - row, row, extra
