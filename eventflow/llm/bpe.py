"""Byte-level BPE encoding and decoding.

The distinct pieces of the whole corpus are counted (per batch, then by a partially combined
sum). Those frequent enough to make up a dictionary of at most ``MAX_WORDS`` are encoded by Spark
higher-order functions: a fold over the bytes of a piece, each step joining the leftmost
pair of neighbours of least rank, the ranks being a literal table of pairs. The table is laid out in
bins, since a lookup in one list would compare up to 100,000 pairs. The size of the dictionary is proven by a
histogram of the counts before it is broadcast.

Every text is then cut, a slice at a time. The distinct pieces of the slice are looked up; those outside the
dictionary are merged where they stand by the same rule, all at once in numpy (``merge_many``); and the ids
are gathered by place. Texts never move between tasks, and the result does not depend on
what the dictionary holds. Encoding every distinct piece by the fold, written as a table and joined back to the
blocks of texts, gives the same ids; the README has its figures. Equal pieces are recognised by a hash
and then compared byte by byte, so no id depends on a hash. Decoding gathers the bytes of the ids.

Ids are given as little-endian unsigned 32-bit integers in a binary column. Null and
empty texts have no ids; an empty id string decodes to an empty text. Texts are encoded
whole; special tokens are not recognised. Repeated rows are encoded alike. New columns come
last, under their names lengthened until they clash with no column. Memory follows the longest text
and the dictionary's bound.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.boundaries import pieces
from eventflow.llm.common import buffers, col, fresh, map_arrow, map_rows, range_hash, slices, write_cut

MAX_WORDS = 1 << 16
MAX_FOLDED_BYTES = 48  # of a dictionary piece; the fold is quadratic in a piece's length
MAX_KEPT = 120_000
LONG = 64  # bytes of a piece that is merged with a heap
# A pair of tokens is the number NONE + left * SIDE + right; ranks are less than SIDE.
BINS, SIDE, NONE = 32749, 1 << 21, 1 << 44


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    """The rank file: base64 of a token's bytes and its rank, which is its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_literal(path: str) -> Column:
    """The ranks as a literal: [the token of each byte], then bins of pairs of tokens, each bin
    a row of (pair, rank of the two together). A pair is written as one number."""
    rank = ranks(path)
    bins: list[list[int]] = [[] for _ in range(BINS)]
    for token, joined in rank.items():
        for i in range(1, len(token)):
            left, right = rank.get(token[:i]), rank.get(token[i:])
            if left is not None and right is not None:
                pair = NONE + left * SIDE + right
                bins[pair % BINS] += [pair, joined]
    single = [rank.get(bytes([i]), -1) for i in range(256)]
    return F.from_json(F.lit(json.dumps([single, *bins])), "array<array<bigint>>")


def _joined(table: Column, left: Column, right: Column) -> Column:
    """The rank of two neighbours together; NONE or more if they make no token."""
    pair = left * SIDE + right + NONE
    # The number after the pair; without the pair, the bin's first number, which is a pair.
    return F.transform(F.array(pair), lambda p: F.transform(F.array(F.get(table, (p % BINS + 1).cast("int"))), lambda own: F.coalesce(
        F.get(own, F.array_position(own, p).cast("int")), F.lit(NONE)))[0])[0]


def fold(word: Column, table: Column) -> Column:
    """The token ids of a piece (binary): ranked merges folded over its bytes. The table stands once
    in the plan, whose text the driver keeps."""
    return F.transform(F.array(table), lambda t: _fold(word, t))[0]


def _fold(word: Column, table: Column) -> Column:
    size = F.length(word)
    bytes_ = F.get(table, F.lit(0))

    def byte(i: Column) -> Column:
        return F.get(bytes_, F.ascii(F.decode(F.substring(word, i, F.lit(1)), "ISO-8859-1")))

    def ranked(parts: Column) -> Column:
        return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: _joined(
            table, F.get(parts, i - 1), F.get(parts, i)))).otherwise(F.array(F.lit(NONE)))

    def step(acc: Column, _) -> Column:
        parts, found = acc["parts"], acc["ranks"]

        def merge(at: Column) -> Column:  # at: the first of the least, from 1
            least, n = F.get(found, at - 1), F.size(parts)
            beside = F.array_compact(F.array(
                F.when(at > 1, _joined(table, F.get(parts, at - 2), least)),
                F.when(at + 1 < n, _joined(table, least, F.get(parts, at + 1)))))
            new = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(least), F.slice(parts, at + 2, n))
            around = F.concat(F.slice(found, F.lit(1), F.greatest(at - 2, F.lit(0))), beside, F.slice(found, at + 2, n))
            return F.struct(new.alias("parts"), F.when(n > 2, around).otherwise(F.array(F.lit(NONE))).alias("ranks"))

        def onward(least: Column) -> Column:
            place = F.array_position(found, least).cast("int")
            return F.when(least >= NONE, acc).otherwise(F.transform(F.array(place), merge)[0])

        return F.transform(F.array(F.array_min(found)), onward)[0]

    single = F.transform(F.sequence(F.lit(1), size), byte)
    start = F.transform(F.array(single), lambda q: F.struct(q.alias("parts"), ranked(q).alias("ranks")))[0]
    steps = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))
    done = F.aggregate(steps, start, step, lambda acc: F.transform(acc["parts"], lambda p: p.cast("int")))
    return F.when(size > 0, done).otherwise(F.array().cast("array<int>"))


def merge_bytes(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """The same fold in plain Python, for a long piece: the pairs wait in a heap, so n bytes
    take O(n log n)."""
    n = len(word)
    right = list(range(1, n + 1))          # where the next part begins
    left = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or right[i] >= n or right[right[i]] != end:
            continue  # one of the two parts has changed since
        gone = right[i]
        alive[gone], right[i] = False, end
        if end < n:
            left[end] = i
            if (r := rank.get(word[i:right[end]])) is not None:
                heapq.heappush(heap, (r, i, right[end]))
        if (j := left[i]) >= 0 and (r := rank.get(word[j:end])) is not None:
            heapq.heappush(heap, (r, j, end))
    out, i = [], 0
    while i < n:
        out.append(rank[word[i:right[i]]])
        i = right[i]
    return out


class Pairs:
    """The pairs of tokens that make a token, as a hash table for lookups of many pairs at once."""

    BITS, ODD = 20, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        rank = ranks(path)
        self.rank = rank
        self.single = np.array([rank.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        found = {left * SIDE + right: joined for token, joined in rank.items() for i in range(1, len(token))
                 if (left := rank.get(token[:i])) is not None and (right := rank.get(token[i:])) is not None}
        bits = max(self.BITS, (8 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair, self.joined = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NONE, dtype=np.int64)
        for pair, at in zip(found, self._place(np.array(list(found), dtype=np.int64)).tolist()):
            while self.pair[at] >= 0:
                at = (at + 1) & self.mask
            self.pair[at], self.joined[at] = pair, found[pair]

    def _place(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * self.ODD) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of neighbours together; NONE where they make no token."""
        pair = left * SIDE + right
        at = self._place(pair)
        there = self.pair[at]
        out = np.where(there == pair, self.joined[at], NONE)
        on = np.flatnonzero((there != pair) & (there >= 0))  # places taken by another pair
        while len(on):
            at[on] = (at[on] + 1) & self.mask
            there = self.pair[at[on]]
            hit = there == pair[on]
            out[on[hit]] = self.joined[at[on[hit]]]
            on = on[~hit & (there >= 0)]
        return out


@functools.cache
def pairs_of(path: str) -> Pairs:
    return Pairs(path)


def merge_many(words: list[bytes], pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces one after the other, how many each has): the fold, a step of all pieces
    at a time. A piece that is done leaves; only the neighbours of a merge are looked up again."""
    width = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    place = np.cumsum(width) - width  # a piece has at most as many ids as bytes
    ids, sizes = np.zeros(len(data), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    for i in np.flatnonzero(width > LONG).tolist():
        done = merge_bytes(words[i], pairs.rank)
        ids[place[i]:place[i] + len(done)], sizes[i] = done, len(done)
    own = np.flatnonzero((width > 0) & (width <= LONG))
    size = width[own]
    part = pairs.single[_gather(data, place[own], size)]
    # rank[j]: of parts j and j + 1 of one piece; NONE at a piece's last part.
    rank = np.full(len(part), NONE, dtype=np.int64)
    heads = np.cumsum(size) - size
    inner = np.ones(len(part), dtype=bool)
    inner[heads + size - 1] = False
    at = np.flatnonzero(inner)
    rank[at] = pairs(part[at], part[at + 1])
    while len(own):
        least = np.minimum.reduceat(rank, heads)
        active = least < NONE
        if not active.all():
            over, done = np.repeat(~active, size), size[~active]
            ends = np.cumsum(done)
            ids[np.repeat(place[own[~active]] - (ends - done), done) + np.arange(int(ends[-1]))] = part[over]
            sizes[own[~active]] = done
            part, rank = part[~over], rank[~over]
            own, size, least = own[active], size[active], least[active]
            heads = np.cumsum(size) - size
            if not len(own):
                break
        hit = np.flatnonzero(rank == np.repeat(least, size))
        if len(hit) > len(own):  # the leftmost of each piece
            piece = np.searchsorted(heads, hit, side="right")
            hit = hit[np.append(True, piece[1:] != piece[:-1])]
        part[hit] = least
        keep = np.ones(len(part), dtype=bool)
        keep[hit + 1] = False
        rank[hit] = rank[hit + 1]  # NONE if the merged part is the last
        moved = hit - np.arange(len(hit))
        part, rank, size = part[keep], rank[keep], size - 1
        heads = np.cumsum(size) - size
        more, before = moved[moved < heads + size - 1], moved[moved > heads]
        rank[more] = pairs(part[more], part[more + 1])
        rank[before - 1] = pairs(part[before - 1], part[before])
    return _gather(ids, place, sizes), sizes


def distinct(raw: np.ndarray, offsets: np.ndarray, exact: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pieces of a slice of texts, the place of each piece among them, pieces per text).
    Not ``exact``: pieces of one hash count as equal, which is enough to choose a dictionary."""
    _, starts, ends, row, _ = pieces(raw, offsets)
    heads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # characters to bytes
    starts, ends = heads[starts], heads[ends]
    _, first, back = np.unique(range_hash(raw, starts, ends), return_index=True, return_inverse=True)
    data = raw.tobytes()
    count = np.bincount(row, minlength=len(offsets) - 1)
    if not exact or _equal(raw, starts, ends, starts[first][back], ends[first][back]):
        return [data[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], back, count
    known: dict[bytes, int] = {}  # two pieces with one hash: no hash then
    back = np.array([known.setdefault(data[i:j], len(known)) for i, j in zip(starts.tolist(), ends.tolist())])
    return list(known), back, count


def _equal(raw: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> bool:
    """Whether ranges of bytes are equal, pair by pair."""
    size = a_end - a
    if not np.array_equal(size, b_end - b):
        return False
    other = np.flatnonzero(a != b)
    a, b, size = a[other], b[other], size[other]
    along = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return bool(np.array_equal(raw[np.repeat(a, size) + along], raw[np.repeat(b, size) + along]))


def count_pieces(docs: DataFrame, text: str) -> DataFrame:
    """(word binary, n): the distinct pieces of all texts and how often each occurs."""
    src = docs.select(col(text).cast("string").alias("_text"))

    def run(batches):
        seen: dict[bytes, int] = {}

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                             names=["word", "n"])
            seen.clear()

        for batch in batches:
            raw, offsets = buffers(batch.column(0))
            for a, b in slices(offsets):
                words, back, _ = distinct(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], exact=False)
                for w, n in zip(words, np.bincount(back, minlength=len(words)).tolist()):
                    seen[w] = seen.get(w, 0) + n
                if len(seen) > MAX_KEPT:
                    yield from flush()
        yield from flush()

    counted = map_arrow(src, run, T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, path: str, text: str = "text",
               max_words: int = MAX_WORDS) -> DataFrame:
    """(word, ids): at most ``max_words`` of the most frequent pieces, encoded."""
    counted = write_cut(count_pieces(docs, text).where(F.length("word") <= MAX_FOLDED_BYTES), "pieces")
    # Pieces by the power of two of their count: the least power with which all above fit.
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    histogram = {r[0]: r[1] for r in counted.groupBy(power.alias("p")).count().collect()}  # 64 rows
    total, least = 0, 64
    while least > 0 and total + histogram.get(least - 1, 0) <= max_words:
        least -= 1
        total += histogram.get(least, 0)
    return counted.where(power >= least).select("word", fold(F.col("word"), rank_literal(path)).alias("ids"))


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column from the bytes of all its values."""
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(flat)]).cast(pa.binary())


def _packed(words: DataFrame) -> list[list[bytes]]:
    """A dictionary (word, ids) as a few packed parts: its rows never stand on the driver one by one."""
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            own = [w or b"" for w in batch.column(0).to_pylist()]
            parts = [np.array([len(w) for w in own], "<i4").tobytes(), b"".join(own),
                     np.asarray(lists.value_lengths()).astype("<i4").tobytes(), lists.flatten().to_numpy().astype("<u4").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=list("abcd"))

    packed = words.mapInArrow(run, "a binary, b binary, c binary, d binary")
    return [[bytes(r[i]) for i in range(4)] for r in packed.collect()]  # at most max_words in all


def _unpacked(parts: list[list[bytes]]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """(place of each word, ids of all words one after the other, how many each has)."""
    place: dict[bytes, int] = {}
    for lengths, joined, _, _ in parts:
        ends = np.cumsum(np.frombuffer(lengths, "<i4").astype(np.int64)).tolist()
        for a, b in zip([0, *ends], ends):
            place[joined[a:b]] = len(place)
    sizes = [np.frombuffer(p[2], "<i4").astype(np.int64) for p in parts]
    flat = [np.frombuffer(p[3], "<u4") for p in parts]
    return place, np.concatenate([*flat, np.zeros(0, "<u4")]), np.concatenate([*sizes, np.zeros(0, np.int64)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
           keep: list[str] | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and the ids of each whole text."""
    keep = docs.columns if keep is None else keep
    known = docs.sparkSession.sparkContext.broadcast(_packed(dictionary(docs, path, text, max_words)))
    opened: dict = {}

    def run(texts: pa.Array) -> list[pa.Array]:
        if not opened:
            opened.update(zip(("place", "flat", "sizes"), _unpacked(known.value)))
        place, own_flat, own_sizes = opened["place"], opened["flat"], opened["sizes"]
        first = np.cumsum(own_sizes) - own_sizes
        raw, offsets = buffers(texts)
        coded, counts = [], []
        for a, b in slices(offsets):
            words, back, count = distinct(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            at = np.array([place.get(w, -1) for w in words], dtype=np.int64)
            rare = np.flatnonzero(at < 0)
            more, more_sizes = merge_many([words[i] for i in rare.tolist()], pairs_of(path))
            every = np.concatenate([own_flat, more.astype("<u4")])
            begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            listed = at >= 0
            begin[listed], size[listed] = first[at[listed]], own_sizes[at[listed]]
            begin[rare], size[rare] = len(own_flat) + np.cumsum(more_sizes) - more_sizes, more_sizes
            coded.append(_gather(every, begin[back], size[back]))
            total = np.concatenate([[0], np.cumsum(size[back])])
            counts.append(np.diff(total[np.concatenate([[0], np.cumsum(count)])]))
        flat_ids = np.concatenate(coded) if coded else np.zeros(0, "<u4")
        return [_binary(flat_ids.view(np.uint8), np.concatenate(counts) * 4 if counts else np.zeros(0, np.int64))]

    return map_rows(docs, text, [T.StructField(fresh(ids, keep), T.BinaryType(), False)], run, keep)


def decode(coded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``coded`` (default: all) and the bytes that the ids stand
    for, as a binary column. A null id string gives null; an id outside the
    vocabulary fails."""
    keep = coded.columns if keep is None else keep
    own = fresh("_ids", keep)
    src = coded.select(*[col(c) for c in keep], col(ids).alias(own))
    schema = T.StructType([coded.schema[c] for c in keep] + [T.StructField(fresh(decoded, keep), T.BinaryType())])

    def run(batches):
        tokens = [t for _, t in sorted((rank, token) for token, rank in ranks(path).items())]
        numbers = np.array(sorted(ranks(path).values()), dtype=np.int64)
        place = np.full(int(numbers[-1]) + 1, -1, dtype=np.int64)
        place[numbers] = np.arange(len(numbers))
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        size = np.array([len(t) for t in tokens], dtype=np.int64)
        first = np.cumsum(size) - size
        for batch in batches:
            n = batch.num_columns - 1
            column = batch.column(n).cast(pa.large_binary())
            edges = np.frombuffer(column.buffers()[1], dtype="<i8")[column.offset:column.offset + len(column) + 1]
            data = column.buffers()[2]
            for a, b in slices(edges - edges[0]):
                coded_ids = np.frombuffer(data, dtype=np.uint8)[edges[a]:edges[b]].view("<u4") if data is not None else \
                    np.zeros(0, "<u4")
                own_place = place[coded_ids]
                if (own_place < 0).any():
                    raise ValueError("an id outside the vocabulary")
                total = np.concatenate([[0], np.cumsum(size[own_place])])[(edges[a:b + 1] - edges[a]) // 4]
                values = _binary(_gather(flat, first[own_place], size[own_place]), np.diff(total))
                nulls = column.slice(a, b - a).is_null()
                if column.null_count:
                    values = pa.compute.if_else(nulls, pa.scalar(None, pa.binary()), values)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(n)), values], names=schema.names)

    return map_arrow(src, run, schema)
