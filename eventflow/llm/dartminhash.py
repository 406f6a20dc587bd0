"""MinHash near-duplicates with DartMinHash signatures.

A text is a weighted set: its shingles of five words, weighted by how often they occur.
An element owns a region of the plane, as wide as its weight and unbounded in rank.
Darts are thrown into the plane by hashing: every unit of width of every element (a
cell) has its own stream of darts, whose ranks are the arrival times of a Poisson
process drawn from the hash of cell and number. A text sees the darts that fall into its
regions. Each dart also hashes to one of the ``COORDS`` coordinates of the signature,
which keeps the earliest dart that hit it. Two texts agree on a coordinate with
probability equal to their weighted Jaccard similarity. It takes about k ln k + 2k
darts to hit k coordinates, so those up to rank (k ln k + 2k) / weight are thrown, however
long the text; the few texts with a coordinate still open throw twice as far, and so on.

Signatures are cut into ``BANDS`` bands of ``ROWS``; a pair at similarity 0.8 shares no band
with probability 2e-4. Equal texts are put together first. The members of a band's
bucket are tied to its least member, one tie each, and what ties connect is a family:
every pair that shares a bucket lies within one family. A family's members are then
compared exactly, on the shingles of both texts, in blocks of at most about ``BLOCK``
texts or ``BLOCK_CELLS`` shingles a side, so a family of any size is spread over as many
tasks as it needs; blocks give back at most one edge per text, and pairs are never
rows. Comparing whole families finds every link that a shared band promises and
some more; its cost in a family of near misses grows with the square of the family.

Words are runs of anything but white space (space, \\t, \\n, \\v, \\f, \\r), as they stand. A
text of one to four words is one shingle. A null, empty or blank text has no shingles and
belongs to a class of its own. The class id is the least document id of the class, null
when all are null; ``kept`` marks rows with that id. Repeated rows fall into one class
and are marked alike. Signatures follow the longest text in memory; nothing is collected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import Words, buffers, col, fresh, map_arrow, map_rows, mix64, slices, write_cut
from eventflow.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
ROWS, BANDS = 7, 36
COORDS = ROWS * BANDS
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BLOCK, BLOCK_CELLS = 2048, 1 << 21  # of a side of a comparison
COLUMNS = 2048
SLOTS = 1 << 22
SMALL = 64  # cells; the streams of smaller texts are drawn 64 darts at a time


def cells(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row): a hash for each unit of weight of each shingle of each text, sorted
    within a text."""
    n = len(w.starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = w.hashes()
    first = np.concatenate([[0], np.cumsum(w.per_row)])
    short = w.per_row[w.row] < SHINGLE
    # A shingle for every word with four after it in its text; for a short text, one.
    begins = np.flatnonzero(np.where(short, np.arange(n) == first[w.row],
                                     np.arange(n) + SHINGLE <= first[w.row + 1]))
    row = w.row[begins]
    acc = np.full(len(begins), 0x51, dtype=np.uint64)
    for k in range(SHINGLE):
        there = begins + k < first[row + 1]
        word = h[np.minimum(begins + k, n - 1)]
        acc = mix64(acc * GOLDEN + np.where(there, word, np.uint64(k + 1)))
    order = np.lexsort((acc, row))
    acc, row = acc[order], row[order]
    # The number of an occurrence among equal shingles of its text.
    new = np.ones(len(acc), dtype=bool)
    new[1:] = (acc[1:] != acc[:-1]) | (row[1:] != row[:-1])
    at = np.arange(len(acc))
    times = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix64(acc + times.astype(np.uint64) * GOLDEN), row


def _throw(cell: np.ndarray, row: np.ndarray, limit: np.ndarray, block: int,
           rank: np.ndarray, dart: np.ndarray) -> None:
    """Throw the darts of the cells up to rank ``limit`` of their rows, and keep the
    earliest at each coordinate in ``rank`` and ``dart`` (rows x coordinates)."""
    flat_rank, flat_dart = rank.reshape(-1), dart.reshape(-1)
    time, number = np.zeros(len(cell)), 0
    while len(cell):
        steps = np.arange(number + 1, number + block + 1, dtype=np.uint64) * GOLDEN
        drawn = mix64(cell[:, None] + steps[None, :])
        wait = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53)
        times = time[:, None] + np.cumsum(wait, axis=1)
        hit = times <= limit[row][:, None]
        ids = drawn[hit]
        where = (np.repeat(row, hit.sum(axis=1)) * COORDS
                 + (mix64(ids ^ GOLDEN) % np.uint64(COORDS)).astype(np.int64))
        ranks = times[hit]
        np.minimum.at(flat_rank, where, ranks)
        best = flat_rank[where] == ranks
        flat_dart[where[best]] = ids[best]
        go = hit[:, -1]
        cell, row, time = cell[go], row[go], times[go, -1]
        number += block


def signatures(cell: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The darts kept by each text, rows x coordinates; 0 for a text without cells."""
    size = np.bincount(row, minlength=rows)
    dart = np.zeros((rows, COORDS), dtype=np.uint64)
    rank = np.full((rows, COORDS), np.inf)
    reach = COORDS * math.log(COORDS) + 2 * COORDS
    todo = size > 0
    while todo.any():
        limit = np.where(size > 0, reach / np.maximum(size, 1), 0.0)
        for small in (False, True):
            own = todo[row] & ((size[row] < SMALL) == small)
            _throw(cell[own], row[own], limit, 64 if small else 1, rank, dart)
        todo &= np.isinf(rank).any(axis=1)
        rank[todo] = np.inf
        reach *= 2
    return dart


def _bands(dart: np.ndarray) -> np.ndarray:
    parts = dart.reshape(len(dart), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix64(key * GOLDEN + parts[:, :, k])
    return key.view(np.int64)


def sketch_batch(texts: pa.Array) -> list[pa.Array]:
    """[bands or null, number of cells] of each text."""
    raw, offsets = buffers(texts)
    keys, sizes = [], []
    for a, b in slices(offsets):
        cell, row = cells(Words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
        sizes.append(np.bincount(row, minlength=b - a))
        for c in range(0, b - a, 1024):  # bounds the signatures held at once
            d = min(c + 1024, b - a)
            own = (row >= c) & (row < d)
            keys.append(_bands(signatures(cell[own], row[own] - c, d - c)))
    if not keys:
        return [pa.array([], pa.list_(pa.int64())), pa.array([], pa.int64())]
    keys, sizes = np.concatenate(keys), np.concatenate(sizes)
    lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * BANDS,
                                     pa.array(keys.reshape(-1)), mask=pa.array(sizes == 0))
    return [lists, pa.array(sizes.astype(np.int64))]


def cells_batch(texts: pa.Array) -> list[pa.Array]:
    """The sorted cells of each text, as bytes."""
    raw, offsets = buffers(texts)
    out = []
    for a, b in slices(offsets):
        cell, row = cells(Words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
        cell = cell[np.lexsort((cell, row))]
        edges = np.searchsorted(row, np.arange(b - a + 1))
        out += [cell[i:j].tobytes() for i, j in zip(edges, edges[1:])]
    return [pa.array(out, pa.binary())]


def _compare(similar: float):
    """The comparison of one block pair of a family: edges that join what is alike."""
    def run(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        block = np.asarray(table.column("block"))
        node = np.asarray(table.column("node"))
        parts = [np.frombuffer(v, dtype=np.uint64) for v in table.column("cells").to_pylist()]
        sizes = np.array([len(p) for p in parts], dtype=np.float64)
        owner = np.repeat(np.arange(len(parts)), sizes.astype(np.int64))
        # Cells that only one text has are in no intersection.
        _, place, many = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = many[place] > 1
        owner = owner[shared]
        _, place = np.unique(place[shared], return_inverse=True)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        cells_in = int(place[-1]) + 1 if len(place) else 0
        for a in range(0, cells_in, COLUMNS):
            u, v = np.searchsorted(place, [a, a + COLUMNS])
            has = np.zeros((len(parts), min(COLUMNS, cells_in - a)), dtype=np.float32)
            has[owner[u:v], place[u:v] - a] = 1.0
            both += has[left] @ has[right].T
        alike = both >= similar * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-6
        root = np.arange(len(parts))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for p in np.flatnonzero(alike.any(axis=1)):
            r = find(int(left[p]))
            for q in np.unique(root[right[alike[p]]]):
                root[find(int(q))] = r
        tied = [(x, find(x)) for x in range(len(parts)) if root[x] != x]
        return pa.table({"a": pa.array([int(node[x]) for x, _ in tied], pa.int64()),
                         "b": pa.array([int(node[r]) for _, r in tied], pa.int64())})
    return run


def _row_key(digest, doc_id):
    return F.concat_ws(":", F.hex(digest), F.coalesce(doc_id.cast("string"), F.lit("")))


def _sketches(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    own = docs.select(col(doc_id).alias("doc_id"), F.unhex(F.md5(whole)).alias("digest"),
                      whole.alias("text"))
    fields = [T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("size", T.LongType())]
    return own, write_cut(map_rows(own, "text", fields, sketch_batch, ["doc_id", "digest"]), "sketches")


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose key may be among the wanted ones: a bitmap of ``SLOTS`` hash slots,
    of one size for any data, goes to the tasks, so that few texts move to the join."""
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS))
    marked = (wanted.select((slot + 1).alias("h"))
              .groupBy(F.bitmap_bucket_number("h").alias("part"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect())
    bits = np.zeros(SLOTS // 8, dtype=np.uint8)
    for r in marked:  # parts of 4096 bytes each
        bits[(r["part"] - 1) * 4096:r["part"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    src = rows.withColumn("slot", slot)

    def run(batches):
        for batch in batches:
            h = np.asarray(batch.column(batch.num_columns - 1))
            yield batch.filter(pa.array((shared.value[h >> 3] >> (h & 7) & 1).astype(bool)))

    return map_arrow(src, run, src.schema).drop("slot")


def _families(member: DataFrame) -> DataFrame:
    """(node, family): members connected by shared buckets."""
    banded = member.select("node", F.explode("bands").alias("bucket"))
    least = (banded.groupBy("bucket").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("many"))
             .where("many > 1").select("bucket", "b"))
    ties = banded.join(least, "bucket").where("node <> b").select(F.col("node").alias("a"), "b")
    return components(ties).withColumnRenamed("component", "family")


def _links(own: DataFrame, member: DataFrame, similar: float) -> DataFrame:
    """(a, b): edges between alike members, enough to connect each class."""
    family = _families(member)
    wanted = write_cut(family.join(member.select("node", "gid", "least", "size"), "node").select(
        "node", "family", "size", _row_key(F.col("gid"), F.col("least")).alias("key")), "wanted")
    # The shingles of members that meet any other, from the text of the least id.
    texts = own.select(_row_key(F.col("digest"), F.col("doc_id")).alias("key"), "text")
    chosen = (_likely(texts, wanted).join(wanted.select("key", "node", "family"), "key").dropDuplicates(["node"])
              .select("node", "family", "text"))
    shingles = map_rows(chosen, "text", [T.StructField("cells", T.BinaryType())], cells_batch,
                        ["node", "family"])
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("size") / F.lit(BLOCK_CELLS)))
    cut = wanted.groupBy("family").agg(blocks.cast("int").alias("blocks"))
    placed = (shingles.join(cut, "family")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "node", "cells"))
    return write_cut(placed.groupBy("family", "i", "j").applyInArrow(
        _compare(similar), "a long, b long"), "links")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            similar: float = SIMILAR) -> DataFrame:
    """(doc_id, digest, class_id, kept): one row per row of ``docs``; ``digest`` is the MD5
    of the text as binary."""
    own, rows = _sketches(docs, doc_id, text)
    # Equal texts are one member from here on; its number is fixed by writing it.
    member = write_cut(rows.where("size > 0").groupBy(F.col("digest").alias("gid")).agg(
        F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("size").alias("size"))
        .withColumn("node", F.monotonically_increasing_id()), "members")
    group = components(_links(own, member, similar))
    least = member.select("gid", "node", "least")
    named = group.join(least, "node")
    # The least id of a class, and of the texts that have it the least digest: one document stays.
    order = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("gid").alias("first"))
    lowest = named.groupBy("component").agg(F.min(order).alias("best"))
    linked = named.join(lowest, "component").select("node", "best")
    known = write_cut(least.join(linked, "node", "left").select(
        F.col("gid").alias("digest"), F.when(F.col("best").isNull(), F.col("least")).otherwise(F.col("best.id")).alias("class_id"),
        F.coalesce("best.first", "gid").alias("first")), "classes")
    out = rows.select("doc_id", "digest", "size").join(known, "digest", "left")
    real = F.col("size") > 0
    return out.select("doc_id", "digest", F.when(real, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.when(real, F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first")))
                      .otherwise(F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` with one document of each class: that with the class id, once."""
    key = fresh("_key", docs)
    kept = write_cut(classes(docs, doc_id, text, similar).where("kept").select(
        _row_key(F.col("digest"), F.col("doc_id")).alias(key)).distinct(), "kept")
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    return (docs.withColumn(key, _row_key(F.unhex(F.md5(whole)), col(doc_id)))
            .join(kept, key).dropDuplicates([key]).drop(key))
