"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest reference points, in order. Vectors
that are close see the same points nearby, so the index keeps inverted lists and asks
for vectors that share at least ``SHARED`` pivots: a list for every set of that many
pivots, in which a vector stands once for each such subset of its own. Two vectors meet
in a list exactly when their shared-pivot count reaches ``SHARED``. The number of pivots
grows with the square root of the number of vectors, which keeps the lists of unrelated
vectors short. More pivots stand closer together, so close vectors share fewer of their
nearest: two of seven is what pairs at the threshold still share among ``MOST_PIVOTS``
(tested by cosine band; three of six lost a fifth of them). Pivots are chosen farthest-first
from a sample of ``SAMPLE`` vectors taken by a hash of the id; every vector is indexed.

Equal vectors of a label are put together first and carry their number. Lists of one
vector are dropped before any vector moves. Members of a list are compared by cosine in
double precision, in blocks of at most about ``BLOCK`` vectors a side, so a list may be
of any length. A pair that meets in several lists counts in the one of its least shared
pivots alone. Blocks give back link counts and, for the groups, at most one edge per
vector; pairs are never rows.

Vectors link only within a label and with vectors of their own dimension. A null label,
a null or empty or zero vector, and one with null or non-finite components link with
nothing: no links, a component of its own. A repeated row is a further vector. A null id
belongs to the component of the least id that it links with.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, write_cut
from eventflow.llm.components import components

COSINE = 0.93
NEAREST, SHARED = 7, 2
SAMPLE = 4096
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 17


def _clean(values) -> np.ndarray | None:
    """A vector in double precision, or None if it links with nothing."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    v = np.asarray(values, dtype=np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points (unit rows), each the farthest from those before it."""
    chosen, near = [0], points @ points[0]
    while len(chosen) < min(n, len(points)):
        k = int(np.argmin(near))
        if near[k] > 1 - 1e-9:
            break
        chosen.append(k)
        near = np.maximum(near, points @ points[k])
    return points[chosen]


def random_pivots(dim: int, n: int) -> np.ndarray:
    return _unit(np.random.RandomState(dim).standard_normal((n, dim)))


def fit(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[dict[int, np.ndarray], int]:
    """(pivots by dimension, number of pivots) from the row count and a bounded sample."""
    n = vectors.count()
    want = 1 << max(0, round(math.log2(2 * math.sqrt(max(n, 1)))))
    want = min(max(want, LEAST_PIVOTS), MOST_PIVOTS)
    rows = (vectors.where(col(embedding).isNotNull())
            .select(F.xxhash64(col(vec_id)).alias("h"), col(embedding).cast("array<double>").alias("v"))
            .orderBy("h", "v").limit(SAMPLE).collect())
    by_dim: dict[int, list] = {}
    for v in (_clean(r["v"]) for r in rows):
        if v is not None:
            by_dim.setdefault(len(v), []).append(v)
    return {d: p for d, x in by_dim.items()
            if len(p := farthest_first(_unit(np.stack(x)), want)) >= 2 * NEAREST}, want


def _width(vectors: DataFrame, embedding: str) -> str:
    """The type that holds the components exactly: every list of a vector carries them."""
    return "<f4" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "<f8"


def describe(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, gid, vec, top): an id of the label and vector together, the vector's
    components (floats if they came as such) and its nearest pivots, the nearest first;
    nulls where it links with nothing."""
    fitted, want = fit(vectors, vec_id, embedding)
    width = _width(vectors, embedding)
    src = vectors.select(col(vec_id).alias("vec_id"), col(label).cast("string").alias("label"),
                         col(embedding).cast("array<double>").alias("v"))

    def run(batches):
        pivots = dict(fitted)
        for batch in batches:
            vs = [_clean(v) if tag is not None else None
                  for v, tag in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist())]
            tops: list[bytes | None] = [None] * len(vs)
            for dim in {len(v) for v in vs if v is not None}:
                own = [i for i, v in enumerate(vs) if v is not None and len(v) == dim]
                if dim not in pivots:
                    pivots[dim] = random_pivots(dim, want)
                for part in (own[i:i + 512] for i in range(0, len(own), 512)):
                    near = _unit(np.stack([vs[i] for i in part])) @ pivots[dim].T
                    order = np.argsort(-near, axis=1, kind="stable")[:, :NEAREST].astype("<i4")
                    for i, top in zip(part, order):
                        tops[i] = top.tobytes()
            gids = [None if v is None else hashlib.blake2b(
                tag.encode() + b"\0" + (v + 0.0).tobytes(), digest_size=16).digest()
                for v, tag in zip(vs, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(gids, pa.binary()),
                 pa.array([None if v is None else v.astype(width).tobytes() for v in vs], pa.binary()),
                 pa.array(tops, pa.binary()), batch.column(1)],
                names=["vec_id", "gid", "vec", "top", "label"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return src.mapInArrow(run, f"vec_id {kind}, gid binary, vec binary, top binary, label string")


def _lists(groups: DataFrame) -> DataFrame:
    """(gid, key): the inverted lists, one for each set of ``SHARED`` pivots of a label."""
    def run(batches):
        for batch in batches:
            gids, keys = [], []
            for gid, top, dim, label in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = sorted(np.frombuffer(top, dtype="<i4").tolist())
                for some in itertools.combinations(own, SHARED):
                    gids.append(gid)
                    keys.append(f"{','.join(map(str, some))}|{dim}|{label}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(gids, pa.binary()), pa.array(keys, pa.string())], names=["gid", "key"])

    return (groups.select("gid", "top", F.octet_length("vec").alias("dim"), "label")
            .mapInArrow(run, "gid binary, key string"))


def _compare(cosine: float, width: str):
    """The comparison of one block pair of a list: link counts, and edges that join
    what is linked."""
    def run(table: pa.Table) -> pa.Table:
        key, i, j = (table.column(c)[0].as_py() for c in ("key", "i", "j"))
        last = int(key.split("|", 1)[0].split(",")[-1])
        block = np.asarray(table.column("block"))
        gid = table.column("gid").to_pylist()
        many = np.asarray(table.column("many"))
        x = _unit(np.stack([np.frombuffer(v, dtype=width).astype(np.float64) for v in table.column("vec").to_pylist()]))
        top = np.sort(np.stack([np.frombuffer(v, dtype="<i4") for v in table.column("top").to_pylist()]), 1)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        root = np.arange(len(gid))
        links = np.zeros(len(gid), dtype=np.int64)

        def find(a: int) -> int:
            while root[a] != a:
                root[a] = root[root[a]]
                a = root[a]
            return a

        rows = max(1, PAIRS_AT_ONCE // max(1, len(right)))
        for part in (left[k:k + rows] for k in range(0, len(left), rows)):
            a, b = np.nonzero(x[part] @ x[right].T >= cosine)
            a, b = part[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            # Here only if no pivot below this list's last is shared besides its own.
            shared = (top[a][:, :, None] == top[b][:, None, :]).any(axis=2) & (top[a] <= last)
            here = shared.sum(axis=1) == SHARED
            np.add.at(links, a[here], many[b[here]])
            np.add.at(links, b[here], many[a[here]])
            # One edge per newly reached vector is enough.
            for p in np.unique(a):
                r = find(int(p))
                for q in np.unique(root[b[a == p]]):
                    root[find(int(q))] = r
        joined = [(gid[p], gid[find(p)], 0) for p in range(len(gid)) if find(p) != p]
        counted = [(gid[p], None, int(links[p])) for p in np.flatnonzero(links)]
        both = joined + counted
        return pa.table({"a": pa.array([r[0] for r in both], pa.binary()),
                         "b": pa.array([r[1] for r in both], pa.binary()),
                         "n": pa.array([r[2] for r in both], pa.int64())})
    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``."""
    rows = write_cut(describe(vectors, vec_id, embedding, label), "described")
    groups = write_cut(rows.where("gid IS NOT NULL").groupBy("gid").agg(
        F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"),
        F.first("top").alias("top"), F.first("label").alias("label")), "vectors")
    member = write_cut(_lists(groups), "lists")
    sizes = member.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    placed = (member.join(sizes, "key").withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("gid", "key"), F.col("blocks")).cast("int"))
              .join(groups.select("gid", "many", "vec", "top"), "gid")
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "gid", "many", "vec", "top"))
    found = write_cut(placed.groupBy("key", "i", "j").applyInArrow(
        _compare(cosine, _width(vectors, embedding)), "a binary, b binary, n long"), "compared")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("links"))
    part = components(found.where("b IS NOT NULL").select("a", "b"))
    part = part.join(groups.select(F.col("gid").alias("node"), "least"), "node")
    lowest = part.groupBy("component").agg(F.min("least").alias("lowest"))
    part = part.join(lowest, "component").select(F.col("node").alias("gid"), "lowest")
    about = groups.select("gid", "many", "least").join(links, "gid", "left").join(part, "gid", "left")
    about = about.select("gid", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                         F.coalesce("lowest", "least").alias("component_id"))
    return rows.select("vec_id", "gid").join(about, "gid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
