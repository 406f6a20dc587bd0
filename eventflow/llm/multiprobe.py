"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors of a similar norm form a shell; within it, a vector
divided by the shell's largest norm gets one more coordinate that makes its length 1, and a
query of length 1 gets a zero. Then a larger inner product is a smaller distance. ``TABLES`` hash
tables cut space by Gaussian projections, which are 2-stable: the difference of two
vectors' projections is normal with their distance as deviation. A bucket is a row of slots of
width ``w``, one for each of ``m`` projections; both come from the data: ``w`` from the spread of
the projections in a sample of ``SAMPLE`` vectors (by a hash of the vector), ``m`` from the number
of vectors, so that buckets hold about ``PER_BUCKET``. Every vector is indexed in every table.

A query visits its own bucket and perturbed ones in the order of the estimated success: the
probability, by the normal law, that a neighbour at the distance asked for lies in that
bucket. Two rounds find how far to go. The first visits the ``FIRST`` best buckets of each table
and ranks what they and the sample hold; its last rank bounds the distance of the true neighbours. The second visits buckets until they hold a
neighbour at that distance with probability ``SUCCESS`` over all tables. So the expected recall
does not depend on the data or their number; no bucket, candidate or partner is capped. A
shell whose vectors are too short to beat the bound is left out, which is exact, and a query
that has met fewer vectors than wanted, or would visit more buckets than there are, visits
every bucket of a table.

Buckets are dealt to tasks by a hash, and a query goes once to each task that holds some of
its buckets, with their list. There buckets are compared with the queries that visit them in
matrix products, and the best of each query go back, so pairs are never rows. A task of more
than ``PART_ROWS`` vectors is dealt to slabs, one of more than ``QUERIES_AT_ONCE`` queries
to copies. Equal vectors are one, with as many of their least ids as a result can hold.

Ranks follow the score, ties the smaller id, null last. Scores are inner products of the
original vectors in double precision, summed in one fixed way. Vectors that are null, empty, zero
or hold null or non-finite components take no part. A vector is compared with those of
its own dimension. A null id is a candidate but no query. A repeated id is a candidate each time,
and a query each time; a query leaves out one row, itself. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import col, mix64, write_cut

NEAREST = 20
TABLES = 2
PER_BUCKET = 256
MOST_PROJECTIONS = 24
SAMPLE = 4096
FIRST = 24
SUCCESS = 0.97
PART_ROWS, QUERIES_AT_ONCE, QUERIES_PER_TASK = 8192, 4096, 512
SLACK = 1e-12

_ERF = np.frompyfunc(math.erf, 1, 1)


def _phi(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * _ERF(x / math.sqrt(2)).astype(np.float64)


def shell(norm) -> np.ndarray:
    """Vectors of one quarter power of two in length, cut between such powers."""
    return np.floor(4 * np.log2(norm) + 0.5).astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(np.square(x / top[:, None]).sum(axis=1))


class Hashes:
    """The tables of one dimension: projections, offsets and width."""

    def __init__(self, dim: int, m: int, width: float, tables: int):
        rng = np.random.RandomState(dim)
        self.dim, self.m, self.width, self.tables = dim, m, width, tables
        self.lines = rng.standard_normal((tables, dim + 1, m))
        self.shift = rng.uniform(0, width, (tables, m))
        # An odd multiplier for each projection, to number a row of slots.
        self.odd = [int(v) * 2 + 1 for v in rng.randint(0, 1 << 62, m)]

    def project(self, lifted: np.ndarray) -> np.ndarray:
        """Places in units of the width, (table, row, projection)."""
        return (np.einsum("nd,tdm->tnm", lifted, self.lines) + self.shift[:, None, :]) / self.width

    def number(self, table: int, where: int, slots: np.ndarray) -> np.ndarray:
        """64-bit numbers of buckets: rows of slots in a table of a shell."""
        total = np.full(len(slots), (table + 1) * 1_000_003 + where * 7_919 + self.dim * 104_729, dtype=np.int64).astype(np.uint64)
        for i, odd in enumerate(self.odd):
            total += mix64(slots[:, i].astype(np.int64).astype(np.uint64) + np.uint64(i * 65_537 + 1)) * np.uint64(odd)
        return mix64(total).astype(np.int64)


def lift(x: np.ndarray, largest) -> np.ndarray:
    """Rows divided by the shell's largest norm, with the coordinate that completes them."""
    y = x / largest
    rest = np.sqrt(np.maximum(1.0 - np.square(y).sum(axis=1), 0.0))
    return np.hstack([y, rest[:, None]])


def probes(places: np.ndarray, spread: float, success: float, most: int | None = None,
           limit: int = 1 << 20) -> np.ndarray | None:
    """The buckets (rows of slots) of one table that a query at ``places`` visits, in the
    order of their chance to hold a neighbour whose places differ by a normal of deviation
    ``spread``: until the chances sum up to ``success``, and ``most`` of them at most. None
    if they are more than ``limit``."""
    home, m = np.floor(places), len(places)
    reach = max(1, math.ceil(4 * spread))
    steps = np.arange(-reach, reach + 1)
    edges = (home + np.arange(-reach, reach + 2)[:, None] - places) / max(spread, 1e-12)
    mass = np.maximum(np.diff(_phi(edges), axis=0), 0.0)  # (step, projection)
    order = np.argsort(-mass, axis=0, kind="stable")
    mass = np.take_along_axis(mass, order, axis=0)
    best = np.append(np.cumprod(mass[0][::-1])[::-1], 1.0)  # the best that projections from i on can add
    least = best[0] / 2
    while True:
        # All rows of slots at least as likely as ``least``, projection by projection.
        chance, picks = np.ones(1), np.zeros((1, 0), dtype=np.int64)
        for i in range(m):
            both = chance[:, None] * mass[:, i][None, :]
            a, b = np.nonzero(both * best[i + 1] >= least)
            if len(a) > limit:
                return None
            chance, picks = both[a, b], np.hstack([picks[a], order[b, i][:, None]])
        enough = chance.sum() >= success or (most is not None and len(chance) >= most)
        if enough or least < 1e-15 or len(chance) == len(steps) ** m:
            break
        least /= 8
    by = np.argsort(-chance, kind="stable")
    stop = int(np.searchsorted(np.cumsum(chance[by]), success)) + 1
    by = by[:stop if most is None else min(stop, most)]
    return (home + steps[picks[by]]).astype(np.int64)


def _describe(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec, dim, shell, norm) of the vectors that take part; vec in double precision."""
    src = vectors.select(col(vec_id).alias("vec_id"), col(embedding).cast("array<double>").alias("v"))
    src = src.where((F.size("v") > 0) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
                    & F.exists("v", lambda c: c != 0.0))

    def run(batches):
        for batch in batches:
            vs = batch.column(1)
            flat = vs.flatten().to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
            ends = np.append(0, np.cumsum(np.asarray(vs.value_lengths())))
            sizes = np.diff(ends)
            norm = np.zeros(len(sizes))
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                norm[own] = _norms(flat[ends[own][:, None] + np.arange(d)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([flat[a:b].astype("<f8").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array(sizes, pa.int32()), pa.array(shell(norm), pa.int64()), pa.array(norm)],
                names=["vec_id", "vec", "dim", "shell", "norm"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return src.mapInArrow(run, f"vec_id {kind}, vec binary, dim int, shell long, norm double")


def _matrix(vecs: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs.to_pylist()), dtype="<f8").reshape(-1, dim)


def fit(groups: DataFrame, tables: int) -> tuple[dict, dict, dict]:
    """(hashes by dimension, largest norm by (dimension, shell), sample by dimension)."""
    stats = groups.groupBy("dim", "shell").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most")).collect()
    largest = {(r["dim"], r["shell"]): r["most"] for r in stats}
    count: dict = {}
    for r in stats:
        count[r["dim"]] = count.get(r["dim"], 0) + r["n"]
    some = groups.select(F.xxhash64("vec").alias("h"), "gid", "vec", "dim", "shell").orderBy("h", "vec").limit(SAMPLE).collect()
    hashes, samples = {}, {}
    for d, n in count.items():
        own = [r for r in some if r["dim"] == d]
        x = np.frombuffer(b"".join(r["vec"] for r in own), dtype="<f8").reshape(-1, d)
        samples[d] = [r["gid"] for r in own], x
        m = min(max(1, round(math.log2(n / PER_BUCKET))), MOST_PROJECTIONS)
        spread = 0.0
        if len(own) > 1:
            y = lift(x, np.array([largest[d, r["shell"]] for r in own])[:, None])
            spread = float(np.mean((y @ Hashes(d, m, 1.0, 1).lines[0]).std(axis=0)))
        hashes[d] = Hashes(d, m, 2 * spread if spread > 1e-6 else 1.0, tables)
    return hashes, largest, samples


def _index(groups: DataFrame, hashes: dict, largest: dict, parts: int) -> DataFrame:
    """(task, bucket, gid, dim, table, vec): every vector in every table."""
    def run(batches):
        for batch in batches:
            dims, shells = (np.asarray(batch.column(i)) for i in (2, 3))
            for d, s in set(zip(dims.tolist(), shells.tolist())):
                own = np.flatnonzero((dims == d) & (shells == s))
                h = hashes[d]
                places = h.project(lift(_matrix(batch.column(1).take(pa.array(own)), d), largest[d, s]))
                slots = np.floor(places).astype(np.int64)
                for t in range(h.tables):
                    keys = h.number(t, s, slots[t])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_task(keys, parts)), pa.array(keys), batch.column(0).take(pa.array(own)),
                         pa.array(np.full(len(keys), d), pa.int32()), pa.array(np.full(len(keys), t), pa.int32()),
                         batch.column(1).take(pa.array(own))], names=["task", "bucket", "gid", "dim", "table", "vec"])

    return groups.select("gid", "vec", "dim", "shell").mapInArrow(
        run, "task int, bucket long, gid binary, dim int, table int, vec binary")


def _task(bucket: np.ndarray, tasks: int) -> np.ndarray:
    return (mix64(bucket.astype(np.uint64)) % np.uint64(tasks)).astype(np.int32)


def _visits(queries: DataFrame, hashes: dict, largest: dict, success: float, most: int | None, tasks: int,
            limit: int) -> DataFrame:
    """(query, vec, dim, bound, task, buckets): what each row of ``queries`` (query, vec, dim,
    bound) visits, a row for each task that holds some of it. Without ``most``, a query
    that has no bound, or would visit more than ``limit`` buckets, visits all buckets of the first
    table: null buckets in every task. With it, a query without a bound visits those that
    are likeliest at any distance."""
    shells: dict = {}
    for d, s in largest:
        shells.setdefault(d, []).append(s)

    def run(batches):
        for batch in batches:
            for i, (vec, d, bound) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                own = _buckets(np.frombuffer(vec, dtype="<f8"), hashes[d], shells[d], largest, bound, success, most, limit)
                if own is None:
                    at, lists = np.arange(tasks), pa.nulls(tasks, pa.list_(pa.int64()))
                else:
                    where = _task(own, tasks)
                    by = np.argsort(where, kind="stable")
                    heads = np.flatnonzero(np.append(True, where[by][1:] != where[by][:-1])) if len(by) else by
                    at = where[by][heads]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(by)), pa.int32()), pa.array(own[by]))
                me = batch.slice(i, 1).take(pa.array(np.zeros(len(at), dtype=np.int64)))
                yield pa.RecordBatch.from_arrays([*me.columns, pa.array(at, pa.int32()), lists],
                                                 names=["query", "vec", "dim", "bound", "task", "buckets"])

    return queries.select("query", "vec", "dim", "bound").mapInArrow(
        run, "query binary, vec binary, dim int, bound double, task int, buckets array<long>")


def _buckets(q: np.ndarray, h: Hashes, shells: list, largest: dict, bound: float | None, success: float,
             most: int | None, limit: int) -> np.ndarray | None:
    """The numbers of the buckets that a query visits in all tables and shells; None for all."""
    if bound is None and most is None:
        return None
    size = float(_norms(q[None, :])[0])
    places = h.project(np.append(q / size, 0.0)[None, :])[:, 0, :]
    each = 1 - (1 - success) ** (1 / h.tables)
    own = [np.zeros(0, dtype=np.int64)]
    for s in shells:
        # Both are on the unit sphere: the distance that the bound allows there.
        near = -1.0 if bound is None else bound / size / largest[h.dim, s]
        if near > 1 + SLACK * 1e3:
            continue  # no vector of this shell reaches the bound
        far = math.sqrt(min(max(2 - 2 * near, 1e-12), 4.0))
        for t in range(h.tables):
            slots = probes(places[t], far / h.width, each, most, limit)
            if slots is None:
                return None
            own.append(h.number(t, s, slots))
    return np.unique(np.concatenate(own))


def _best(many: int):
    """The comparison of one task: its buckets with the queries that visit them."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict = {"query": [], "gid": [], "score": []}
        if left.num_rows and right.num_rows:
            dims = np.asarray(left.column("dim"))
            theirs = np.asarray(right.column("dim"))
            for d in np.intersect1d(dims, theirs):
                _compare(left.filter(pa.array(dims == d)), right.filter(pa.array(theirs == d)), int(d), many, out)
        return pa.table({"query": pa.array(out["query"], pa.binary()), "gid": pa.array(out["gid"], pa.binary()),
                         "score": pa.array(out["score"], pa.float64())})
    return run


def _compare(left: pa.Table, right: pa.Table, dim: int, many: int, out: dict) -> None:
    # A vector stands in a bucket of every table: its rows share one place.
    coded = left.column("gid").combine_chunks().dictionary_encode()
    code = np.asarray(coded.indices)
    x = _matrix(left.column("vec").take(pa.array(np.unique(code, return_index=True)[1])).combine_chunks(), dim)
    q = _matrix(right.column("vec").combine_chunks(), dim)
    bound = right.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
    gid, query = coded.dictionary.to_pylist(), right.column("query").to_pylist()
    bucket = np.asarray(left.column("bucket"))
    by = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))
    members = {int(bucket[by[a]]): code[by[a:b]] for a, b in zip(heads, np.append(heads[1:], len(by)))}
    lists = right.column("buckets").combine_chunks()
    every = np.flatnonzero(np.asarray(lists.is_null()))
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    wanted, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), lengths)
    order = np.argsort(wanted, kind="stable")
    cuts = np.flatnonzero(np.append(True, wanted[order][1:] != wanted[order][:-1])) if len(order) else order
    meets = [(members.get(int(wanted[order[a]])), row[order[a:b]]) for a, b in zip(cuts, np.append(cuts[1:], len(order)))]
    meets.append((np.unique(code[np.asarray(left.column("table")) == 0]), every))
    asks, hits = [], []
    for own, who in meets:
        if own is None or not len(own) or not len(who):
            continue
        for some in np.array_split(who, -(-len(who) * len(own) // (1 << 18))):
            score = q[some] @ x[own].T
            least = np.where(np.isnan(bound[some]), -np.inf, bound[some])
            if len(own) > many:
                least = np.maximum(least, np.partition(score, len(own) - many, axis=1)[:, len(own) - many])
            slack = SLACK * (1 + np.abs(score).max(axis=1))
            i, j = np.nonzero(score >= (least - slack)[:, None])
            asks.append(some[i])
            hits.append(own[j])
    if not asks:
        return
    # A vector is met in several tables; once is enough.
    place = np.unique(np.concatenate(asks) * len(x) + np.concatenate(hits))
    if not len(place):
        return
    k, v = place // len(x), place % len(x)
    exact = np.concatenate([(x[v[a:a + 8192]] * q[k[a:a + 8192]]).sum(axis=1) for a in range(0, len(k), 8192)])
    by = np.lexsort((-exact, k))
    k, v, exact = k[by], v[by], exact[by]
    heads = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    sizes = np.diff(np.append(heads, len(k)))
    # The wanted number of each query, and what ties with the last of them.
    last = np.repeat(exact[heads + np.minimum(sizes, many) - 1], sizes)
    for i in np.flatnonzero(exact >= last):
        out["query"].append(query[k[i]])
        out["gid"].append(gid[v[i]])
        out["score"].append(exact[i])


def _search(held: DataFrame, visits: DataFrame, many: int) -> DataFrame:
    """(query, gid, score): the best of the visited buckets, a few for each task. The rows
    of a task are dealt to slabs and its queries to copies, by their numbers: each slab of rows
    meets each copy of queries."""
    asked = write_cut(visits, "asked")

    def shares(rows: DataFrame, each: int, name: str) -> DataFrame:
        return rows.groupBy("task").agg(F.ceil(F.count(F.lit(1)) / F.lit(each)).cast("int").alias(name))

    cut = write_cut(shares(held, PART_ROWS, "slabs").join(shares(asked, QUERIES_AT_ONCE, "copies"), "task"), "shares")

    def dealt(rows: DataFrame, by: str, own: str, other: str, names: tuple) -> DataFrame:
        return rows.join(cut, "task").select(
            "task", F.pmod(F.xxhash64(by), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), *names).groupBy("task", "slabs", "copies")

    left = dealt(held, "gid", "slabs", "copies", ("gid", "bucket", "table", "vec", "dim"))
    right = dealt(asked, "query", "copies", "slabs", ("query", "vec", "dim", "bound", "buckets"))
    return left.cogroup(right).applyInArrow(_best(many), "query binary, gid binary, score double")


def search(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding",
           nearest: int = NEAREST, success: float = SUCCESS, tables: int = TABLES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` found neighbours of the rows that
    ``is_query`` (a condition on ``vec_id``) picks, among all rows but themselves."""
    many = nearest + 1  # a query may find itself
    rows = write_cut(_describe(vectors, vec_id, embedding).withColumn("gid", F.unhex(F.md5("vec"))), "described")
    by_vector = Window.partitionBy("gid").orderBy(F.col("vec_id").asc_nulls_last())
    least = rows.select("gid", "vec_id", F.row_number().over(by_vector).alias("n")).where(F.col("n") <= many)
    ids = write_cut(least, "ids")
    groups = write_cut(rows.groupBy("gid").agg(*[F.first(c).alias(c) for c in ("vec", "dim", "shell", "norm")]), "vectors")
    hashes, largest, samples = fit(groups, tables)
    parts = max(1, math.ceil(groups.count() * tables / PART_ROWS))
    held = write_cut(_index(groups, hashes, largest, parts), "index")
    limit = max(1024, held.select("bucket").distinct().count())  # more probes cost more than the buckets
    asks = rows.where(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id", "gid").agg(
        F.count(F.lit(1)).alias("times"), F.first("vec").alias("vec"), F.first("dim").alias("dim"))
    asks = write_cut(asks.withColumn("query", F.unhex(F.md5(F.concat(F.col("vec_id").cast("string").cast("binary"),
                                                                     F.lit(b"\0"), "gid")))), "queries")

    def sampled(batches):
        """The best of the sample for each query."""
        for batch in batches:
            out: list = [[], [], []]
            for i, (vec, d) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                names, x = samples.get(d, ([], np.zeros((0, d))))
                q = np.frombuffer(vec, dtype="<f8")
                score = x @ q
                for j in np.argsort(-score, kind="stable")[:many]:
                    out[0].append(i)
                    out[1].append(names[j])
                    out[2].append((x[j] * q).sum())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.binary()),
                                              pa.array(out[2], pa.float64())], names=["query", "gid", "score"])

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "gid")
    tasks = max(1, math.ceil(asks.count() / QUERIES_PER_TASK))  # working out what to visit takes time, not rows

    def bounded(found: DataFrame) -> DataFrame:
        """The queries with the score of the last wanted one among those found so far."""
        last = found.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == many)
        last = last.select("query", F.col("score").alias("bound"))
        return write_cut(asks.join(last, "query", "left").select("query", "vec", "dim", "bound")
                         .repartition(tasks, "query"), "bounded")

    found = write_cut(asks.select("query", "vec", "dim").mapInArrow(
        sampled, "query binary, gid binary, score double"), "found")
    queries = bounded(found)
    visits = _visits(queries, hashes, largest, success, FIRST, parts, limit)
    found = write_cut(found.unionByName(_search(held, visits, many)).distinct(), "found")
    visits = _visits(bounded(found), hashes, largest, success, None, parts, limit)
    found = found.unionByName(_search(held, visits, many)).distinct()
    # Vectors tied with the last rank may all count: ranks let ties through until ids decide.
    ties = Window.partitionBy("query").orderBy(F.desc("score"))
    found = found.withColumn("n", F.rank().over(ties)).where(F.col("n") <= many).drop("n")
    about = asks.select("query", F.col("vec_id").alias("query_id"), F.col("gid").alias("own"), "times")
    pairs = found.join(about, "query").join(ids.select("gid", "vec_id", F.col("n").alias("at")), "gid")
    # A query leaves out one row of its own vector and id: the first of them.
    mine = (F.col("gid") == F.col("own")) & F.col("vec_id").eqNullSafe(F.col("query_id"))
    pairs = pairs.withColumn("mine", mine)
    once = Window.partitionBy("query", "mine").orderBy("at")
    pairs = pairs.withColumn("k", F.when(F.col("mine"), F.row_number().over(once))).where("k IS NULL OR k > 1")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "at")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return pairs.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
