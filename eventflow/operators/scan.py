"""Ordered scans without a global, single-partition window.

A running value in arrival order (watermark = running max of event time) or in
event-time order (as-of: the last control value at or before a row) is
sequential by nature. An unpartitioned ``Window.orderBy`` would pull the whole
table through one task, and a window per key would pull a hot key through one. So
the order is always split into blocks:

1. inside a block, a window partitioned by (key, block) does the scan;
2. every block is summarised to one row (its max / its last value / ...);
3. an exclusive prefix over those summaries gives each block its carry-in;
4. the carry-in joins back on (key, block) - the big side is already hash
   partitioned on exactly those columns by step 1, so only the summary moves.

Step 3 is a tree: a block's carry comes from the blocks before it among ``fanout``
neighbours, and from those neighbours' own carry, which is found the same way. No window
runs over all blocks of a key (``_carries``).

There is one plan for every input size. Arrival-order blocks are
``spark.eventflow.scan.arrivalBlock`` consecutive ids wide (default 262,144). Time buckets
are cut by counts, so a bucket of all keys together holds about
``spark.eventflow.scan.bucketRows`` rows (default 1,000,000), and no (key, bucket) can hold
more. Their borders come from a few splits of the input (``time_bounds``), not from a
pass over it; results do not depend on them. Only rows of one instant cannot be cut.

Keys are grouped as one struct column, in which nulls are equal, so a null key of
any type is a group like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNB = Window.unboundedPreceding

ARRIVAL_BLOCK_CONF = "spark.eventflow.scan.arrivalBlock"
DEFAULT_ARRIVAL_BLOCK = 1 << 18
BUCKET_ROWS_CONF = "spark.eventflow.scan.bucketRows"
DEFAULT_BUCKET_ROWS = 1_000_000
FANOUT_CONF = "spark.eventflow.scan.fanout"
DEFAULT_FANOUT = 1024
LEAST_BUCKETS = 2
SAMPLE_SPLITS, SAMPLE_POINTS, BETWEEN = 32, 512, 16
KEPT_BOUNDS = 64

_bounds: dict = {}


def arrival_block(df: DataFrame, order: str) -> Column:
    """The arrival block of a row, from a dense-ish integer arrival sequence."""
    width = int(df.sparkSession.conf.get(ARRIVAL_BLOCK_CONF, str(DEFAULT_ARRIVAL_BLOCK)))
    return F.floor(F.col(order) / F.lit(width))


def _summaries(times: DataFrame) -> tuple[list, int]:
    """([(place, rows, quantiles)], number of splits) of at most ``SAMPLE_SPLITS`` splits of
    a one-column frame, evenly spread over it; the others are not read."""
    def summarise(batches):
        parts = [np.asarray(b.column(0).drop_null()) for b in batches]
        t = np.concatenate(parts) if parts else np.zeros(0)
        points = (np.arange(SAMPLE_POINTS) + 0.5) / SAMPLE_POINTS
        q = np.quantile(t, points, method="inverted_cdf") if len(t) else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(t)], pa.int64()), pa.array([q.tolist()], pa.list_(pa.float64()))], names=["n", "q"])

    every = times.mapInArrow(summarise, "n long, q array<double>").rdd
    n = every.getNumPartitions()
    some = sorted({round(i) for i in np.linspace(0, n - 1, min(n, SAMPLE_SPLITS))}) if n else []
    got = times.sparkSession.sparkContext.runJob(every, list, some) if some else []
    return [(i, r["n"], np.array(r["q"])) for i, r in zip(some, got)], n


def _borders(found: list, splits: int, target: int) -> list:
    """Borders for buckets of about ``target`` rows, from summaries of some splits. What lies
    between two of them is taken to move from the one to the other, quantile by
    quantile: right for files in time order, and for files that each hold all times."""
    found = [f for f in found if f[1]]
    if not found:
        return []
    values, weights = [found[0][2]], [np.full(SAMPLE_POINTS, found[0][1] * (1.0 + found[0][0]))]
    for (i, n, q), (j, m, r) in zip(found, found[1:]):
        steps = min(j - i, BETWEEN)  # the splits between the two, and the second itself
        for step in (np.arange(steps) + 1) / steps:
            values.append(q + (r - q) * step)
            weights.append(np.full(SAMPLE_POINTS, (n + (m - n) * step) * (j - i) / steps))
    weights[-1] = weights[-1] + found[-1][1] * (splits - 1 - found[-1][0])
    value, weight = np.concatenate(values), np.concatenate(weights) / SAMPLE_POINTS
    by = np.argsort(value, kind="stable")
    value, reached = value[by], np.cumsum(weight[by])
    buckets = max(LEAST_BUCKETS, math.ceil(reached[-1] / target))
    cuts = np.interp(reached[-1] * np.arange(1, buckets) / buckets, reached, value)
    return np.unique(cuts).tolist()


def time_bounds(df: DataFrame, t_us: Column) -> list:
    """Borders that cut the rows' times (epoch microseconds) into buckets of about the
    configured number of rows, from the times of at most ``SAMPLE_SPLITS`` splits of ``df``, which
    should be a scan, filtered or projected at most. The borders are kept for the same
    times (``semanticHash``); they decide how rows are dealt out, never what comes out."""
    spark = df.sparkSession
    target = max(1, int(spark.conf.get(BUCKET_ROWS_CONF, str(DEFAULT_BUCKET_ROWS))))
    times = df.select(t_us.cast("double").alias("t"))
    key = (spark.sparkContext.applicationId, times.semanticHash(), target)
    if key not in _bounds:
        while len(_bounds) >= KEPT_BOUNDS:
            _bounds.pop(next(iter(_bounds)))
        _bounds[key] = _borders(*_summaries(times), target)
    return _bounds[key]


def with_time_bucket(df: DataFrame, t_us: Column, bounds: list, out: str) -> DataFrame:
    """Adds the number of the bucket that ``t_us`` falls into (binary search in the
    JVM); rows without a time go to the first."""
    from pyspark.ml.feature import Bucketizer
    d = df.withColumn("_bt", F.coalesce(t_us.cast("double"), F.lit(-1e300)))
    cut = Bucketizer(splits=[float("-inf"), *(bounds or [0.0]), float("inf")], inputCol="_bt", outputCol="_bi")
    return cut.transform(d).withColumn(out, F.col("_bi").cast("bigint")).drop("_bt", "_bi")


def _key(keys: list) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)


def _prefix_max_exclusive(tbl: DataFrame, keys: list, idx: str, val: str,
                          fanout: int, out: str) -> DataFrame:
    """tbl has one row per (keys, idx); add ``out`` = max(val) over rows of
    the same keys with a smaller idx (null when none)."""
    t = tbl.withColumn("_sup", F.floor(F.col(idx) / F.lit(fanout)))
    w1 = Window.partitionBy(*keys, "_sup").orderBy(idx).rowsBetween(UNB, -1)
    t = t.withColumn("_p1", F.max(val).over(w1))
    sup = t.groupBy(*keys, "_sup").agg(F.max(val).alias("_smax"))
    # One row per super-block: N / (block * fanout) rows in total.
    w2 = (Window.partitionBy(*keys) if keys else Window).orderBy("_sup").rowsBetween(UNB, -1)
    sup = sup.withColumn("_p2", F.max("_smax").over(w2)).drop("_smax")
    return (t.join(sup, [*keys, "_sup"], "left")
             .withColumn(out, F.greatest("_p1", "_p2"))
             .drop("_sup", "_p1", "_p2"))


def running_max_before(df: DataFrame, value: str, order: str, out: str,
                       keys: tuple = (), block: int | None = None,
                       fanout: int = 1 << 10, inclusive: bool = False) -> DataFrame:
    """``out`` = max(value) over the rows (same keys) whose ``order`` is
    smaller than this row's (``inclusive`` adds the row itself).

    ``order`` must be a dense-ish integer arrival sequence (e.g. event_id); blocks of
    consecutive ids give balanced tasks regardless of key skew. Block summaries
    grow with the data, so their prefix runs in two levels.
    """
    keys = list(keys)
    k = ["_key"] if keys else []
    rows = df.withColumn("_blk", arrival_block(df, order) if block is None
                         else F.floor(F.col(order) / F.lit(block)))
    if keys:
        rows = rows.withColumn("_key", _key(keys))
    w_in = (Window.partitionBy(*k, "_blk").orderBy(order)
            .rowsBetween(UNB, 0 if inclusive else -1))
    rows = rows.withColumn("_in", F.max(value).over(w_in))
    blocks = rows.groupBy(*k, "_blk").agg(F.max(value).alias("_bmax"))
    blocks = _prefix_max_exclusive(blocks, k, "_blk", "_bmax", fanout, "_carry").drop("_bmax")
    return (rows.join(blocks, [*k, "_blk"], "left")
            .withColumn(out, F.greatest("_in", "_carry"))
            .drop("_blk", "_in", "_carry", "_key"))


_AGG = {"last": lambda c: F.last(c, ignorenulls=True),
        "first": lambda c: F.first(c, ignorenulls=True),
        "max": F.max, "min": F.min, "sum": F.sum}


def _combine(how: str, here: Column, carry: Column) -> Column:
    if how == "last":
        return F.coalesce(here, carry)
    if how == "first":
        return F.coalesce(carry, here)
    if how == "max":
        return F.greatest(here, carry)
    if how == "min":
        return F.least(here, carry)
    if how in ("lag", "lead"):
        return F.coalesce(here, carry)["v"]
    return F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))


def _blocks_at_most(df: DataFrame) -> int:
    """An upper estimate of the arrival blocks, from the plan's size in bytes: a row has one at
    least. No job; only the depth of the tree depends on it."""
    width = int(df.sparkSession.conf.get(ARRIVAL_BLOCK_CONF, str(DEFAULT_ARRIVAL_BLOCK)))
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) // width + 1


def _step(how: str, value: Column, window) -> Column:
    """The running value of block summaries over ``window`` (rows before, or after for lead)."""
    if how in ("last", "lag"):
        return F.last(value, ignorenulls=True).over(window)
    if how in ("first", "lead"):
        return F.first(value, ignorenulls=True).over(window)
    return _AGG[how](value).over(window)


def _merge(how: str, value: Column, at: str) -> Column:
    """The summary of several blocks, in the order of ``at``."""
    if how in ("last", "lag"):
        return F.max_by(value, F.when(value.isNotNull(), F.col(at)))
    if how in ("first", "lead"):
        return F.min_by(value, F.when(value.isNotNull(), F.col(at)))
    return _AGG[how](value)


def _join_carry(how: str, near: Column, far: Column) -> Column:
    """The carry from the blocks at hand, ``near``, and from those beyond them."""
    if how in ("lag", "lead"):
        return F.coalesce(near, far)
    return _combine(how, near, far)


def _carries(sums: DataFrame, hows: list, levels: int, fanout: int) -> DataFrame:
    """``sums`` (_key, _bkt, _s0, _s1, ...), a row per block, to (_key, _bkt, _c0, _c1, ...):
    what the blocks of the key before this one (after it, for ``lead``) come to; null
    when there are none. A tree: windows hold ``fanout`` neighbouring blocks, and every
    ``fanout`` blocks are merged into one of the next of ``levels`` levels."""
    def carried(window) -> list:
        before = window.orderBy("_bkt").rowsBetween(UNB, -1)
        after = window.orderBy("_bkt").rowsBetween(1, Window.unboundedFollowing)
        return [_step(how, F.col(f"_s{i}"), after if how == "lead" else before).alias(f"_c{i}")
                for i, how in enumerate(hows)]

    if levels == 0:
        return sums.select("_key", "_bkt", *carried(Window.partitionBy("_key")))
    rows = sums.withColumn("_sup", F.floor(F.col("_bkt") / F.lit(fanout)))
    near = rows.select("_key", "_sup", "_bkt", *carried(Window.partitionBy("_key", "_sup")))
    merged = rows.groupBy("_key", "_sup").agg(
        *[_merge(how, F.col(f"_s{i}"), "_bkt").alias(f"_s{i}") for i, how in enumerate(hows)])
    far = _carries(merged.withColumnRenamed("_sup", "_bkt"), hows, levels - 1, fanout)
    far = far.select("_key", F.col("_bkt").alias("_sup"),
                     *[F.col(f"_c{i}").alias(f"_f{i}") for i in range(len(hows))])
    return near.join(far, ["_key", "_sup"], "left").select(
        "_key", "_bkt", *[_join_carry(how, F.col(f"_c{i}"), F.col(f"_f{i}")).alias(f"_c{i}")
                          for i, how in enumerate(hows)])


def scan(df: DataFrame, outs: list, order: list, bucket: Column, keys: tuple = (),
         inclusive: bool = True, buckets: int | None = None) -> DataFrame:
    """Ordered running aggregates per key without a per-key sort of all rows.

    ``outs`` is a list of (value column, how, out): agg(value) over rows of the same
    keys at or before this row in ``order`` (strictly before when not
    ``inclusive``); ``how`` is ``last`` (last non-null), ``first`` (first non-null),
    ``max``, ``min`` or ``sum``; or ``lag``/``lead``: the value of the row just before or
    after, null ones included. All outputs share one pass.

    ``order`` should be total (end with a tie-breaker). ``bucket`` must be a monotone
    function of it (a time bucket, or an arrival block). Each window partition is
    (keys, bucket), so a hot key is spread over its buckets; the carry-in from
    other buckets is computed on one summary row per (keys, bucket), in a tree of
    ``spark.eventflow.scan.fanout`` blocks a node. ``buckets``: their number, where it is
    known; it sets the depth of the tree. Otherwise the number of arrival blocks is bounded by the
    size that the plan states, and the tree has two levels below its root at most.
    """
    fanout = max(2, int(df.sparkSession.conf.get(FANOUT_CONF, str(DEFAULT_FANOUT))))
    if buckets is None:
        buckets = min(_blocks_at_most(df), fanout ** 3)
    levels, reach = 0, fanout
    while reach < buckets:
        levels, reach = levels + 1, reach * fanout
    rows = df.withColumn("_key", _key(list(keys))).withColumn("_bkt", bucket)
    inside = Window.partitionBy("_key", "_bkt").orderBy(*order)
    running = inside.rowsBetween(UNB, 0 if inclusive else -1)
    at = F.struct(*[F.col(c) for c in order])
    here, summary = [], []
    for i, (value, how, _) in enumerate(outs):
        v = F.col(value)
        boxed = F.struct(v.alias("v"))
        if how in ("lag", "lead"):
            move = F.lag if how == "lag" else F.lead
            here.append(move(boxed).over(inside).alias(f"_h{i}"))
            summary.append((F.max_by if how == "lag" else F.min_by)(boxed, at).alias(f"_s{i}"))
            continue
        here.append(_AGG[how](v).over(running).alias(f"_h{i}"))
        if how in ("last", "first"):
            pick = F.max_by if how == "last" else F.min_by
            summary.append(pick(v, F.when(v.isNotNull(), at)).alias(f"_s{i}"))
        else:
            summary.append(_AGG[how](v).alias(f"_s{i}"))
    sums = _carries(rows.groupBy("_key", "_bkt").agg(*summary), [how for _, how, _ in outs], levels, fanout)
    got = rows.select("*", *here).join(sums, ["_key", "_bkt"], "left")
    names = {out for _, _, out in outs}
    return got.select(*[c for c in df.columns if c not in names],
                      *[_combine(how, F.col(f"_h{i}"), F.col(f"_c{i}")).alias(out)
                        for i, (_, how, out) in enumerate(outs)])


def join_on(left: DataFrame, right: DataFrame, cols: list, how: str = "left") -> DataFrame:
    """Join on ``cols`` treating null keys as equal (a null key is a group
    like any other), keeping one copy of each join column."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in cols]
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])
