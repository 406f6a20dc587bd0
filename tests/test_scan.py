"""The ordered scan: its tree of carries, and time borders from a few splits."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventflow.operators import scan as S

HOWS = ("last", "first", "max", "min", "sum", "lag", "lead")


@pytest.mark.parametrize("fanout,buckets", [(4, 1000), (4, None), (10, 1000), (1024, 1000)])
def test_tree_of_carries(spark, monkeypatch, fanout, buckets):
    """1,000 blocks: every aggregate equals a plain window, and with a known number of blocks no
    window of the tree holds more than ``fanout`` of them."""
    n = 4000
    rows = spark.range(n).select(
        F.col("id").alias("at"), F.when(F.col("id") % 7 == 0, "rare").when(F.col("id") % 11 == 0, None)
        .otherwise("hot").alias("k"), F.when(F.col("id") % 5 != 0, (F.col("id") * 7919) % 1009).alias("v"))
    roots = []
    plain = S._carries

    def spy(sums, hows, levels, fan):
        if levels == 0:
            roots.append(sums.groupBy("_key").count().agg(F.max("count")).first()[0])
        return plain(sums, hows, levels, fan)

    monkeypatch.setattr(S, "_carries", spy)
    spark.conf.set(S.FANOUT_CONF, str(fanout))
    spark.conf.set(S.ARRIVAL_BLOCK_CONF, "4")  # where the number of blocks is estimated
    try:
        got = S.scan(rows, [("v", how, f"o_{how}") for how in HOWS], ["at"], F.floor(F.col("at") / 4), ("k",),
                     buckets=buckets)
        got = {r["at"]: r for r in got.collect()}
    finally:
        spark.conf.unset(S.FANOUT_CONF)
        spark.conf.unset(S.ARRIVAL_BLOCK_CONF)
    w = Window.partitionBy("k").orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("at", F.last("v", True).over(run).alias("o_last"), F.first("v", True).over(run).alias("o_first"),
                       F.max("v").over(run).alias("o_max"), F.min("v").over(run).alias("o_min"),
                       F.coalesce(F.sum("v").over(run), F.lit(0)).alias("o_sum"), F.lag("v").over(w).alias("o_lag"),
                       F.lead("v").over(w).alias("o_lead")).collect()
    assert len(got) == n and len(roots) == 1
    for r in want:
        assert all(got[r["at"]][c] == r[c] for c in r.asDict()), (r, got[r["at"]])
    assert roots[0] <= (fanout if buckets else 1000 // fanout ** 2 + 1)


def _files(path, times, files):
    """Times dealt to files as they come."""
    path.mkdir()
    for i, part in enumerate(np.array_split(times, files)):
        pq.write_table(pa.table({"t": pa.array(part, pa.int64())}), str(path / f"p{i:04d}.parquet"))
    return str(path)


LAYOUTS = {
    "in time order": lambda rng, n: np.sort(rng.uniform(0, 1e9, n)),
    "all times in each file": lambda rng, n: rng.uniform(0, 1e9, n),
    "a growing rate": lambda rng, n: np.sort(1e9 * rng.uniform(0, 1, n) ** 0.5),
    "bursts in each file": lambda rng, n: np.where(rng.uniform(0, 1, n) < 0.7, rng.normal(5e8, 1e6, n), rng.uniform(0, 1e9, n)),
    "arrival jitter": lambda rng, n: np.sort(rng.uniform(0, 1e9, n)) + rng.uniform(0, 5e7, n),
}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("target", [500, 4000])
def test_buckets_stay_within_twice_their_size(spark, tmp_path, layout, target):
    rng = np.random.RandomState(7)
    df = spark.read.parquet(_files(tmp_path / "t", LAYOUTS[layout](rng, 40_000).astype(np.int64), 80))
    spark.conf.set(S.BUCKET_ROWS_CONF, str(target))
    try:
        bounds = S.time_bounds(df, F.col("t"))
    finally:
        spark.conf.unset(S.BUCKET_ROWS_CONF)
    sizes = [r["count"] for r in S.with_time_bucket(df, F.col("t"), bounds, "b").groupBy("b").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * target
    assert len(bounds) + 1 <= 2 * 40_000 / target


def test_borders_read_a_few_splits_once(spark, tmp_path):
    """One job over at most 32 of 100 splits, no other while the plan is built, and none the
    second time."""
    times = np.sort(np.random.RandomState(1).uniform(0, 1e9, 10_000)).astype(np.int64)
    path = _files(tmp_path / "t", times, 100)
    conf = {"spark.sql.files.openCostInBytes": str(128 << 20), S.BUCKET_ROWS_CONF: "1000"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def jobs(name):
        sc.setJobGroup(name, name)
        df = spark.read.schema("t long").parquet(path)
        S.time_bounds(df.where("t > 0"), F.col("t"))
        infos = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup(name)]
        return [sum(tracker.getStageInfo(s).numTasks for s in i.stageIds) for i in infos]

    try:
        found, splits = S._summaries(spark.read.parquet(path).select(F.col("t").cast("double")))
        assert splits == 100 and len(found) == S.SAMPLE_SPLITS and sum(f[1] for f in found) < 3500
        assert jobs("borders-first") == [S.SAMPLE_SPLITS]
        assert jobs("borders-again") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k in conf:
            spark.conf.unset(k)


@pytest.mark.parametrize("rows", [[], [(None,)], [(5,)], [(5,), (5,), (5,)]])
def test_borders_of_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "t long")
    bounds = S.time_bounds(df, F.col("t"))
    assert S.with_time_bucket(df, F.col("t"), bounds, "b").count() == len(rows)
