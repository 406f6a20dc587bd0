"""Early firing and running detail on streams: any names, any key types, any batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventflow.operators.windows import early_firing_counts, running_detail
from eventflow.streaming import jobs as SJ
from eventflow.streaming import windows as W
from tests.replay import write_replay_files

BASE = pd.Timestamp("2024-03-01").value // 1000
KEYS = {"string": "concat('dev-', k)", "struct": "named_struct('room', k, 'floor', 'x')", "decimal": "cast(k AS decimal(10,2))"}


def source(spark, kind, n=90, seed=2):
    rng = random.Random(seed)
    times = sorted((rng.randrange(150) * 1_000_000 + rng.choice((0, 500_000)) for _ in range(n)),
                   key=lambda t: t + rng.randrange(9_000_000))
    df = spark.createDataFrame([(i, rng.randrange(2), BASE + t) for i, t in enumerate(times)], "seq long, k long, us long")
    return df.select("seq", F.expr(KEYS[kind]).alias("device"), F.timestamp_micros("us").alias("measured at"))


def collect(df, name, tmp):
    q = (df.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp}/ck-{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return df.sparkSession.sql(f"select * from {name}")


def plain(df, columns):
    def one(v):
        if hasattr(v, "year"):
            v = pd.Timestamp(v)
            return (v.tz_convert("UTC").tz_localize(None) if v.tzinfo else v).value // 1000
        return tuple(v) if isinstance(v, tuple) else v
    return sorted((tuple(one(r[c]) for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind,files", [("string", 2), ("struct", 6), ("decimal", 5)])
def test_early_firing(spark, tmp, kind, files):
    """Few files let one watermark pass several ticks."""
    src = source(spark, kind)
    write_replay_files(src, f"{tmp}/src", "seq", files)
    s = SJ.replay_stream(spark, f"{tmp}/src", src.schema)
    out = W.early_firing(s, "device", "measured at", "20 seconds", "5 seconds", "10 seconds")
    assert out.columns == ["device", "window_end", "eval_time", "cnt"]
    assert out.schema["device"].dataType.simpleString() == src.schema["device"].dataType.simpleString()
    got = plain(collect(out, f"early_{kind}", tmp), out.columns)
    want = plain(early_firing_counts(src, ["device"], "measured at", "20 seconds", "5 seconds"), out.columns)
    last = src.agg(F.max(F.unix_micros("measured at"))).first()[0] - 10_000_000
    upto = [r for r in want if r[2] <= last // 1000 * 1000]
    assert got == upto and len(upto) > 40


@pytest.mark.parametrize("kind,files", [("string", 3), ("struct", 1)])
def test_running_detail(spark, tmp, kind, files):
    src = source(spark, kind)
    write_replay_files(src, f"{tmp}/src", "seq", files)
    s = SJ.replay_stream(spark, f"{tmp}/src", src.schema)
    out = W.running_detail_stream(s, "device", "measured at", "20 seconds", "seq", "1 minute")
    assert out.columns == ["device", "size", "first_ts", "measured at", "window_start", "window_end"]
    got = plain(collect(out, f"detail_{kind}", tmp), out.columns)
    want = plain(running_detail(src, ["device"], "measured at", "20 seconds", "seq").withColumnRenamed("ts", "measured at"),
                 out.columns)
    assert got == want and len(got) == 90
