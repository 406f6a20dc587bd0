"""Keyed processors behind the reorder buffer: the stream equals the batch form for any cut
into micro-batches and any disorder within the watermark's delay."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventflow.operators import joins as J
from eventflow.operators import keyed as K
from eventflow.streaming import jobs as SJ
from eventflow.streaming import processors as P
from tests.replay import write_replay_files

DELAY_S = 60
BASE = pd.Timestamp("2024-03-01").value // 1000


def rows_of(seed, n=240, keys=("a", "b", None), disorder_s=50):
    """(arrival, key, microseconds, value): ties included, times at odd microseconds."""
    rng = random.Random(seed)
    found = [(rng.choice(keys), BASE + rng.randrange(600) * 1_000_000 + rng.choice((0, 0, 1, 999, 500_000)),
              rng.choice((0.0, 10.0, 20.0, 35.0, 50.0))) for _ in range(n)]
    found.sort(key=lambda r: r[1] + rng.randrange(disorder_s * 1_000_000))
    return [(i, *r) for i, r in enumerate(found)]


def processors(reorder=True):
    kw = {"reorder": reorder, "tie": "seq"}
    return {
        "delta": P.DeltaAlertProcessor(14.0, **kw), "zero": P.DeltaAlertProcessor(14.0, True, **kw),
        "ttl": P.DeltaAlertProcessor(14.0, True, 7_000, **kw), "count": P.CountWithTimeoutProcessor(5_000, **kw),
        "rise": P.RiseAlertProcessor(4_000, **kw), "switch": P.SwitchFilterProcessor(**kw),
        "threshold": P.ThresholdAlertProcessor(**kw)}


def kinds(rows):
    """For the control processors: every fifth row is a control."""
    return [(i, k, t, v, 0 if i % 5 == 0 else 1) for i, k, t, v in rows]


def batch_result(spark, name, rows):
    """The batch form over all rows, as (key, time in microseconds, ...)."""
    df = spark.createDataFrame(kinds(rows), "seq long, dev string, us long, v double, kind int")
    df = df.withColumn("at", F.timestamp_micros("us").cast("timestamp_ntz"))
    if name in ("delta", "zero"):
        d = K.delta_alert(df, "dev", "at", "v", 14.0, name == "zero", tie="seq").select("dev", "at", "v", "diff")
    elif name == "ttl":
        d = K.self_cleaning_delta_alert(df, "dev", "at", "v", 14.0, "7 seconds", tie="seq").select("dev", "at", "v", "diff")
    elif name == "count":
        d = K.count_with_timeout(df, "dev", "at", "5 seconds", tie="seq").select("dev", "emit_ts", "cnt")
    elif name == "rise":
        d = K.rise_alerts(df, "dev", "at", "v", "4 seconds", tie="seq")
    else:
        controls, readings = df.where("kind = 0"), df.where("kind = 1")
        if name == "switch":
            controls = controls.select("dev", "at", F.timestamp_micros(F.col("us") + F.col("v").cast("long") * 1_000_000)
                                       .cast("timestamp_ntz").alias("until"))
            d = J.interval_semi_join(readings, controls, ["dev"], "at", "until").select("dev", "at", "v")
        else:
            d = K.previous_value(readings, "dev", "at", "v", "seq", out="last")
            d = J.asof_join(d, controls.select("dev", "at", "seq", F.col("v").alias("thr")), "at", ["thr"], ("dev",), "seq")
            diff = F.abs(F.col("v") - F.coalesce("last", F.lit(0.0)))
            d = d.where((F.col("thr") != 0.0) & (diff > F.col("thr"))).select("dev", "at", "v", diff.alias("diff"))
    return [(r[0], pd.Timestamp(r[1]).value // 1000, *r[2:]) for r in d.collect()]


class Handle:
    """The state of one key, in memory, with Spark's rules for timers."""

    class Value:
        def __init__(self):
            self.v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = tuple(v)

        def clear(self):
            self.v = None

    class List:
        def __init__(self):
            self.rows, self.largest = [], 0

        def get(self):
            return iter(list(self.rows))

        def appendList(self, rows):
            self.rows += rows
            self.largest = max(self.largest, len(rows))

        def clear(self):
            self.rows = []

    def __init__(self):
        self.timers, self.lists = set(), []

    def getValueState(self, name, schema):
        return Handle.Value()

    def getListState(self, name, schema):
        self.lists.append(Handle.List())
        return self.lists[-1]

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def drive(name, rows, cuts, chunk, reorder=True):
    """Output of a processor over micro-batches, and the last watermark in milliseconds."""
    keys = {}
    out, clock, top = [], -1, None
    for batch in [*cuts, []]:
        part = pd.DataFrame([(i, pd.Timestamp(t, unit="us"), kind, v, v, v * 1000) for i, k, t, v, kind in batch],
                            columns=["seq", "ts", "kind", "temperature", "threshold", "dur_ms"])
        names = [r[1] for r in batch]
        if top is not None:
            clock = max(clock, (top - DELAY_S * 1_000_000) // 1000)
        for k in sorted(set(names), key=str):
            if k not in keys:
                keys[k] = (processors(reorder)[name], Handle())
                keys[k][0].chunk = chunk
                keys[k][0].init(keys[k][1])
            own = part[[n == k for n in names]]
            pieces = [own.iloc[i:i + 3] for i in range(0, len(own), 3)]
            out += [r for f in keys[k][0].handleInputRows((k,), iter(pieces), Now(clock)) for r in f.values.tolist()]
        for k, (p, h) in keys.items():
            while ready := sorted(t for t in h.timers if t <= clock):
                h.timers.discard(ready[0])
                info = Now(ready[0])
                out += [r for f in p.handleExpiredTimer((k,), Now(clock), info) for r in f.values.tolist()]
        top = max([t for _, _, t, _, _ in batch] + ([top] if top is not None else []), default=None)
    for p, h in keys.values():
        assert all(x.largest <= max(chunk + 3, 3) for x in h.lists)
    return [(r[0], pd.Timestamp(r[2] if name == "count" else r[1]).value // 1000,
             *([r[1]] if name == "count" else r[2:])) for r in out], clock


@pytest.mark.parametrize("name", list(processors()))
def test_any_cut_equals_the_batch_form(spark, name):
    rows = rows_of(11)
    want = batch_result(spark, name, rows)
    assert len(want) > 10
    rng = random.Random(name)
    tagged = kinds(rows)
    if name not in ("switch", "threshold"):
        tagged = [(*r[:4], 1) for r in tagged]
    for size, chunk in ((1, 50), (7, 4), (40, 3), (240, 5), (None, 8), (None, 1000)):
        places = sorted(rng.sample(range(1, 240), 9)) if size is None else list(range(size, 240, size))
        cuts = [tagged[a:b] for a, b in zip([0, *places], [*places, 240])]
        got, clock = drive(name, rows, cuts, chunk)
        assert clock == (max(r[2] for r in rows) - DELAY_S * 1_000_000) // 1000
        upto = sorted((r for r in want if r[1] <= clock * 1000), key=repr)
        assert sorted(map(tuple, got), key=repr) == upto and upto, (size, chunk)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_without_the_buffer_a_batch_is_released_at_its_end(spark, chunk):
    """One batch that holds everything is sorted as a whole, chunk by chunk."""
    rows = rows_of(5, disorder_s=400)
    want = sorted(batch_result(spark, "zero", rows), key=repr)
    got, _ = drive("zero", rows, [[(*r[:4], 1) for r in kinds(rows)]], chunk, reorder=False)
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("name", ["ttl", "count", "threshold"])
def test_stream_equals_batch(spark, tmp, name):
    """On Spark, with string keys and columns of other names, out of order over five files."""
    rows = rows_of(23, keys=("a", "b", "c"))
    want = batch_result(spark, name, rows)
    src = spark.createDataFrame(kinds(rows), "seq long, dev string, us long, v double, kind int").withColumn(
        "at", F.timestamp_micros("us"))
    write_replay_files(src, f"{tmp}/src", "seq", 5)
    s = SJ.replay_stream(spark, f"{tmp}/src", src.schema)
    p = processors()[name]
    p.chunk = 7
    if name == "threshold":
        s = s.select("dev", "at", "seq", "kind", "v", F.col("v").alias("threshold"))
    else:
        s = s.select("dev", "at", "seq", "v")
    schema = P.COUNT_SCHEMA if name == "count" else P.ALERT_SCHEMA
    out = P.apply_processor(s, "dev", p, schema, f"{DELAY_S} seconds", ts="at", value="v")
    q = (out.writeStream.format("memory").queryName(f"re_{name}").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    found = spark.sql(f"select * from re_{name}").collect()
    got = [(r.dev, pd.Timestamp(r.emit_ts).value // 1000, r.cnt) if name == "count" else
           (r.dev, pd.Timestamp(r["at"]).value // 1000, r.v, r["diff"]) for r in found]
    last = (max(r[2] for r in rows) - DELAY_S * 1_000_000) // 1000 * 1000
    upto = sorted((r for r in want if r[1] <= last), key=repr)
    assert sorted(got, key=repr) == upto and upto
