"""Keyed running state on bounded tables (O-A2, O-A3, O-A5, O-A6, O-P1 .. O-P5).

The streaming forms live in ``eventflow.streaming.processors``; these are the
equivalent batch forms. Per-key sequential state (previous value, running
count) is computed with the bucketed ``scan`` so a key holding a large share
of the rows is still processed by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventflow.operators.eventtime import epoch_us
from eventflow.operators.scan import arrival_block, join_on, scan, time_bounds, with_time_bucket
from eventflow.operators.windows import _ms
from eventflow.session import materialize


def _by_time(df: DataFrame, ts: str, tie: str | None, bounds: list | None = None) -> tuple:
    """(rows with _o and _bk, order, number of buckets): rows in ``ts`` order, cut into time
    buckets. Rows of one instant follow ``tie``."""
    bounds = time_bounds(df, epoch_us(ts)) if bounds is None else bounds
    rows = with_time_bucket(df.withColumn("_o", epoch_us(ts)), F.col("_o"), bounds, "_bk")
    return rows, ["_o", *([tie] if tie else [])], len(bounds) + 1


def rolling_sum(df: DataFrame, key: str, value: str, arrival: str, keep_first: list,
                out: str = "running_sum") -> DataFrame:
    """O-A2 (``keyBy(k).sum(f)``): per row, the running sum of ``value`` for its
    key; the other fields keep the values of the key's *first* row."""
    outs = [(value, "sum", out), *((c, "first", c) for c in keep_first)]
    return scan(df, outs, [arrival], arrival_block(df, arrival), (key,))


def running_count(df: DataFrame, key: str, arrival: str, out: str = "cnt") -> DataFrame:
    """O-A3: running count per key, emitted per row."""
    return scan(df.withColumn("_one", F.lit(1)), [("_one", "sum", out)], [arrival],
                arrival_block(df, arrival), (key,)).drop("_one")


def threshold_counters(df: DataFrame, key: str, value: str, arrival: str, threshold: float,
                       instances: int) -> DataFrame:
    """O-A5: for rows above ``threshold``: running count per key and running
    count per instance bucket ``pmod(key, instances)`` (the operator-wide
    counter, made deterministic)."""
    hot = df.filter(F.col(value) > F.lit(threshold)).withColumn(
        "instance", F.pmod(F.col(key), F.lit(instances)))
    hot = running_count(hot, key, arrival, "key_cnt")
    return running_count(hot, "instance", arrival, "op_cnt")


def instance_counters(df: DataFrame, key: str, value: str, arrival: str, threshold: float,
                      instances: int) -> DataFrame:
    """O-A6: counter per (deterministic) instance; restoring = sum over
    instances, which ``groupBy().sum`` of the last counts gives."""
    hot = df.filter(F.col(value) > F.lit(threshold)).withColumn(
        "instance", F.pmod(F.col(key), F.lit(instances)))
    return running_count(hot, "instance", arrival, "cnt")


def previous_value(df: DataFrame, key: str, ts: str, value: str, tie: str | None = None,
                   out: str = "prev", out_ts: str | None = None,
                   bounds: list | None = None) -> DataFrame:
    """``lag`` of ``value`` (and optionally of ``ts``, in microseconds) per key in ``ts``
    order; rows of one instant follow ``tie``. ``bounds``: time buckets found before."""
    d, order, buckets = _by_time(df, ts, tie, bounds)
    outs = [(value, "lag", out), *([("_o", "lag", out_ts)] if out_ts else [])]
    return scan(d, outs, order, F.col("_bk"), (key,), buckets=buckets).drop("_o", "_bk")


def delta_alert(df: DataFrame, key: str, ts: str, value: str, threshold: float,
                first_as_zero: bool = False, tie: str | None = None) -> DataFrame:
    """O-P1: |value - previous value| > threshold -> (key, value, diff).

    ``first_as_zero`` reproduces an empty state read as 0.0, so a first
    reading above the threshold alerts; by default the first reading never
    alerts."""
    d = previous_value(df, key, ts, value, tie)
    prev = F.coalesce("prev", F.lit(0.0)) if first_as_zero else F.col("prev")
    diff = F.abs(F.col(value) - prev)
    return (d.withColumn("diff", diff).filter(F.col("diff") > F.lit(threshold))
             .select(key, ts, value, "diff"))


def self_cleaning_delta_alert(df: DataFrame, key: str, ts: str, value: str,
                              threshold: float, ttl: str, tie: str | None = None) -> DataFrame:
    """O-P2: like O-P1 with an empty state read as 0.0, but the state of a
    key is cleared ``ttl`` after its last reading, so the next reading after
    such a gap compares against 0.0 again."""
    d = previous_value(df, key, ts, value, tie, out="prev", out_ts="prev_us")
    gap_ok = (epoch_us(ts) - F.col("prev_us")) < F.lit(_ms(ttl) * 1000)
    prev = F.when(gap_ok, F.col("prev")).otherwise(F.lit(0.0))
    return (d.withColumn("diff", F.abs(F.col(value) - prev))
             .filter(F.col("diff") > F.lit(threshold))
             .select(key, ts, value, "diff"))


def _successors(rises: DataFrame, interval_us: int, bounds: list) -> DataFrame:
    """For every rise o of a (key, run): the first rise at or after
    o + interval in the same run (``_j``, null when none). One reversed
    bucketed scan over rises (targets) and their query times."""
    tgt = rises.select("_k", "_run", F.col("_o").alias("_t"), F.lit(0).alias("_side"),
                       F.col("_o").alias("_val"), F.lit(None).cast("long").alias("_src"))
    qry = rises.select("_k", "_run", (F.col("_o") + F.lit(interval_us)).alias("_t"),
                       F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_val"),
                       F.col("_o").alias("_src"))
    u = with_time_bucket(tgt.unionByName(qry), F.col("_t"), bounds, "_bk").withColumn("_negt", -F.col("_t"))
    u = scan(u, [("_val", "last", "_nxt")], ["_negt", "_side"], -F.col("_bk"), ("_k", "_run"),
             buckets=len(bounds) + 1)
    return u.filter(F.col("_side") == 1).select("_k", "_run", F.col("_src").alias("_o"),
                                                 F.col("_nxt").alias("_j"))


def rise_alerts(df: DataFrame, key: str, ts: str, value: str, interval: str,
                tie: str | None = None) -> DataFrame:
    """O-P3: monotonic-rise alert with re-arming (event-time clock).

    Per key: the first reading and every decrease reset the state; a strict
    rise with no timer armed arms one at ``ts + interval``; it fires unless a
    reset comes strictly before it; after firing, the next strict rise re-arms.

    Everything is distributed: runs between resets come from bucketed scans;
    inside a run the armed rises form a chain (each the first rise at or
    after the previous arm + interval). Each rise's successor comes from one
    scan. The chain grows from each run's first rise by doubling: one table holds every rise's jump over
    the 2^i next arms and whether it is armed; a step composes the jumps with themselves and
    arms what the armed rises jump to, in one written table. A long run costs log(length) steps and never
    sits in one task; whether another step is needed is observed while the table is written.
    """
    iv = _ms(interval) * 1000
    # One set of time buckets for every scan below: runs and rises are subsets of the rows.
    bounds = time_bounds(df, epoch_us(ts))
    ties = [tie] if tie else []
    d = previous_value(df.select(key, ts, value, *ties), key, ts, value, tie, bounds=bounds)
    d, order, buckets = _by_time(d, ts, tie, bounds)
    reset = F.col("prev").isNull() | (F.col(value) < F.col("prev")) | (F.col("prev") == 0.0)
    d = d.withColumn("_reset", reset.cast("int")).withColumn(
        "_rise", (~reset) & (F.col(value) > F.col("prev")))
    d = scan(d, [("_reset", "sum", "_run")], order, F.col("_bk"), (key,), buckets=buckets)
    # Time of the next reset of the same key (the end of this row's run): the first row
    # of the next run.
    boxed = F.struct(F.col(key).alias("k")).alias("_k")  # in which a null key joins with itself
    ends = (d.filter("_reset = 1").select(boxed, (F.col("_run") - 1).alias("_run"),
                                          F.col("_o").alias("_next_reset")))
    rises = d.filter("_rise").select(boxed, "_run", "_o").distinct()  # rises of one instant arm once
    rises = materialize(join_on(rises, ends, ["_k", "_run"]), keep_partitioning=False)
    first = rises.groupBy("_k", "_run").agg(F.min("_o").alias("_first"))
    ids = ["_k", "_run", "_o"]
    chain = (rises.join(_successors(rises, iv, bounds), ids).join(first, ["_k", "_run"])
             .select(*ids, "_next_reset", "_j", (F.col("_o") == F.col("_first")).alias("_armed")))
    while True:
        seen = Observation()
        more = F.max((F.col("_armed") & F.col("_j").isNotNull()).cast("int"))
        chain = materialize(chain.observe(seen, more.alias("more")), keep_partitioning=False)
        if not seen.get["more"]:
            break
        ahead = chain.select("_k", "_run", F.col("_o").alias("_j"), F.col("_j").alias("_jj"))
        met = chain.where("_armed AND _j IS NOT NULL").select("_k", "_run", F.col("_j").alias("_o"), F.lit(True).alias("_met"))
        chain = chain.join(ahead, ["_k", "_run", "_j"], "left").join(met, ids, "left").select(
            *ids, "_next_reset", F.col("_jj").alias("_j"), (F.col("_armed") | F.col("_met").isNotNull()).alias("_armed"))
    fired = (chain.where("_armed").withColumn("_fire", F.col("_o") + F.lit(iv))
                  .filter(F.col("_next_reset").isNull() | (F.col("_next_reset") >= F.col("_fire"))))
    return fired.select(F.col("_k.k").alias(key),
                        F.timestamp_micros("_fire").cast("timestamp_ntz").alias("alert_ts"))


def count_with_timeout(df: DataFrame, key: str, ts: str, timeout: str,
                       tie: str | None = None) -> DataFrame:
    """O-P4: running count per key; emitted with the key when ``timeout``
    passes after a row with no newer row of that key (or at end of input).
    The count is not reset."""
    d = df.select(key, ts, *([tie] if tie else [])).withColumn("_one", F.lit(1))
    d, order, buckets = _by_time(d, ts, tie)
    d = scan(d, [("_one", "sum", "cnt"), ("_o", "lead", "_next")], order, F.col("_bk"), (key,), buckets=buckets)
    to_us = _ms(timeout) * 1000
    emit = F.col("_next").isNull() | ((F.col("_next") - F.col("_o")) > F.lit(to_us))
    return d.filter(emit).select(
        key, F.col("cnt").cast("bigint").alias("cnt"),
        F.timestamp_micros(F.col("_o") + F.lit(to_us)).cast("timestamp_ntz").alias("emit_ts"))
