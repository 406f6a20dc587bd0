"""Exact allowed lateness on a stream (O-M8) with its own clock.

Spark's watermark drops late rows before a stateful operator sees them, so the
window operator with allowed lateness is rebuilt in ``foreachBatch``:

* a ledger (batch id, max event time so far) gives each row the watermark of
  the rows that arrived before it (ledger carry-in + in-batch arrival scan);
* a window-state table (key, window end) -> on-time count, late count, fired
  flag, versioned per batch, holds what the window operator keeps;
* each late row that is still within the lateness emits the count so far
  (``first`` when it is the window's first row, else ``update``); a window
  whose end the watermark has passed emits ``first`` with its on-time count;
* windows past ``end + lateness`` are dropped from the state.

The result equals the bounded form ``operators.eventtime.allowed_lateness_counts``
for every window the stream's watermark has passed. Replayed batch ids are
no-ops (ledger written last).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.operators.eventtime import epoch_us
from eventflow.operators.scan import join_on, running_max_before, scan
from eventflow.operators.windows import _ms
from eventflow.sinks import fs


class LatenessWindowCounter:
    def __init__(self, spark, root: str, keys: list, ts: str, arrival: str, size: str,
                 delay: str, lateness: str, block: int = 1 << 14):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.ts, self.arrival, self.size = list(keys), ts, arrival, size
        self.delay_us, self.lateness_us = _ms(delay) * 1000, _ms(lateness) * 1000
        self.block = block

    def _ledger(self) -> dict:
        txt = fs.read_latest(self.spark, f"{self.root}/_ledger")
        return json.loads(txt) if txt else {"batch_id": -1, "max_us": None, "state": None}

    def _state(self, ledger) -> DataFrame | None:
        return self.spark.read.parquet(ledger["state"]) if ledger["state"] else None

    def process(self, df: DataFrame, batch_id: int) -> None:
        ledger = self._ledger()
        if batch_id <= ledger["batch_id"]:
            return
        keys, wend = self.keys, "window_end"
        d = df.select(*keys, self.arrival, self.ts).withColumn("_t", epoch_us(self.ts))
        d = running_max_before(d, "_t", self.arrival, "_mx")
        if ledger["max_us"] is not None:
            d = d.withColumn("_mx", F.greatest("_mx", F.lit(ledger["max_us"])))
        end_us = epoch_us(F.window(self.ts, self.size).end) - F.lit(1000)
        wm = F.col("_mx") - F.lit(self.delay_us)
        d = (d.withColumn(wend, F.window(self.ts, self.size).end)
              .withColumn("_on", F.coalesce(wm < end_us, F.lit(True)))
              .withColumn("_ok", (~F.col("_on")) & (wm < end_us + F.lit(self.lateness_us))))
        d = d.persist()
        batch_max = d.agg(F.max("_t")).first()[0]
        new_max = max(x for x in (ledger["max_us"], batch_max) if x is not None) \
            if (ledger["max_us"] is not None or batch_max is not None) else None

        per_win = (d.filter(F.col("_on") | F.col("_ok")).groupBy(*keys, wend)
                    .agg(F.sum(F.col("_on").cast("long")).alias("b_on"),
                         F.sum(F.col("_ok").cast("long")).alias("b_late")))
        # Merge with the previous window state by union + groupBy (a null key
        # is a group like any other).
        cur = per_win.select(*keys, wend, F.lit(0).cast("long").alias("s_on"),
                             F.lit(0).cast("long").alias("s_late"), F.lit(False).alias("fired"),
                             "b_on", "b_late")
        state = self._state(ledger)
        if state is not None:
            cur = cur.unionByName(state.select(*keys, wend, "s_on", "s_late", "fired",
                                               F.lit(0).cast("long").alias("b_on"),
                                               F.lit(0).cast("long").alias("b_late")))
        merged = cur.groupBy(*keys, wend).agg(
            F.sum("s_on").alias("s_on"), F.sum("s_late").alias("s_late"),
            F.max("fired").alias("fired"), F.sum("b_on").alias("b_on"),
            F.sum("b_late").alias("b_late")).persist()

        # Late rows within the lateness: rank among the window's kept rows.
        late = d.filter("_ok").withColumn("_one", F.lit(1))
        late = scan(late, [("_one", "sum", "_k")], [self.arrival],
                    F.floor(F.col(self.arrival) / F.lit(self.block)), (*keys, wend))
        late = join_on(late, merged.select(*keys, wend, "s_on", "s_late", "b_on"),
                        [*keys, wend], "inner")
        rank = F.col("s_on") + F.col("b_on") + F.col("s_late") + F.col("_k")
        updates = late.select(*keys, wend, rank.cast("bigint").alias("cnt"),
                              F.when(rank == 1, "first").otherwise("update").alias("kind"))

        # Windows the new watermark has passed emit their on-time count once.
        new_wm = None if new_max is None else new_max - self.delay_us
        on_total = F.col("s_on") + F.col("b_on")
        passed = F.lit(False) if new_wm is None else (
            epoch_us(wend) - F.lit(1000) <= F.lit(new_wm))
        fire_now = (~F.col("fired")) & (on_total > 0) & passed
        firsts = merged.filter(fire_now).select(*keys, wend, on_total.cast("bigint").alias("cnt"),
                                                F.lit("first").alias("kind"))
        out = firsts.unionByName(updates)
        out.write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")

        closed = F.lit(False) if new_wm is None else (
            epoch_us(wend) - F.lit(1000) + F.lit(self.lateness_us) <= F.lit(new_wm))
        new_state = (merged.select(*keys, wend, on_total.alias("s_on"),
                                   (F.col("s_late") + F.col("b_late")).alias("s_late"),
                                   (F.col("fired") | fire_now).alias("fired"))
                           .filter(~closed))
        state_path = f"{self.root}/state/v{batch_id:012d}"
        new_state.write.mode("overwrite").parquet(state_path)
        fs.write_record(self.spark, f"{self.root}/_ledger", batch_id,
                        json.dumps({"batch_id": batch_id, "max_us": new_max,
                                         "state": state_path}))
        merged.unpersist()
        d.unpersist()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/out").where(
            F.col("batch") <= self._ledger()["batch_id"])

    def watermark_us(self) -> int | None:
        led = self._ledger()
        return None if led["max_us"] is None else led["max_us"] - self.delay_us


_MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
_PARTIAL = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


class OwnClockWindowAggregate:
    """Tumbling-window aggregate on a stream with a per-row watermark (own
    clock, e.g. the punctuated ``ts - 5 ms`` of O-M5 / O-E10).

    Each batch drops rows that are already late for their window (window end
    - 1 ms <= the watermark of the rows before them), merges partial
    aggregates (``min``/``max``/``sum``/``count``) into a versioned
    window-state table, and emits every window the new watermark has passed -
    once, after which it leaves the state. Rows dropped as late are written
    to a side output (``read_late``). Replayed batch ids are no-ops.
    """

    def __init__(self, spark, root: str, keys: list, ts: str, arrival: str, size: str,
                 delay: str, aggs: dict):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.ts, self.arrival, self.size = list(keys), ts, arrival, size
        self.delay_us = _ms(delay) * 1000
        self.aggs = aggs   # out name -> (kind, column)

    def _ledger(self) -> dict:
        txt = fs.read_latest(self.spark, f"{self.root}/_ledger")
        return json.loads(txt) if txt else {"batch_id": -1, "max_us": None, "state": None}

    def process(self, df: DataFrame, batch_id: int) -> None:
        ledger = self._ledger()
        if batch_id <= ledger["batch_id"]:
            return
        keys, wend = self.keys, "window_end"
        d = df.withColumn("_t", epoch_us(self.ts))
        d = running_max_before(d, "_t", self.arrival, "_mx")
        if ledger["max_us"] is not None:
            d = d.withColumn("_mx", F.greatest("_mx", F.lit(ledger["max_us"])))
        end = F.window(self.ts, self.size).end
        late = F.coalesce(epoch_us(end) - F.lit(1000) <= F.col("_mx") - F.lit(self.delay_us),
                          F.lit(False))
        d = d.withColumn(wend, end).withColumn("_late", late).persist()
        batch_max = d.agg(F.max("_t")).first()[0]
        new_max = max(x for x in (ledger["max_us"], batch_max) if x is not None) \
            if (ledger["max_us"] is not None or batch_max is not None) else None
        part = d.filter(~F.col("_late")).groupBy(*keys, wend).agg(
            *[_PARTIAL[k](c).alias(n) for n, (k, c) in self.aggs.items()])
        if ledger["state"]:
            part = part.unionByName(self.spark.read.parquet(ledger["state"]))
        merged = part.groupBy(*keys, wend).agg(
            *[_MERGE[k](n).alias(n) for n, (k, c) in self.aggs.items()]).persist()
        new_wm = None if new_max is None else new_max - self.delay_us
        done = F.lit(False) if new_wm is None else epoch_us(wend) - F.lit(1000) <= F.lit(new_wm)
        merged.filter(done).write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")
        # O-M7: the rows too late for their window, as a side output.
        d.filter("_late").drop("_late", "_t", "_mx").write.mode("overwrite").parquet(
            f"{self.root}/late/batch={batch_id}")
        state_path = f"{self.root}/state/v{batch_id:012d}"
        merged.filter(~done).write.mode("overwrite").parquet(state_path)
        fs.write_record(self.spark, f"{self.root}/_ledger", batch_id,
                        json.dumps({"batch_id": batch_id, "max_us": new_max, "state": state_path}))
        merged.unpersist()
        d.unpersist()

    def read_late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late").where(
            F.col("batch") <= self._ledger()["batch_id"])

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/out").where(
            F.col("batch") <= self._ledger()["batch_id"])

    def watermark_us(self) -> int | None:
        led = self._ledger()
        return None if led["max_us"] is None else led["max_us"] - self.delay_us


class AsOfControlStream:
    """O-J1 on a stream: readings joined as-of with an unkeyed control stream
    (last control at or before each reading by time, controls first on ties).

    Each micro-batch carries both kinds of rows (``kind`` 0 = control, 1 =
    reading). The controls of earlier batches are kept, with their types, in a table
    of versions: those within ``lateness`` of the newest time seen, and the last
    one before. Readings are joined as-of, by time, with kept and new controls together,
    so a reading older than a control of an earlier batch does not see it, and an old
    control in a later batch does not replace a newer one. A reading later than
    ``lateness`` may miss controls already dropped. ``tie``: the column that orders
    controls of one instant. Matched readings go to ``root/out/batch=<id>``; replayed batch
    ids are no-ops."""

    def __init__(self, spark, root: str, ts: str, value: str, out_col: str,
                 lateness: str = "1 day", tie: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.ts, self.value, self.out_col = ts, value, out_col
        self.lateness_us, self.tie = _ms(lateness) * 1000, tie

    def _ledger(self) -> dict:
        txt = fs.read_latest(self.spark, f"{self.root}/_ledger")
        return json.loads(txt) if txt else {"batch_id": -1, "controls": None, "max_us": None}

    def process(self, df: DataFrame, batch_id: int) -> None:
        from eventflow.operators.joins import asof_join
        ledger = self._ledger()
        if batch_id <= ledger["batch_id"]:
            return
        df = df.persist()
        ties = [self.tie] if self.tie else []
        controls = df.filter(F.col("kind") == 0).select(
            self.ts, *ties, F.col(self.value).alias(self.out_col))
        if ledger["controls"]:
            controls = controls.unionByName(self.spark.read.parquet(ledger["controls"]))
        readings = df.filter(F.col("kind") == 1).drop("kind", self.value)
        joined = asof_join(readings, controls, self.ts, [self.out_col], tie=self.tie)
        joined.write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")
        newest = df.agg(F.max(epoch_us(self.ts))).first()[0]
        newest = max(t for t in (newest, ledger["max_us"], -2**62) if t is not None)
        horizon = newest - self.lateness_us
        t = epoch_us(self.ts)
        before = (controls.filter(t < horizon).groupBy()
                  .agg(F.max_by(F.struct("*"), F.struct(t, *ties)).alias("c"))
                  .filter(F.col("c").isNotNull()).select("c.*"))
        path = f"{self.root}/controls/v{batch_id:012d}"
        controls.filter(t >= horizon).unionByName(before).write.mode("overwrite").parquet(path)
        fs.write_record(self.spark, f"{self.root}/_ledger", batch_id,
                        json.dumps({"batch_id": batch_id, "controls": path, "max_us": newest}))
        df.unpersist()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/out").where(
            F.col("batch") <= self._ledger()["batch_id"])
