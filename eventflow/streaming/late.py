"""Late-row routing for streams (O-M6) with its own clock.

Structured Streaming drops rows behind its watermark before they reach any
stateful operator, so late rows cannot be *routed*. Here the input stream has
no ``withWatermark``; inside ``foreachBatch`` the batch computes, for each row,
the max event time of all rows that arrived before it (carry-in from a ledger
holding the max of previous batches + the in-batch block scan), splits on
``ts < max - delay``, writes both outputs, and only then advances the ledger.
Replaying a batch id that the ledger already covers is a no-op.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.operators.eventtime import epoch_us, from_epoch_us
from eventflow.operators.scan import running_max_before
from eventflow.operators.windows import _ms
from eventflow.sinks import fs


class LateSplitter:
    """``marker``: a SQL predicate; if given, only rows that satisfy it advance the
    watermark (O-M3, punctuated)."""

    def __init__(self, spark, root: str, ts: str, arrival: str, delay: str,
                 fmt: str = "parquet", marker: str | None = None):
        self.spark, self.root, self.ts, self.arrival = spark, root.rstrip("/"), ts, arrival
        self.delay_us = _ms(delay) * 1000
        self.fmt, self.marker = fmt, marker

    def _clock(self):
        t = epoch_us(self.ts)
        return t if self.marker is None else F.when(F.expr(self.marker), t)

    def _ledger(self) -> dict:
        txt = fs.read_latest(self.spark, f"{self.root}/_ledger")
        return json.loads(txt) if txt else {"batch_id": -1, "max_us": None}

    def split(self, df: DataFrame, carry_max_us: int | None) -> tuple:
        d = df.withColumn("_t_us", epoch_us(self.ts))
        d = running_max_before(d.withColumn("_clock", self._clock()), "_clock", self.arrival, "_mx")
        if carry_max_us is not None:
            d = d.withColumn("_mx", F.greatest("_mx", F.lit(carry_max_us)))
        d = d.withColumn("_wm_us", F.col("_mx") - F.lit(self.delay_us))
        late = F.coalesce(F.col("_t_us") < F.col("_wm_us"), F.lit(False))
        d = d.withColumn("wm", from_epoch_us("_wm_us")).withColumn("_late", late)
        keep = [c for c in d.columns if not c.startswith("_")]
        return d.filter(~F.col("_late")).select(*keep), d.filter("_late").select(*keep)

    def process(self, df: DataFrame, batch_id: int) -> None:
        ledger = self._ledger()
        if batch_id <= ledger["batch_id"]:
            return
        df = df.persist()
        main, late = self.split(df, ledger["max_us"])
        main.write.mode("overwrite").format(self.fmt).save(f"{self.root}/main/batch={batch_id}")
        late.write.mode("overwrite").format(self.fmt).save(f"{self.root}/late/batch={batch_id}")
        bmax = df.agg(F.max(self._clock())).first()[0]
        new_max = max(x for x in (ledger["max_us"], bmax) if x is not None) if (
            ledger["max_us"] is not None or bmax is not None) else None
        fs.write_record(self.spark, f"{self.root}/_ledger", batch_id,
                        json.dumps({"batch_id": batch_id, "max_us": new_max}))
        df.unpersist()

    def read(self, which: str) -> DataFrame:
        """``main`` or ``late`` rows of committed batches."""
        rows = self.spark.read.format(self.fmt).load(f"{self.root}/{which}")
        return rows.where(F.col("batch") <= self._ledger()["batch_id"])
