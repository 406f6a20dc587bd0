"""Running aggregates on a stream (O-A2, O-A3, O-A5, O-A6): per row, the aggregate over all
rows of its keys so far, in arrival order, across micro-batches.

Each micro-batch is one ordered scan in which the state of its keys from earlier batches
stands as one row a key before the batch's rows. The state (a row per key) is a log-structured keyed
table (``sinks.upsert``): a batch reads the buckets of its own keys, as they were before it, and writes a delta
of them; old versions are removed there. An append-only ledger names the last batch whose rows are visible, and
batch ids at or below it are skipped, so a replayed batch changes nothing and the result does not
depend on batch boundaries.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.operators.scan import arrival_block, scan
from eventflow.sinks import fs
from eventflow.sinks.upsert import VersionedKeyedTable

_FIRST = -(1 << 60)


class RunningAggregates:
    """``outs``: (value column, ``sum``/``min``/``max``/``first``/``last``, out) over ``keys`` in
    the order of the integer column ``arrival``. A running count is the sum of a column
    of ones. Use ``process`` with ``foreachBatch``; ``read`` gives the rows of committed
    batches with their running values."""

    def __init__(self, spark, root: str, keys: list, arrival: str, outs: list):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.arrival, self.outs = list(keys), arrival, list(outs)
        self.state = VersionedKeyedTable(spark, f"{self.root}/state", self.keys, ["_batch"])

    def _ledger(self) -> dict:
        txt = fs.read_latest(self.spark, f"{self.root}/_ledger")
        return json.loads(txt) if txt else {"batch_id": -1}

    def process(self, df: DataFrame, batch_id: int) -> None:
        ledger = self._ledger()
        if batch_id <= ledger["batch_id"]:
            return
        parts = [f"_v{i}" for i in range(len(self.outs))]
        rows = df.select("*", *[F.col(v).alias(p) for p, (v, _, _) in zip(parts, self.outs)])
        rows = rows.withColumn("_at", F.col(self.arrival).cast("bigint")).persist()
        u = rows
        state = self.state.lookup(rows.select(*self.keys), before=batch_id)
        if state is not None:
            u = rows.unionByName(state.drop("_batch").withColumn("_at", F.lit(_FIRST)), allowMissingColumns=True)
        done = scan(u, [(p, how, out) for p, (_, how, out) in zip(parts, self.outs)], ["_at"],
                    arrival_block(u, "_at"), self.keys).filter(F.col("_at") > _FIRST)
        names = [out for _, _, out in self.outs]
        keep = [c for c in df.columns if c not in names]
        done.select(*keep, *names).write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")
        aggs = []
        for p, (_, how, _) in zip(parts, self.outs):
            v = F.col(p)
            if how in ("first", "last"):
                pick = F.min_by if how == "first" else F.max_by
                aggs.append(pick(v, F.when(v.isNotNull(), F.col("_at"))).alias(p))
            else:
                aggs.append({"sum": F.sum, "min": F.min, "max": F.max}[how](v).cast(
                    rows.schema[p].dataType).alias(p))
        # Committed on its own; a replay of this batch reads the version before it.
        self.state.upsert(u.groupBy(*self.keys).agg(*aggs).withColumn("_batch", F.lit(batch_id)), batch_id)
        fs.write_record(self.spark, f"{self.root}/_ledger", batch_id, json.dumps({"batch_id": batch_id}))
        rows.unpersist()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/out").where(
            F.col("batch") <= self._ledger()["batch_id"])
