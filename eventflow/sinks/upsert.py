"""Idempotent keyed upsert (O-K5): last write per key wins, in a log-structured table.

A micro-batch (or a bounded table of updates) is reduced to one row per key with
``max_by(row, order)``, a partial and final aggregation, so a hot key costs one row per map
task. Keys are hashed to a fixed number of buckets, and the batch's rows are written as a
delta of the buckets that they fall into, and nothing else: a batch costs what it holds, not
what the table holds. Readers merge a bucket's base with its deltas. A bucket that has gathered more than
``max_deltas`` deltas is compacted with the batch that does so: its base, its deltas and the new rows
become a new base.

A version log names the live base and deltas of each bucket; its record, one per batch id, is
written after the data, so a replayed batch changes nothing and readers never see half a
batch. Files that no version of the last ``keep_versions`` uses are removed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.sinks import fs


def latest_per_key(updates: DataFrame, key: list, order: list) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple."""
    cols = [c for c in updates.columns]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    return updates.groupBy(*key).agg(best.alias("_r")).select("_r.*")


def merge_latest(target: DataFrame | None, updates: DataFrame, key: list,
                 order: list) -> DataFrame:
    """Keyed merge: the row with the greatest ``order`` per key wins, whichever batch
    brought it, so the result does not depend on batch boundaries. Null keys are one
    key."""
    if target is not None:
        updates = target.unionByName(updates.select(*target.columns))
    return latest_per_key(updates, key, order)


class VersionedKeyedTable:
    """A keyed table under ``root``: hash buckets of a base and deltas each, in Parquet.

    ``upsert(batch_df, batch_id)`` skips batch ids that were already merged, so replays after a
    failure do not change the result. ``buckets`` is fixed when the table is first written (the
    log keeps it): about the table's expected size over the size of a file. A bucket of
    a version is the list of its folders, the base first."""

    def __init__(self, spark: SparkSession, root: str, key: list, order: list, buckets: int = 64,
                 max_deltas: int = 8, keep_versions: int = 4):
        self.spark, self.root, self.key, self.order = spark, root.rstrip("/"), list(key), list(order)
        self.buckets, self.max_deltas, self.keep_versions = buckets, max_deltas, keep_versions

    def _version(self, before: int | None = None) -> dict | None:
        txt = fs.read_latest(self.spark, f"{self.root}/_versions", before)
        return None if txt is None else json.loads(txt)

    def _number(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.key]), F.lit(buckets)).cast("int")

    def _load(self, version: dict, buckets: list | None = None) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        chosen = version["live"] if buckets is None else {str(b): version["live"].get(str(b), []) for b in buckets}
        paths = [f"{self.root}/{p}" for folders in chosen.values() for p in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame | None:
        """The live rows, merged on read; None before the first batch."""
        version = self._version()
        return None if version is None else latest_per_key(self._load(version), self.key, self.order)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """The live rows of some keys (O-P5's point queries): only the buckets
        that these keys fall into are read. ``before``: as they were before that batch, which
        must be one of the last ``keep_versions``."""
        version = self._version(before)
        if version is None:
            return None
        keys = keys.select(*self.key).distinct()
        some = [r[0] for r in keys.select(self._number(version["buckets"])).distinct().collect()]
        rows = latest_per_key(self._load(version, some), self.key, self.order).alias("t")
        same = [F.col(f"t.{c}").eqNullSafe(F.col(f"k.{c}")) for c in self.key]
        on = same[0]
        for s in same[1:]:
            on = on & s
        return rows.join(keys.alias("k"), on, "left_semi")

    def upsert(self, updates: DataFrame, batch_id: int) -> None:
        version = self._version()
        if version is not None and batch_id <= version["batch_id"]:
            return  # already merged: replay is a no-op
        if version is None:
            version = {"buckets": self.buckets, "schema": updates.schema.jsonValue(), "live": {}, "gone": []}
        names = [f["name"] for f in version["schema"]["fields"]]
        live = dict(version["live"])
        delta = f"delta/{batch_id:012d}"
        self._write(latest_per_key(updates.select(*names), self.key, self.order), delta, version["buckets"])
        for b in self._written(delta):
            live[b] = [*live.get(b, []), f"{delta}/_bucket={b}"]
        gone = list(version["gone"])
        full = [b for b, folders in live.items() if len(folders) > self.max_deltas + 1]
        if full:
            base = f"base/{batch_id:012d}"
            rows = self._load({**version, "live": live}, full)
            self._write(latest_per_key(rows, self.key, self.order), base, version["buckets"])
            for b in full:
                gone += [[batch_id, folder] for folder in live[b]]
                live[b] = [f"{base}/_bucket={b}"]
        # A folder that this version no longer names may still be read by one of the last few.
        spare = [g for g in gone if g[0] > batch_id - self.keep_versions]
        record = {**version, "batch_id": batch_id, "live": live, "gone": spare}
        fs.write_record(self.spark, f"{self.root}/_versions", batch_id, json.dumps(record), keep=self.keep_versions)
        for _, folder in gone:
            if not any(folder == g[1] for g in spare):
                fs.remove(self.spark, f"{self.root}/{folder}")

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> None:
        (rows.withColumn("_bucket", self._number(buckets)).repartition("_bucket")
         .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/{folder}"))

    def _written(self, folder: str) -> list:
        return [n.split("=", 1)[1] for n in fs.names(self.spark, f"{self.root}/{folder}") if n.startswith("_bucket=")]

    def foreach_batch(self):
        """``writeStream.foreachBatch(table.foreach_batch())``."""
        def fn(df: DataFrame, batch_id: int) -> None:
            self.upsert(df, batch_id)
        return fn
