"""Registered read-back queries of the sinks and the fan-out (O-K3, O-K4, O-K5, O-E9): what a
reader sees after batches, replays and a batch that was never committed."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.plans.common import events, sensors
from eventflow.plans.registry import register
from eventflow.session import scratch_path
from eventflow.sinks.files import WriteAheadSink
from eventflow.sinks.upsert import VersionedKeyedTable
from eventflow.streaming import jobs


def _stream(spark, sf):
    """The events table, a file or a folder of files, as a bounded file stream."""
    path = f"{sf.rstrip('/')}/event[s].parquet"
    schema = events(spark, sf).schema
    return spark.readStream.schema(schema).parquet(path)


def _wait(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("k3_exactly_once_file", "SELECT event_id, user_id AS id, value AS temperature FROM events")
def k3_exactly_once_file(spark, sf):
    """O-K3: events through the transactional file sink, the query started twice on one
    checkpoint; the second run finds nothing left to do."""
    root = scratch_path(spark, "k3")
    rows = sensors(_stream(spark, sf)).select("event_id", "id", "temperature")
    for _ in range(2):
        _wait(jobs.exactly_once_file_sink(rows, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out")


@register("k4_write_ahead", """
SELECT event_id, user_id AS id, CAST(event_id % 3 AS INTEGER) AS batch FROM events""")
def k4_write_ahead(spark, sf):
    """O-K4: three batches; the second is replayed; the third is written, loses its commit, and is
    replayed by the restarted query, so readers see every row once."""
    sink = WriteAheadSink(spark, scratch_path(spark, "k4"))
    d = sensors(events(spark, sf)).select("event_id", "id")

    def batch(i):
        return d.filter(F.pmod("event_id", F.lit(3)) == i)

    for i in (0, 1, 1):
        sink.write_batch(batch(i), i)
    batch(2).write.parquet(f"{sink.root}/data/batch=2")  # the driver stops here, before the record
    sink.write_batch(batch(2), 2)
    return sink.read()


@register("k5_keyed_upsert", """
SELECT user_id AS id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(value, (ts, event_id)) AS temperature
FROM events GROUP BY user_id""")
def k5_keyed_upsert(spark, sf):
    """O-K5: keyed upserts in two batches that both touch every key, newer rows first
    for some; the table holds the newest row per key."""
    target = VersionedKeyedTable(spark, scratch_path(spark, "k5"), ["id"], ["ts", "event_id"], buckets=8)
    d = sensors(events(spark, sf)).select("id", "ts", "event_id", "temperature")
    for i in (0, 1, 1):
        target.upsert(d.filter(F.pmod("event_id", F.lit(2)) == 1 - i), i)
    return target.read()


@register("e9_fan_out", """
SELECT 'high' AS result, event_id, value AS temperature FROM events WHERE value > 100
UNION ALL
SELECT 'low', event_id, value FROM events WHERE value < 25""")
def e9_fan_out(spark, sf):
    """O-E9: two named results of one source, each with its own sink, from one reading of it;
    run with restarts."""
    root = scratch_path(spark, "e9")
    rows = sensors(_stream(spark, sf)).select("event_id", "temperature")
    chosen = {"high": "temperature > 100", "low": "temperature < 25"}
    sinks = {name: WriteAheadSink(spark, f"{root}/{name}") for name in chosen}
    fan = jobs.FanOut(spark, f"{root}/commits", [
        jobs.BatchResult(name, rule, lambda d, rule=rule: d.filter(rule), sinks[name].write_batch)
        for name, rule in chosen.items()])
    jobs.run_with_restarts(lambda: fan.start(rows, f"{root}/checkpoint"))
    parts = [sinks[name].read().select(F.lit(name).alias("result"), "event_id", "temperature") for name in chosen]
    return parts[0].unionByName(parts[1])
