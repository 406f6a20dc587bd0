"""Stream plumbing: file-stream replay of a table, the exactly-once file sink
(O-K3), top-N over finalised windows (O-G14 stream form), and the named
result fan-out with restart (O-E9)."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.operators.windows import top_n
from eventflow.sinks import fs
from eventflow.sinks.files import with_retries


def replay_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").parquet(path))


def exactly_once_file_sink(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                           trigger: dict | None = None):
    """O-K3: transactional file sink. Files of a batch become visible only
    when the batch is committed to ``path/_spark_metadata``; a restarted query
    (same checkpoint) re-runs an uncommitted batch and readers of ``path`` see
    each row once."""
    w = (stream.writeStream.format(fmt).option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def top_n_per_batch(n: int, group: list, order: list, sink: Callable[[DataFrame, int], None]):
    """O-G14 stream form: the upstream window count runs in append mode, so
    every row of a micro-batch belongs to a window that is final; rank inside
    ``foreachBatch`` and hand the top N to ``sink``."""
    def fn(df: DataFrame, batch_id: int) -> None:
        sink(top_n(df, group, order, n), batch_id)
    return fn


@dataclass
class NamedResult:
    """O-E9: one named result of a fan-out: transform and sink of the shared
    source stream."""
    name: str
    description: str
    transform: Callable[[DataFrame], DataFrame]
    sink: Callable[[DataFrame, str], object]   # (result_stream, checkpoint) -> StreamingQuery


def start_results(source: DataFrame, results: list, checkpoint_root: str) -> dict:
    """Start one streaming query per result, each with its own checkpoint."""
    return {r.name: r.sink(r.transform(source), f"{checkpoint_root.rstrip('/')}/{r.name}")
            for r in results}


@dataclass
class BatchResult:
    """O-E9: one named result of a shared batch: ``write(transform(batch), batch_id)``. ``write`` is
    any sink's batch method, such as ``WriteAheadSink.write_batch``, ``VersionedKeyedTable.upsert``,
    ``JsonDocumentSink.write_batch`` or ``OwnClockWindowAggregate.process``; it should overwrite, or skip,
    a batch id that comes twice."""
    name: str
    description: str
    transform: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, int], object]


class FanOut:
    """O-E9: many results from one reading of a stream.

    One query; each micro-batch is computed once, kept while its results are written, and
    handed to every result. A result that has been written is recorded under ``root`` with its batch
    id. A result that fails is tried again alone, ``attempts`` times and ``delay_s`` apart, while the
    others go on; if it fails for good, so does the query, and after a restart on the same
    checkpoint only the results without a record are written for that batch. Transforms work
    on the batch; windows over a stream keep their state in the sink (``OwnClockWindowAggregate``)
    or run as queries of their own (``start_results``)."""

    def __init__(self, spark: SparkSession, root: str, results: list, attempts: int = 10, delay_s: float = 5.0):
        if len({r.name for r in results}) < len(results):
            raise ValueError("results need different names")
        self.spark, self.root, self.results = spark, root.rstrip("/"), list(results)
        self.attempts, self.delay_s = attempts, delay_s

    def committed(self, name: str) -> int:
        """The last batch id that a result has been written for; -1 before the first."""
        txt = fs.read_latest(self.spark, f"{self.root}/{name}")
        return -1 if txt is None else int(json.loads(txt)["batch_id"])

    def process(self, df: DataFrame, batch_id: int) -> None:
        """Use with ``foreachBatch``."""
        pending = [r for r in self.results if self.committed(r.name) < batch_id]
        if not pending:
            return
        failed: dict = {}
        df = df.persist()
        try:
            for r in pending:
                try:
                    with_retries(lambda r=r: r.write(r.transform(df), batch_id), self.attempts, self.delay_s)
                    fs.write_record(self.spark, f"{self.root}/{r.name}", batch_id, json.dumps({"batch_id": batch_id}))
                except Exception as e:  # the other results go on
                    failed[r.name] = e
        finally:
            df.unpersist()
        if failed:
            raise RuntimeError(f"results of batch {batch_id} that failed: {sorted(failed)}") from next(iter(failed.values()))

    def start(self, source: DataFrame, checkpoint: str, trigger: dict | None = None):
        return (source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())


def run_with_restarts(start: Callable[[], object], attempts: int = 10, delay_s: float = 5.0):
    """Fixed-delay restart: ``start()`` builds and starts a query on the same
    checkpoint; on failure wait ``delay_s`` and start again, up to
    ``attempts`` times. Returns the finished query."""
    last = None
    for i in range(attempts):
        try:
            q = start()
            q.awaitTermination()
            if q.exception() is None:
                return q
            last = q.exception()
        except Exception as e:  # restart on the same checkpoint
            last = e
        if i + 1 < attempts:
            time.sleep(delay_s)
    raise RuntimeError(f"query failed after {attempts} attempts") from (
        last if isinstance(last, BaseException) else None)


def side_output_batch(predicate, main_sink, side_sink):
    """O-M9 on a stream: every row goes to ``main_sink``; rows matching
    ``predicate`` also go to ``side_sink``. One ``foreachBatch`` computes the
    batch once (persisted) and writes both outputs."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        main_sink(df, batch_id)
        side_sink(df.filter(predicate), batch_id)
        df.unpersist()
    return fn
