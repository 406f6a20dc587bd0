"""Sinks: delimited text (O-K1), JSON documents (O-K6), Kafka JSON (O-K7),
write-ahead batches with a commit ledger (O-K4) and the exactly-once file
sink (O-K3, Structured Streaming's file sink + its ``_spark_metadata`` log).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.sinks import fs


def write_delimited(df: DataFrame, path: str, sep: str = " ", mode: str = "overwrite") -> None:
    """O-K1: rows as ``sep``-delimited text, one row per line."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def to_json_documents(df: DataFrame, cols: list | None = None, out: str = "doc") -> DataFrame:
    """O-R9 / O-K6: one JSON document per row."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))


def write_json_documents(df: DataFrame, path: str, doc_col: str = "doc",
                         index: str | None = None, doc_type: str | None = None,
                         fmt: str = "text", options: dict | None = None,
                         mode: str = "append") -> None:
    """O-K6: write ready-made JSON documents. With the default ``text``
    format each document is one line of a file below ``path/index/type``;
    ``fmt``/``options`` plug in a search-index connector when one is on the
    classpath (bulk size and retries then come from its options)."""
    target = "/".join(p for p in (path.rstrip("/"), index, doc_type) if p)
    w = df.select(F.col(doc_col).alias("value")).write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(target)


def kafka_records(df: DataFrame, value_col: str, key_col: str | None = None) -> DataFrame:
    """O-K7: (key, value) string records for a Kafka sink."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.col(value_col).cast("string").alias("value"))


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict:
    """O-K7: topic and servers are parameters (not fixed)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "checkpointLocation": checkpoint}


class WriteAheadSink:
    """O-K4: write-ahead sink over ``foreachBatch``.

    Each micro-batch is written to ``root/data/batch=<id>`` and only then
    recorded in the commit ledger ``root/_commits`` (last committed batch id,
    atomic rename). A batch id at or below the ledger is skipped, so a batch
    replayed after a failure is emitted once.
    """

    def __init__(self, spark, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def last_committed(self) -> int:
        txt = fs.read_latest(self.spark, f"{self.root}/_commits")
        return -1 if txt is None else int(json.loads(txt)["batch_id"])

    def is_committed(self, batch_id: int) -> bool:
        return batch_id <= self.last_committed()

    def write_batch(self, df: DataFrame, batch_id: int) -> bool:
        if "batch" in (c.lower() for c in df.columns):
            raise ValueError("the sink keeps its batch id in a column named batch")
        if self.is_committed(batch_id):
            return False
        df.write.mode("overwrite").format(self.fmt).save(f"{self.root}/data/batch={batch_id}")
        fs.write_record(self.spark, f"{self.root}/_commits", batch_id,
                        json.dumps({"batch_id": batch_id}))
        return True

    def read(self) -> DataFrame:
        """The rows of committed batches; a batch written but not yet recorded is not
        visible."""
        rows = self.spark.read.format(self.fmt).load(f"{self.root}/data")
        return rows.where(F.col("batch") <= self.last_committed())

    def foreach_batch(self):
        def fn(df: DataFrame, batch_id: int) -> None:
            self.write_batch(df, batch_id)
        return fn


def with_retries(fn, attempts: int = 5, backoff_s: float = 0.5):
    """Call ``fn()``; on failure wait ``backoff_s`` and retry, ``attempts``
    times in total (the bulk sink's retry policy)."""
    import time
    for i in range(attempts):
        try:
            return fn()
        except Exception:
            if i + 1 == attempts:
                raise
            time.sleep(backoff_s)


class JsonDocumentSink:
    """O-K6 on a stream: each micro-batch's documents go to
    ``root/index/type/batch=<id>`` (overwritten on replay, so a retried batch
    is written once), in files of at most ``max_docs_per_file`` documents, the bulk
    size, with bounded retries. ``sinks.bulk`` sends bulks to a client instead."""

    def __init__(self, root: str, index: str, doc_type: str, doc_col: str = "doc", max_docs_per_file: int = 1000,
                 attempts: int = 5, backoff_s: float = 0.5):
        self.target = f"{root.rstrip('/')}/{index}/{doc_type}"
        self.doc_col, self.max_docs_per_file = doc_col, max_docs_per_file
        self.attempts, self.backoff_s = attempts, backoff_s

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        out = df.select(F.col(self.doc_col).alias("value"))
        with_retries(lambda: out.write.mode("overwrite").option("maxRecordsPerFile", self.max_docs_per_file)
                     .text(f"{self.target}/batch={batch_id}"), self.attempts, self.backoff_s)

    def foreach_batch(self):
        return self.write_batch
