"""Bulk document sink (O-K6): JSON documents sent in bulks, from batches and streams.

A Python data source writer. Each task sends its documents in bulks of at most
``bulk_size``, and repeats a bulk that fails, ``attempts`` times in all and ``backoff_ms``
apart; a bulk that never succeeds fails the task, which takes back what it has sent. A
task's bulks are staged: they become visible when the driver has the receipts of all tasks and
commits the write, all of them or none. An aborted write takes back all that is staged under
its name; what a task that outlives it stages stays unseen, and ``discard_staged`` removes it. A stream publishes each micro-batch under its number,
and a batch that is there already, after a restart, is not published again.

Where documents go is a client's matter (``client``, "module:name" of a class made from the
options). ``FolderClient`` writes a file of lines for each bulk, on any file system that
Arrow reaches (``file``, ``hdfs``, ``s3``, ...), which must be shared by the cluster. A client for a search service
has the same few methods: stage by writing under the bulk's name as a hidden version or
into a write's own index, publish by an alias switch.

Null documents are sent as they come, as ``null`` lines. An empty write publishes nothing but
its record. Columns other than ``doc`` are not accepted.

    spark.dataSource.register(BulkDocuments)
    docs.write.format("bulk_documents").option("url", "...").option("index", "events").mode("append").save()
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from eventflow.sinks.files import with_retries

# The reference's bulk flush.
BULK_SIZE, ATTEMPTS, BACKOFF_MS = 1000, 5, 500


@dataclass
class BulkReceipt(WriterCommitMessage):
    """What a task has staged: the write's name, those of its bulks and the number of documents."""
    write: str
    bulks: list = field(default_factory=list)
    documents: int = 0


class FolderClient:
    """Bulks as files of lines: staged in ``_staging/<write>``, published in ``<write>``."""

    def __init__(self, options: dict):
        base = "/".join(p for p in (options["url"].rstrip("/"), options.get("index"), options.get("type")) if p)
        self.fs, self.root = arrow_fs.FileSystem.from_uri(base if "://" in base or base.startswith("file:") else f"file://{base}")

    def stage(self, write: str, bulk: str, docs: list) -> None:
        folder = f"{self.root}/_staging/{write}"
        self.fs.create_dir(folder, recursive=True)
        with self.fs.open_output_stream(f"{folder}/{bulk}") as out:  # whole or not at all under this name
            out.write("".join(f"{'null' if d is None else d}\n" for d in docs).encode())

    def discard(self, write: str, bulks: list | None = None) -> None:
        """Takes back some bulks of a write, or all that there are."""
        folder = f"{self.root}/_staging/{write}"
        if bulks is None:
            if self.fs.get_file_info(folder).type == arrow_fs.FileType.Directory:
                self.fs.delete_dir(folder)
            return
        for b in bulks:
            if self._there(f"{folder}/{b}"):
                self.fs.delete_file(f"{folder}/{b}")

    def published(self, target: str) -> bool:
        return self._there(f"{self.root}/_commits/{target}.json")

    def publish(self, write: str, target: str, bulks: list, documents: int) -> None:
        """Moves the bulks to ``target`` and then records it. Names are new, so a publication
        that stopped half way is carried on by the next attempt of the same write."""
        self.fs.create_dir(f"{self.root}/{target}", recursive=True)
        self.fs.create_dir(f"{self.root}/_commits", recursive=True)
        for b in bulks:
            staged, final = f"{self.root}/_staging/{write}/{b}", f"{self.root}/{target}/{b}"
            if self._there(staged):
                self.fs.move(staged, final)
        with self.fs.open_output_stream(f"{self.root}/_commits/{target}.json") as out:
            out.write(json.dumps({"bulks": bulks, "documents": documents}).encode())

    def clear(self, target: str) -> None:
        """Takes away what an earlier, unrecorded publication of ``target`` left."""
        if self.fs.get_file_info(f"{self.root}/{target}").type == arrow_fs.FileType.Directory:
            self.fs.delete_dir(f"{self.root}/{target}")

    def discard_staged(self) -> None:
        if self.fs.get_file_info(f"{self.root}/_staging").type == arrow_fs.FileType.Directory:
            self.fs.delete_dir(f"{self.root}/_staging")

    def _there(self, path: str) -> bool:
        return self.fs.get_file_info(path).type == arrow_fs.FileType.File


def _client(options: dict):
    module, name = options.get("client", f"{__name__}:FolderClient").split(":")
    return getattr(importlib.import_module(module), name)(options)


class _Bulks:
    """The part that batches and streams share. Receipts carry the write's name, since a
    stream commits through another copy of its writer than its tasks hold."""

    def __init__(self, options: dict):
        self.options, self.name = dict(options), f"write-{uuid.uuid4().hex[:12]}"
        self.size = int(options.get("bulk_size", BULK_SIZE))
        self.attempts = int(options.get("attempts", ATTEMPTS))
        self.backoff_s = int(options.get("backoff_ms", BACKOFF_MS)) / 1000
        if self.size < 1 or self.attempts < 1:
            raise ValueError("bulk_size and attempts are at least 1")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> BulkReceipt:
        from pyspark import TaskContext
        task = TaskContext.get()
        client, receipt, waiting = _client(self.options), BulkReceipt(self.name), []

        def flush(docs: list) -> None:
            bulk = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(receipt.bulks):06d}.txt"
            with_retries(lambda: client.stage(self.name, bulk, docs), self.attempts, self.backoff_s)
            receipt.bulks.append(bulk)
            receipt.documents += len(docs)

        try:
            for batch in iterator:
                waiting += batch.column(0).to_pylist()
                while len(waiting) >= self.size:
                    flush(waiting[:self.size])
                    waiting = waiting[self.size:]
            if waiting:
                flush(waiting)
        except BaseException:
            client.discard(self.name, receipt.bulks)
            raise
        return receipt

    def _publish(self, target: str, messages: list) -> None:
        client, got = _client(self.options), [m for m in messages if m is not None]
        if not client.published(target):
            client.clear(target)
            bulks = [b for m in got for b in m.bulks]
            client.publish(got[0].write if got else self.name, target, bulks, sum(m.documents for m in got))
        else:
            for m in got:
                client.discard(m.write, m.bulks)

    def _discard(self, messages: list) -> None:
        client = _client(self.options)
        for write in {self.name, *(m.write for m in messages if m is not None)}:
            client.discard(write)


class BulkWriter(_Bulks, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._publish(self.name, messages)

    def abort(self, messages: list) -> None:
        self._discard(messages)


class BulkStreamWriter(_Bulks, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._publish(f"batch={batchId}", messages)

    def abort(self, messages: list, batchId: int) -> None:
        self._discard(messages)


class BulkDocuments(DataSource):
    """Options: ``url``, ``index``, ``type``, ``bulk_size``, ``attempts``, ``backoff_ms``, ``client``."""

    @classmethod
    def name(cls) -> str:
        return "bulk_documents"

    def schema(self) -> StructType:
        return StructType([StructField("doc", StringType())])

    def _checked(self, schema: StructType) -> dict:
        if [f.dataType for f in schema] != [StringType()]:
            raise ValueError("bulk_documents takes one string column, the document")
        return self.options

    def writer(self, schema: StructType, overwrite: bool) -> BulkWriter:
        if overwrite:
            raise ValueError("bulk_documents appends; use mode('append')")
        return BulkWriter(self._checked(schema))

    def streamWriter(self, schema: StructType, overwrite: bool) -> BulkStreamWriter:
        return BulkStreamWriter(self._checked(schema))
