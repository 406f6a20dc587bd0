"""Commit logs on the cluster file system (Hadoop FileSystem API).

Ledgers and version pointers live in the shared checkpoint folder, not on one
machine's disk. A log is a directory of immutable records named by sequence
number. A record is written to a temporary name and renamed to its final name,
which is new, so there is never a moment without a valid latest record. Readers
take the highest record; old records are pruned only after a newer one exists.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_RECORD = re.compile(r"^(\d{20})\.json$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read(spark: SparkSession, fs, p) -> str:
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_latest(spark: SparkSession, log_dir: str, before: int | None = None) -> str | None:
    """Text of the highest-numbered record in ``log_dir``, below ``before`` if that is given
    (None if there is none)."""
    fs, d = _fs(spark, log_dir)
    if not fs.exists(d):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(d)]
    seqs = sorted(n for n in names if _RECORD.match(n) and (before is None or int(n[:20]) < before))
    if not seqs:
        return None
    jvm = spark.sparkContext._jvm
    return _read(spark, fs, jvm.org.apache.hadoop.fs.Path(log_dir.rstrip("/") + "/" + seqs[-1]))


def names(spark: SparkSession, path: str) -> list:
    """The names in a folder, sorted (none if there is no folder)."""
    fs, d = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(d)) if fs.exists(d) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_record(spark: SparkSession, log_dir: str, seq: int, text: str, keep: int = 10) -> None:
    """Publish record ``seq`` (idempotent: an existing record is kept)."""
    fs, d = _fs(spark, log_dir)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(d)
    name = f"{seq:020d}.json"
    final = jvm.org.apache.hadoop.fs.Path(log_dir.rstrip("/") + "/" + name)
    if fs.exists(final):
        return
    tmp = jvm.org.apache.hadoop.fs.Path(log_dir.rstrip("/") + "/." + name + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, final):
        fs.delete(tmp, False)
        if not fs.exists(final):
            raise IOError(f"could not publish {final}")
    old = sorted(s.getPath().getName() for s in fs.listStatus(d)
                 if _RECORD.match(s.getPath().getName()))[:-keep]
    for n in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(log_dir.rstrip("/") + "/" + n), False)
