"""Shared helpers of the text operators: Arrow batches cut by bytes, words and
64-bit hashes of whole batches in numpy, and names that cannot clash.

Texts are handled as the UTF-8 bytes of an Arrow string column. A null text
counts as an empty one. Work is done on slices of whole rows of about
``SLICE_BYTES``; a single longer text forms a slice of its own, so memory per
task follows the longest text and not the batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.session import scratch_path

SLICE_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
BATCH_BYTES_CONF = "spark.eventflow.llm.batchBytes"

# The word separators of every operator here: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.RandomState(20240229)
_BYTE_HASH = (_RNG.randint(0, 1 << 62, 256).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_P = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


def fresh(name: str, *taken) -> str:
    """``name``, lengthened until no given DataFrame or list has such a column."""
    used = {c.lower() for t in taken for c in (t.columns if isinstance(t, DataFrame) else t)}
    while name.lower() in used:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it
    back: cuts lineage and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have length 0."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``most`` bytes."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


class Words:
    """The words of a slice of texts: ``starts``/``ends`` (byte positions in
    ``raw``), ``row`` (index of each word's text), ``per_row`` word counts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        n = len(raw)
        inside = ~_SEP[raw]
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
            heads = offsets[:-1]
            before[heads[heads < n]] = False  # texts do not run into one another
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
            tails = offsets[1:] - 1
            after[tails[(tails >= 0) & (offsets[1:] > offsets[:-1])]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.inside = inside
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.per_row = np.bincount(self.row, minlength=len(offsets) - 1)

    def hashes(self, raw: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of every word (equal words have equal hashes)."""
        raw = self.raw if raw is None else raw
        return range_hash(raw, self.starts, self.ends)


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _CACHE.get("n", -1) < n:
        keep = max(n, SLICE_BYTES + (1 << 16)) if n <= 4 * SLICE_BYTES else n
        tables = _powers(_P, keep), _powers(_P_INV, keep)
        if n > 4 * SLICE_BYTES:
            return tables
        _CACHE.update(n=keep, t=tables)
    return _CACHE["t"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: a prefix sum of byte values times powers of
    an odd number, shifted back to the range's start, with its length."""
    up, down = _power_table(len(raw))
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_HASH[raw] * up[:len(raw)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def release() -> None:
    """Gives spare memory back: an idle Python worker stays beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` with columns of any name, dots included: by place. The session's
    Arrow batches are held to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` (or what the session's
    ``spark.eventflow.llm.batchBytes`` says), since several Python workers of an executor hold
    one each, and Spark's own buffers as many again."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(conf.get(BATCH_BYTES_CONF, str(BATCH_BYTES))))
    places = [f"c{i}" for i in range(len(schema))]

    def renamed(batches):
        for batch in run(batches):
            yield batch.rename_columns(places)
        release()

    inner = T.StructType([T.StructField(c, f.dataType, f.nullable) for c, f in zip(places, schema)])
    src = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return src.mapInArrow(renamed, inner).toDF(*schema.names)


def map_rows(df: DataFrame, text: str, fields: list[T.StructField],
             fn: Callable[[pa.Array], list[pa.Array]], keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (default: all) plus columns computed from the text
    column by ``fn`` (string array -> arrays, row by row), in Arrow batches.
    Rows are neither moved nor reordered."""
    keep = df.columns if keep is None else keep
    src = df.select(*[col(c) for c in keep], col(text).cast("string").alias(fresh("_text", keep)))
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns - 1
            sizes = buffers(batch.column(n))[1]
            for a, b in slices(sizes, 8 * SLICE_BYTES):
                part = batch.slice(a, b - a)
                out = fn(part.column(n))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(n)), *out], names=schema.names)

    return map_arrow(src, run, schema)
