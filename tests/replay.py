"""Replays a table as a file stream, for tests."""

import time

from pyspark.sql import functions as F


def write_replay_files(df, path: str, order: str, n_files: int) -> None:
    """Write ``df`` as ``n_files`` parquet files in ``order`` ranges (one
    directory per part, written in order)."""
    b = df.agg(F.min(order), F.max(order)).first()
    lo, hi = int(b[0]), int(b[1])
    step = (hi - lo) // n_files + 1
    for i in range(n_files):
        part = df.filter((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("overwrite").parquet(f"{path}/part-{i:04d}")
        time.sleep(1.05)  # file streams order files by modification time
