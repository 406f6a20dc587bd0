"""Event time, watermarks and late data on bounded tables (O-M1 .. O-M9).

A watermark is made a column: ``wm(i)`` = max event time over the rows that
*arrived* strictly before row i (arrival order = a dense sequence such as
``event_id``), minus the out-of-orderness delay. This is the deterministic
stand-in for a periodic/punctuated watermark generator and is computed with
the two-level block scan of ``scan.running_max_before`` (no global sort).

Structured Streaming drops late rows before they reach stateful operators, so
the late-row routing here keeps its own clock (see ``streaming.late``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.operators.scan import arrival_block, running_max_before, scan
from eventflow.operators.windows import _ms

def epoch_us(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_epoch_us(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(c).cast("timestamp_ntz")


def with_watermark_column(df: DataFrame, ts: str, arrival: str, delay: str,
                          out: str = "wm", marker: Column | None = None,
                          block: int | None = None) -> DataFrame:
    """O-M1/M2/M4/M5 (``marker`` None): bounded out-of-orderness watermark.
    O-M3 (``marker`` given): punctuated - only marker rows advance it.

    Adds ``out`` (timestamp, null before the first contributing row) and
    ``_wm_us`` (the same in epoch microseconds) for exact comparisons.
    """
    delay_us = _ms(delay) * 1000
    t = epoch_us(ts)
    if marker is not None:
        t = F.when(marker, t)
    df = df.withColumn("_t_us", t)
    df = running_max_before(df, "_t_us", arrival, "_mx", block=block)
    return (df.withColumn("_wm_us", F.col("_mx") - F.lit(delay_us))
              .withColumn(out, from_epoch_us("_wm_us"))
              .drop("_t_us", "_mx"))


def late_flag(ts: str, wm_us: str = "_wm_us") -> Column:
    """O-M6: ``ts < current watermark``, as a column, for both outputs from one pass."""
    return F.coalesce(epoch_us(ts) < F.col(wm_us), F.lit(False))


def late_split(df: DataFrame, ts: str, wm_us: str = "_wm_us") -> tuple:
    """O-M6: ``ts < current watermark`` -> late side output, else main."""
    late = late_flag(ts, wm_us)
    return df.filter(~late), df.filter(late)


def window_late_flag(ts: str, size: str, wm_us: str, lateness: str = "0 seconds") -> Column:
    """A row is late for its tumbling window when
    ``window_end - 1 ms + allowed_lateness <= watermark``."""
    end_us = epoch_us(F.window(ts, size).end)
    return F.coalesce(end_us - F.lit(1000) + F.lit(_ms(lateness) * 1000) <= F.col(wm_us),
                      F.lit(False))


def window_count_with_late(df: DataFrame, keys: list, ts: str, size: str,
                           wm_us: str = "_wm_us") -> tuple:
    """O-M7: per-window count of on-time rows; late rows to a side output."""
    flagged = df.withColumn("_late", window_late_flag(ts, size, wm_us))
    on_time = flagged.filter(~F.col("_late"))
    w = F.window(ts, size)
    counts = on_time.groupBy(*keys, w.end.alias("window_end")).agg(
        F.count(F.lit(1)).alias("cnt"))
    return counts, flagged.filter(F.col("_late")).drop("_late")


def allowed_lateness_counts(df: DataFrame, keys: list, ts: str, size: str,
                            lateness: str, arrival: str,
                            wm_us: str = "_wm_us") -> DataFrame:
    """O-M8: window count with allowed lateness.

    The first result (``kind='first'``) is emitted when the watermark passes
    ``end - 1 ms``, with the on-time count. Every late row that is still
    within the lateness re-fires the window with the count so far (``update``,
    or ``first`` if the window had no on-time row). Later rows are dropped.
    """
    w = F.window(ts, size)
    end_us = epoch_us(w.end) - F.lit(1000)
    wm = F.col(wm_us)
    on_time = F.coalesce(wm < end_us, F.lit(True))
    late_ok = (~on_time) & (wm < end_us + F.lit(_ms(lateness) * 1000))
    rows = df.select(*keys, arrival, w.end.alias("window_end"),
                     on_time.alias("_on"), late_ok.alias("_ok"))
    kept = rows.filter(F.col("_on") | F.col("_ok"))
    firsts = (kept.filter(F.col("_on"))
                  .groupBy(*keys, "window_end")
                  .agg(F.count(F.lit(1)).alias("cnt"))
                  .withColumn("kind", F.lit("first")))
    # Rank among the window's kept rows by arrival: a running count per
    # (key, window) computed over arrival blocks, so a hot (key, window) is
    # still split across tasks.
    ranked = scan(kept.withColumn("_one", F.lit(1)), [("_one", "sum", "_rn")], [arrival],
                  arrival_block(kept, arrival), (*keys, "window_end")).filter(F.col("_ok"))
    updates = ranked.select(*keys, "window_end", F.col("_rn").cast("bigint").alias("cnt"),
                            F.when(F.col("_rn") == 1, "first").otherwise("update").alias("kind"))
    return firsts.unionByName(updates)


def side_outputs(df: DataFrame, predicate: Column) -> tuple:
    """O-M9: every row stays on the main output; rows matching ``predicate``
    are also emitted on the side output."""
    return df, df.filter(predicate)
