"""Window assigners and window aggregates (O-W1 .. O-W6, O-G1 .. O-G14).

Windows are columns, not operators: ``F.window`` (tumbling/sliding, aligned to
the epoch in the session time zone, UTC) or a user assigner returning
(start, end) column expressions. Aggregates are ordinary ``groupBy`` over the
window columns, so Spark plans partial + final aggregation around a single
exchange and a global (non-keyed) window stays parallel until the final merge.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.scalar import epoch_ms, from_epoch_ms

UNB = Window.unboundedPreceding


def _ms(duration: str) -> int:
    """Spark duration string (e.g. '1 day', '6 hours', '500 milliseconds') to ms."""
    units = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
             "day": 86_400_000, "week": 604_800_000}
    total = 0
    toks = duration.split()
    for n, u in zip(toks[::2], toks[1::2]):
        u = u.lower().rstrip("s")
        total += int(float(n) * units[u])
    return total


def tumbling(df: DataFrame, ts: str, size: str, prefix: str = "window") -> DataFrame:
    """O-W1: tumbling event-time window -> ``window_start``/``window_end``."""
    w = F.window(ts, size)
    return df.withColumn(f"{prefix}_start", w.start).withColumn(f"{prefix}_end", w.end)


def window_agg(df: DataFrame, ts: str, size: str, keys: list, aggs: list,
               slide: str | None = None) -> DataFrame:
    """Aggregates per tumbling (or, with ``slide``, sliding) window and keys. Grouping is
    on the window itself, which keeps a stream's watermark, so one definition runs on
    tables and on watermarked streams in append mode."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    got = df.groupBy(w.alias("_w"), *keys).agg(*aggs)
    return got.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *[c for c in got.columns if c != "_w"])


def sliding(df: DataFrame, ts: str, size: str, slide: str, prefix: str = "window") -> DataFrame:
    """O-W2: sliding window; a row belongs to every window that contains it."""
    return (df.withColumn("_w", F.window(ts, size, slide))
              .withColumn(f"{prefix}_start", F.col("_w.start"))
              .withColumn(f"{prefix}_end", F.col("_w.end")).drop("_w"))


def epoch_aligned(size: str) -> Callable[[Column], tuple]:
    """O-W4 default assigner: ``start = ts - ts % size`` on epoch ms."""
    size_ms = _ms(size)

    def assign(ts: Column):
        ms = epoch_ms(ts)
        start = ms - F.pmod(ms, F.lit(size_ms))
        return from_epoch_ms(start), from_epoch_ms(start + F.lit(size_ms))
    return assign


def custom_window(df: DataFrame, ts: str, assigner: Callable[[Column], tuple],
                  prefix: str = "window") -> DataFrame:
    """O-W4: a user-supplied window assigner given as column expressions."""
    start, end = assigner(F.col(ts))
    return df.withColumn(f"{prefix}_start", start).withColumn(f"{prefix}_end", end)


def processing_time(df: DataFrame, out: str = "pt") -> DataFrame:
    """O-W6: processing-time characteristic - the arrival clock as a column."""
    return df.withColumn(out, F.current_timestamp())


def sliding_agg(df: DataFrame, ts: str, size: str, slide: str, keys: list,
                sums: dict, count_alias: str | None = "cnt",
                pane_ratio_limit: int = 2) -> DataFrame:
    """Sliding-window count/sum by panes and differences.

    With k = size/slide, ``F.window`` expands every row k times before the
    partial aggregation. When k is large, tumbling panes of one slide are aggregated first. A
    pane then counts from the first window that holds it and no longer k windows later: two rows a
    pane, a gain and a loss, and a running sum per key over them, instead of k copies. Between two
    changes a window's sum stays, and its windows are written out from the one running value. The running
    sum of a key has at most two rows a pane, however many rows the key has. Sums that are not of
    whole numbers or decimals would gather rounding errors, so they are added up from k copies of the panes.
    For k <= 2 the direct form (one exchange instead of two) is cheaper.
    """
    size_ms, slide_ms = _ms(size), _ms(slide)
    k = size_ms // slide_ms
    aggs = [F.sum(c).alias(a) for a, c in sums.items()]
    if df.isStreaming or size_ms % slide_ms != 0 or k <= pane_ratio_limit:
        count = [F.count(F.lit(1)).alias(count_alias)] if count_alias else []
        return window_agg(df, ts, size, keys, count + aggs, slide)
    pane = F.window(ts, slide)
    panes = df.groupBy(pane.start.alias("_ps"), *keys).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    panes = panes.withColumn("_p", epoch_ms("_ps"))
    exact = all(isinstance(panes.schema[c].dataType, (T.IntegralType, T.DecimalType)) for c in sums)
    if exact:
        res = _by_differences(_dealt(panes, keys), keys, list(sums), k, slide_ms)
    else:
        res = _by_copies(panes, keys, list(sums), k, slide_ms)
    return _bounds(res, df.schema[ts].dataType, size_ms, keys, count_alias, list(sums))


def sliding_counts_of(df: DataFrame, ts: str, size: str, slide: str, keys: list,
                      expand: Callable[[DataFrame, tuple], DataFrame], weight: Column,
                      count_alias: str = "cnt", part_bytes: int = 8 << 20) -> DataFrame:
    """Sliding-window counts of the rows that ``expand(rows, keep)`` makes of each row, such as
    the words of a text; the result is that of ``sliding_agg`` over the expanded rows.

    ``sliding_agg`` moves a row for each (pane, key), which for the words of texts is many
    times the texts. Here a row moves once, unexpanded, to the block of windows that hold it, and all
    else is done where it then lies: a block is a stretch of 16 (k - 1) window starts, so at most
    one row in 16 has windows in two blocks and goes to both. ``weight`` is the size of a row in
    bytes; tasks get about ``part_bytes`` each, so that neither the counts nor their order
    outgrow a task's memory, whatever the size of the table. A block of over four times that (many rows in one
    second) would be one long task: its panes are counted where the rows are read, and dealt by key.
    """
    size_ms, slide_ms = _ms(size), _ms(slide)
    k = size_ms // slide_ms
    if df.isStreaming or size_ms % slide_ms != 0 or k <= 2:
        return sliding_agg(expand(df, (ts,)), ts, size, slide, keys, {}, count_alias)
    span_ms = 16 * (k - 1) * slide_ms
    rows = df.withColumn("_p", epoch_ms(F.window(ts, slide).start))
    first, last = (c - F.pmod(c, F.lit(span_ms)) for c in (F.col("_p") - F.lit((k - 1) * slide_ms), F.col("_p")))
    rows = rows.withColumn("_b", F.explode(F.sequence(first, last, F.lit(span_ms))))
    total, heavy = (rows.groupBy("_b").agg(F.sum(weight).alias("_w"))
                    .agg(F.sum("_w"), F.collect_list(F.when(F.col("_w") > 4 * part_bytes, F.col("_b")))).first())
    small = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * (total or 0) // part_bytes)
    tasks = max(-(-(total or 0) // part_bytes), small, 1)

    def counted(part, deal):
        panes = expand(part, ("_b", "_p")).groupBy("_b", "_p", *keys).agg(F.count(F.lit(1)).alias("_n"))
        return _by_differences(deal(panes), ["_b", *keys], [], k, slide_ms, span_ms)

    res = counted((rows.where(~F.col("_b").isin(heavy)) if heavy else rows).repartition(tasks, "_b"), lambda panes: panes)
    if heavy:
        res = res.unionByName(counted(rows.where(F.col("_b").isin(heavy)), lambda panes: _dealt(panes, ["_b", *keys])))
    return _bounds(res, df.schema[ts].dataType, size_ms, keys, count_alias, [])


def _dealt(panes: DataFrame, keys: list) -> DataFrame:
    """The panes of a key together, moved before a gain and a loss are made of each."""
    return panes.repartition(*keys) if keys else panes


def _bounds(res: DataFrame, kind: T.DataType, size_ms: int, keys: list, count_alias: str | None, out_cols: list) -> DataFrame:
    """Window start and end for ``_s``, of the input's type, whatever the ratio of size to slide."""
    def bound(ms):
        return F.timestamp_millis(ms).cast(kind)

    return res.select(bound(F.col("_s")).alias("window_start"),
                      bound(F.col("_s") + F.lit(size_ms)).alias("window_end"),
                      *keys, *([F.col("_n").alias(count_alias)] if count_alias else []), *out_cols)


def _by_copies(panes: DataFrame, keys: list, out_cols: list, k: int, slide_ms: int) -> DataFrame:
    """(_s, keys, _n, sums) of every window, from a copy of each pane for each of its windows."""
    each = panes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = (F.col("_p") - F.col("_i") * F.lit(slide_ms)).alias("_s")
    return each.select(*keys, "_n", *out_cols, start).groupBy("_s", *keys).agg(*[F.sum(c).alias(c) for c in ("_n", *out_cols)])


def _by_differences(panes: DataFrame, keys: list, out_cols: list, k: int, slide_ms: int,
                    span_ms: int | None = None) -> DataFrame:
    """(_s, keys, _n, sums) of every window, from a gain and a loss of each pane. With ``span_ms``,
    of the windows that start in the stretch of that length from ``_b`` on, which is one of the keys."""
    first, gone = F.col("_p") - F.lit((k - 1) * slide_ms), F.col("_p") + F.lit(slide_ms)
    if span_ms:
        first, gone = F.greatest(first, F.col("_b")), F.least(gone, F.col("_b") + F.lit(span_ms))
    changes = panes.select(*keys, "_n", *out_cols, F.explode(F.array(
        F.struct(first.alias("t"), F.lit(1).alias("sign")), F.struct(gone.alias("t"), F.lit(-1).alias("sign")))).alias("_c"))
    line = Window.partitionBy(*keys).orderBy("_c.t") if keys else Window.orderBy("_c.t")
    so_far = line.rowsBetween(UNB, 0)
    run = changes.select(*keys, F.col("_c.t").alias("_t"), F.lead("_c.t").over(line).alias("_next"),
                         F.sum(F.col("_n") * F.col("_c.sign")).over(so_far).alias("_n"),
                         *[F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("_c.sign")).over(so_far).alias(c) for c in out_cols],
                         *[F.sum(F.col(c).isNotNull().cast("int") * F.col("_c.sign")).over(so_far).alias(f"_some{i}")
                           for i, c in enumerate(out_cols)])
    run = run.where((F.col("_n") > 0) & (F.col("_next") > F.col("_t")))
    kinds = panes.schema
    return run.select(F.explode(F.sequence("_t", F.col("_next") - F.lit(slide_ms), F.lit(slide_ms))).alias("_s"), *keys, "_n",
                      *[F.when(F.col(f"_some{i}") > 0, F.col(c)).cast(kinds[c].dataType).alias(c)
                        for i, c in enumerate(out_cols)])


def first_row_values(cols: list, arrival: str) -> list:
    """Aggregates returning the *first* row's value (by arrival) of each col."""
    return [F.min_by(F.col(c), F.col(arrival)).alias(c) for c in cols]


def max_row(value: str, seq: str, cols: list, first_on_ties: bool = True) -> Column:
    """O-G3/O-G4: the whole row with the max ``value``; ties go to the first
    (``maxBy``) or the last (``reduce`` with strict ``>``) row by ``seq``."""
    tie = (-F.col(seq)) if first_on_ties else F.col(seq)
    return F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(value), tie))


def top_n(df: DataFrame, group: list, order: list, n: int, rank_col: str = "rank") -> DataFrame:
    """O-G14: true top-N per group (``row_number`` with a total order).

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the exchange, so each map task ships at most n rows per group: a hot group
    (one window end holding most items) costs n x tasks rows, not all rows.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def early_firing_counts(df: DataFrame, keys: list, ts: str, size: str, tick: str) -> DataFrame:
    """O-W5 (bounded form): tumbling count with early firings.

    For each (key, window) the first row arms a timer at the next tick after
    it; each firing re-arms the next tick while it is before the window end, so
    ticks repeat the count even with no new row. The final result is emitted at
    ``end - 1 ms`` with the full count. ``eval_time`` is the firing time (the
    watermark, taken equal to event time); the count at a tick includes rows
    with ``ts <= tick``.
    """
    size_ms, tick_ms = _ms(size), _ms(tick)
    w = F.window(ts, size)
    rows = df.select(*keys, w.start.alias("window_start"), w.end.alias("window_end"),
                     epoch_ms(ts).alias("_t"))
    # Grid tick that first sees the row: smallest multiple of tick >= ts.
    rows = rows.withColumn("_g", F.ceil(F.col("_t") / F.lit(tick_ms)) * F.lit(tick_ms))
    per_tick = rows.groupBy(*keys, "window_start", "window_end", "_g").agg(
        F.count(F.lit(1)).alias("_n"))
    first = rows.groupBy(*keys, "window_start", "window_end").agg(
        F.min("_t").alias("_first"), F.count(F.lit(1)).alias("_total"))
    end_ms = epoch_ms("window_end")
    # Ticks fire at every grid point strictly after the first row and before the end.
    first_tick = (F.floor(F.col("_first") / F.lit(tick_ms)) + 1) * F.lit(tick_ms)
    ticks = first.select(*keys, "window_start", "window_end", "_total",
                         F.explode(F.when(first_tick < end_ms, F.sequence(
                             first_tick, end_ms - F.lit(1), F.lit(tick_ms).cast("bigint")))
                             .otherwise(F.array().cast("array<bigint>"))).alias("_tick"))
    ticks = ticks.filter(F.col("_tick") < end_ms)
    # Cumulative count at each tick: rows whose grid tick <= this tick. Groups
    # are (key, window) with at most size/tick rows each.
    grid = (ticks.join(per_tick.withColumnRenamed("_g", "_tick"),
                       [*keys, "window_start", "window_end", "_tick"], "full")
                 .withColumn("_n", F.coalesce("_n", F.lit(0))))
    wc = Window.partitionBy(*keys, "window_start", "window_end").orderBy("_tick").rowsBetween(UNB, 0)
    grid = grid.withColumn("cnt", F.sum("_n").over(wc)).filter(F.col("_total").isNotNull())
    early = grid.select(*keys, "window_end", from_epoch_ms("_tick").alias("eval_time"),
                        F.col("cnt").cast("bigint").alias("cnt"))
    final = first.select(*keys, "window_end",
                         from_epoch_ms(end_ms - F.lit(1)).alias("eval_time"),
                         F.col("_total").cast("bigint").alias("cnt"))
    return early.unionByName(final)


def running_detail(df: DataFrame, keys: list, ts: str, size: str, arrival: str) -> DataFrame:
    """O-G13: one output per element with the running size of its window, the
    first row's ts, this row's ts, window start and end (arrival order).

    Running size and first ts come from one scan over (key, window) in arrival blocks,
    so a hot (key, window) is not sorted in one task.
    """
    from eventflow.operators.scan import arrival_block, scan
    w = F.window(ts, size)
    rows = (df.withColumn("window_start", w.start).withColumn("window_end", w.end)
              .withColumn("_one", F.lit(1)))
    grp = (*keys, "window_start", "window_end")
    rows = scan(rows, [("_one", "sum", "size"), (ts, "first", "first_ts")], [arrival],
                arrival_block(rows, arrival), grp)
    return rows.select(*keys, F.col("size").cast("bigint").alias("size"), "first_ts",
                       F.col(ts).alias("ts"), "window_start", "window_end")
