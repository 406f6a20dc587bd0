"""Window operators on streams: early firing (O-W5) and allowed lateness
(O-M8, simple form), next to the plain watermarked window count."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventflow.operators.windows import _ms
from eventflow.streaming.ordered import OrderedProcessor, flat_key, stamp

EARLY_SCHEMA = "id long, window_end timestamp, eval_time timestamp, cnt long"


def _start_ms(start) -> int:
    """A window's start in epoch milliseconds; naive times are UTC (the session zone)."""
    t = pd.Timestamp(start)
    t = t.tz_convert("UTC") if t.tzinfo else t.tz_localize("UTC")
    return int(t.value // 1_000_000)


def windowed_count(stream: DataFrame, keys: list, ts: str, size: str, delay: str,
                   slide: str | None = None) -> DataFrame:
    """Watermarked window count; in append mode each window is emitted once,
    when the watermark passes its end."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (stream.withWatermark(ts, delay).groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(*keys, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "cnt"))


def allowed_lateness_count(stream: DataFrame, keys: list, ts: str, size: str, delay: str,
                           lateness: str) -> DataFrame:
    """O-M8 simple form: keep window state for ``delay + lateness``; run in
    ``update`` mode so every batch re-emits the windows that late rows
    changed. (The exact first/update labelling is the batch form.)"""
    total = f"{(_ms(delay) + _ms(lateness))} milliseconds"
    return windowed_count(stream, keys, ts, size, total)


class EarlyFiringProcessor(StatefulProcessor):
    """O-W5 exact form, keyed by (key, window start): the first row arms a timer at
    the next tick after it and one at ``end - 1 ms``; every tick emits the count of the
    rows up to it and arms the next tick while it is before the end; the final
    firing emits the full count and clears the window's state.

    Map state holds a count per tick (at most size / tick numbers); a batch updates the ticks
    that its rows fall under, and a firing reads those that it passes and folds them into one
    running count. When the watermark passes several ticks at once, each is emitted with its own
    count, and the next timer is armed beyond the watermark."""

    def __init__(self, size: str, tick: str):
        self.size_ms, self.tick_ms = _ms(size), _ms(tick)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # due: the next tick to emit (-1 before the first row); done: rows up to the ticks emitted.
        self.state = handle.getValueState("w", "end long, due long, done long")
        self.counts = handle.getMapState("counts", "tick long", "n long")

    def _frame(self, key, end: int, ticks: list, found: list) -> pd.DataFrame:
        return pd.DataFrame([(key[0], pd.Timestamp(end, unit="ms"), pd.Timestamp(t, unit="ms"), n)
                             for t, n in zip(ticks, found)], columns=["id", "window_end", "eval_time", "cnt"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tick, first, fresh = self.tick_ms, None, {}
        if self.state.exists():
            end, due, done = self.state.get()
        else:
            end, due, done = _start_ms(key[1]) + self.size_ms, -1, 0
            self.handle.registerTimer(end - 1)
        for chunk in rows:
            t = pd.to_datetime(chunk["ts"], utc=True).astype("datetime64[ms, UTC]").astype("int64")
            if not len(t):
                continue
            first = int(t.min()) if first is None else min(first, int(t.min()))
            # The first tick at or after each row.
            for g, n in (-(-t // tick) * tick).value_counts().items():
                fresh[int(g)] = fresh.get(int(g), 0) + int(n)
        for g, n in fresh.items():
            if due > 0 and g < due:  # its tick has been emitted
                done += n
            else:
                old = self.counts.getValue((g,)) if self.counts.containsKey((g,)) else (0,)
                self.counts.updateValue((g,), (old[0] + n,))
        if first is not None:
            want = (first // tick + 1) * tick
            passed = timerValues.getCurrentWatermarkInMs()
            if want <= passed and due > 0:
                want = due  # earlier ticks have been emitted
            if want < end - 1 and (due < 0 or want < due):
                if due > 0:
                    self.handle.deleteTimer(due)
                self.handle.registerTimer(want)
                due = want
        self.state.update((end, due, done))
        yield self._frame(key, end, [], [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            yield self._frame(key, 0, [], [])
            return
        end, due, done = self.state.get()
        at, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        over = at >= end - 1
        ticks, due = [], due if due > 0 else end
        while due < end - 1 and (due <= passed or over):
            ticks.append(due)
            due += self.tick_ms
        last = end if over else ticks[-1] if ticks else -1
        waiting = sorted((g[0], n[0]) for g, n in self.counts.iterator() if over or g[0] <= last)
        found = []
        for t in [*ticks, *([end - 1] if over else [])]:
            while waiting and (waiting[0][0] <= t or t == end - 1):
                g, n = waiting.pop(0)
                done += n
                if not over:
                    self.counts.removeKey((g,))
            found.append(done)
        if over:
            ticks.append(end - 1)
            self.state.clear()
            self.counts.clear()
        else:
            if due < end - 1:
                self.handle.registerTimer(due)
            self.state.update((end, due, done))
        yield self._frame(key, end, ticks, found)

    def close(self) -> None:
        pass


def _by_window(stream: DataFrame, key: str, ts: str, size: str, delay: str, keep: dict, processor: StatefulProcessor,
               schema: str, first: str, out: dict) -> DataFrame:
    """Runs a processor keyed by (key, window start). Inside, the key is ``id`` and the time
    ``ts``, whatever the input calls them; the key may be of any type. ``keep`` maps further columns to
    their names inside. ``schema`` names the key ``first``; ``out`` maps other output names."""
    flat, back = flat_key(F.col(key), stream.schema[key].dataType)
    src = stream.select(flat.alias("id"), F.col(ts).cast("timestamp").alias("ts"),
                        *[F.col(c).alias(own) for c, own in keep.items()])
    kind = src.schema["id"].dataType.simpleString()
    schema = schema.replace(f"{first} long", f"{first} {kind}", 1)
    d = src.withColumn("_ws", F.window("ts", size).start).withWatermark("ts", delay)
    got = d.groupBy("id", "_ws").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return got.select(back(F.col(first)).alias(key), *[F.col(c).alias(out.get(c, c)) for c in got.columns if c != first])


def early_firing(stream: DataFrame, key: str, ts: str, size: str, tick: str,
                 delay: str = "0 seconds") -> DataFrame:
    """O-W5 on a stream: (key, window_end, eval_time, cnt), with event-time timers. The key
    keeps its name and type."""
    return _by_window(stream, key, ts, size, delay, {}, EarlyFiringProcessor(size, tick), EARLY_SCHEMA, "id", {})


def text_word_counts(lines: DataFrame, tokenize, size: str, slide: str | None = None,
                     delay: str = "0 seconds", text_col: str = "value") -> DataFrame:
    """O-E5 / O-E6 on a text stream: lines are stamped with the arrival clock
    (processing time, O-W6), tokenized with one of ``functions.tokens``, and
    counted per tumbling or sliding processing-time window."""
    d = lines.withColumn("pt", F.current_timestamp())
    toks = tokenize(d, text_col, keep=("pt",))
    w = F.window("pt", size, slide) if slide else F.window("pt", size)
    return (toks.withWatermark("pt", delay).groupBy(w.alias("w"), "word")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select("word", F.col("w.end").alias("window_end"), "cnt"))


DETAIL_SCHEMA = ("id long, size long, first_ts timestamp, ts timestamp, "
                 "window_start timestamp, window_end timestamp")


class RunningDetailProcessor(OrderedProcessor):
    """O-G13 / O-E11 on a stream, keyed by (key, window start): one output per
    element with the window's running size, its first element's time and this
    element's time; state is cleared by an event-time timer at the window end. Elements of a
    micro-batch follow their arrival column, chunk by chunk (``streaming.ordered``)."""

    columns = ["id", "size", "first_ts", "ts", "window_start", "window_end"]
    state_name, state_schema = "d", "size long, first long, end long"

    def __init__(self, size: str):
        super().__init__(order="arrival")
        self.size = _ms(size) * 1000

    def row(self, state, t, kind, a, out):
        start = self.start
        size, first, _ = state or [0, t, start + self.size]
        out.append((size + 1, stamp(first), stamp(t), stamp(start), stamp(start + self.size)))
        return [size + 1, first, start + self.size]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.start = _start_ms(key[1]) * 1000
        yield from super().handleInputRows(key, rows, timerValues)

    def due(self, state):
        return state[2]

    def until(self, state, t, out):
        return None


def running_detail_stream(stream: DataFrame, key: str, ts: str, size: str, arrival: str,
                          delay: str = "0 seconds") -> DataFrame:
    """O-E11 on a stream: per-element running window detail. The key and the time keep their
    names, the key its type; ``arrival`` is an integer column."""
    return _by_window(stream, key, ts, size, delay, {arrival: "arrival"}, RunningDetailProcessor(size), DETAIL_SCHEMA, "id", {"ts": ts})
