"""Keyed state with timers for Structured Streaming (``transformWithStateInPandas``).

Streaming forms of O-P1, O-P2, O-P3, O-P4 and the keyed control streams
O-J2, O-J3 (tagged union, see below). Each processor is a rule over a key's rows in order
(``streaming.ordered``) with a few scalars of state per key (RocksDB state store). With
``reorder`` rows wait in a buffer until the watermark has passed them, and the result is that
of the batch form for any cut into micro-batches and any disorder within the watermark's delay.
Without it, rows of one micro-batch are handled in event-time order, or in the order of a
given arrival column, at once. Keys may be of any type and columns of any name:
``apply_processor`` maps them. Use a watermark on the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventflow.streaming.ordered import OrderedProcessor, flat_key, stamp

ALERT_SCHEMA = "id long, ts timestamp, temperature double, diff double"
RISE_SCHEMA = "id long, alert_ts timestamp"
COUNT_SCHEMA = "id long, cnt long, emit_ts timestamp"


class DeltaAlertProcessor(OrderedProcessor):
    """O-P1 / O-P2: alert when |temperature - last temperature| > threshold.

    ``first_as_zero``: an empty state reads 0.0. ``ttl_ms``: the key's state is
    cleared ``ttl_ms`` after its last reading. ``order``: the column whose order rows of a
    micro-batch are handled in; with an arrival sequence the result does not depend on
    micro-batch boundaries, and with the event time (the default) it does not with ``reorder``."""

    columns = ["id", "ts", "temperature", "diff"]
    state_name, state_schema = "last", "v double, t long"

    def __init__(self, threshold: float, first_as_zero: bool = False, ttl_ms: int | None = None,
                 order: str = "ts", reorder: bool = False, tie: str | None = None):
        super().__init__(reorder, order, tie)
        self.threshold, self.first_as_zero = threshold, first_as_zero
        self.ttl = None if ttl_ms is None else ttl_ms * 1000

    def row(self, state, t, kind, a, out):
        last, last_t = state or (None, None)
        if self.ttl is not None and last_t is not None and t - last_t >= self.ttl:
            last = None                      # cleaned up before this reading
        prev = last if last is not None else (0.0 if self.first_as_zero else None)
        if prev is not None and a is not None and abs(a - prev) > self.threshold:
            out.append((stamp(t), a, abs(a - prev)))
        return [a, t]

    def due(self, state):
        return None if self.ttl is None else state[1] + self.ttl

    def until(self, state, t, out):
        return None


class CountWithTimeoutProcessor(OrderedProcessor):
    """O-P4: count per key; emit (key, count) once ``timeout_ms`` of event
    time pass after the key's last row. The count is not reset."""

    columns = ["id", "cnt", "emit_ts"]
    state_name, state_schema = "cwt", "cnt long, last long, open boolean"

    def __init__(self, timeout_ms: int, reorder: bool = False, tie: str | None = None):
        super().__init__(reorder, tie=tie)
        self.timeout = timeout_ms * 1000

    def row(self, state, t, kind, a, out):
        return [(state[0] if state else 0) + 1, t, True]

    def due(self, state):
        return state[1] + self.timeout if state[2] else None

    def until(self, state, t, out):
        out.append((state[0], stamp(state[1] + self.timeout)))
        return [state[0], state[1], False]


class RiseAlertProcessor(OrderedProcessor):
    """O-P3: a timer ``interval_ms`` after the first rise; a decrease (or the first reading)
    before it cancels; firing emits and disarms, so the next rise re-arms."""

    columns = ["id", "alert_ts"]
    state_name, state_schema = "lastTemp", "v double, timer long"

    def __init__(self, interval_ms: int, reorder: bool = False, tie: str | None = None):
        super().__init__(reorder, tie=tie)
        self.interval = interval_ms * 1000

    def row(self, state, t, kind, a, out):
        prev, timer = state or (0.0, None)
        if timer is not None and t >= timer:  # a row at that very time comes after it
            out.append((stamp(timer),))
            timer = None
        if a is None or prev is None or prev == 0.0 or a < prev:
            timer = None
        elif a > prev and timer is None:
            timer = t + self.interval
        return [a, timer]

    def due(self, state):
        return state[1]

    def until(self, state, t, out):
        out.append((stamp(state[1]),))
        return [state[0], None]


def apply_processor(stream: DataFrame, key: str, processor: StatefulProcessor,
                    schema: str, watermark: str = "0 seconds", ts: str = "ts",
                    value: str = "temperature") -> DataFrame:
    """Key the stream and run ``processor`` with event-time timers. ``key``, ``ts`` and
    ``value`` name the columns that the processors know as id, ts and temperature; the
    output has the input's names, and the key its type."""
    names = {key: "id", ts: "ts", value: "temperature"}
    flat, unflat = flat_key(F.col(key), stream.schema[key].dataType)
    src = stream.select(*[flat.alias("id") if c == key else F.col(c).alias(names.get(c, c)) for c in stream.columns
                          if c in names or c not in names.values()])
    kind = src.schema["id"].dataType.simpleString()
    out = (src.withWatermark("ts", watermark).groupBy("id")
           .transformWithStateInPandas(statefulProcessor=processor,
                                       outputStructType=schema.replace("id long", f"id {kind}", 1),
                                       outputMode="Append", timeMode="EventTime"))
    back = {v: k for k, v in names.items()}
    return out.select(*[unflat(F.col("id")).alias(key) if c == "id" else F.col(c).alias(back.get(c, c))
                        for c in out.columns])


# ------------------------------------------------------ control streams ----
# Keyed control streams (O-J2, O-J3) arrive as one stream: readings and
# control rows unioned with a ``kind`` tag (0 = control, 1 = reading) and keyed
# by id, so control state lives next to the readings of the same key. Rows are
# handled by (ts, kind): controls first on equal time, the same rule as the batch as-of join.

SWITCH_SCHEMA = "id long, ts timestamp, temperature double"
THRESHOLD_ALERT_SCHEMA = "id long, ts timestamp, temperature double, diff double"


def tag_union(readings: DataFrame, controls: DataFrame) -> DataFrame:
    """Union readings (kind 1) and controls (kind 0) by column name."""
    return (readings.withColumn("kind", F.lit(1))
            .unionByName(controls.withColumn("kind", F.lit(0)), allowMissingColumns=True))


class SwitchFilterProcessor(OrderedProcessor):
    """O-J3: a switch (id, ts, dur_ms) forwards the key's readings until
    ts + dur; overlapping switches keep the later deadline, at which the state is cleared."""

    columns = ["id", "ts", "temperature"]
    state_name, state_schema = "deadline", "d long"
    tagged = {0: "dur_ms", 1: "temperature"}

    def __init__(self, reorder: bool = False, tie: str | None = None):
        super().__init__(reorder, tie=tie)

    def row(self, state, t, kind, a, out):
        deadline = state[0] if state else None
        if kind == 0:
            if a is not None and (deadline is None or t + round(a * 1000) > deadline):
                deadline = t + round(a * 1000)
        elif deadline is not None and t < deadline:
            out.append((stamp(t), a))
        return None if deadline is None else [deadline]

    def due(self, state):
        return state[0]

    def until(self, state, t, out):
        return None


class ThresholdAlertProcessor(OrderedProcessor):
    """O-J2: per-key threshold updates (0 deletes) and readings; alert when
    |temperature - last temperature| > threshold in force. An empty last
    temperature reads 0.0; the last temperature moves with every reading."""

    columns = ["id", "ts", "temperature", "diff"]
    state_name, state_schema = "thr", "threshold double, last double"
    tagged = {0: "threshold", 1: "temperature"}

    def __init__(self, reorder: bool = False, tie: str | None = None):
        super().__init__(reorder, tie=tie)

    def row(self, state, t, kind, a, out):
        threshold, last = state or (None, None)
        if kind == 0:
            return [None if a is None or a == 0.0 else a, last]
        if threshold is not None and a is not None:
            diff = abs(a - (last if last is not None else 0.0))
            if diff > threshold:
                out.append((stamp(t), a, diff))
        return [threshold, a]


def read_state(spark, checkpoint: str, state_var: str, operator_id: int = 0) -> DataFrame:
    """O-P5 (queryable state, re-aimed): read a processor's keyed state back
    from the query's checkpoint as a table - (key, value) rows of the
    committed batch."""
    return (spark.read.format("statestore").option("stateVarName", state_var)
            .option("operatorId", operator_id).load(checkpoint))
