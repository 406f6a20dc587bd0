"""Keyed processors that see their rows in order: an event-time reorder buffer.

A stream's rows of a key come in any order, cut into micro-batches at any place. An
``OrderedProcessor`` hands them to its rule one by one in the order of (time, kind, tie):

* with ``reorder``, rows wait in list state until the watermark has passed them. A timer at the
  earliest of them releases all that the watermark has reached; later rows are late and dropped
  by Spark. What the rule sees is then the sorted stream, whatever the batches were;
* without it, the rows of each micro-batch are released at its end, in order among themselves.

The rule keeps one small state a key and may ask to be called at a time (``due``): it is told
when the clock has reached it with no row up to there left (``until``).

Rows are taken chunk by chunk. A key's batch or backlog beyond ``CHUNK`` rows is never held at
once: rows go to the state in chunks, and are released ``CHUNK`` at a time in order, one reading
of the state for each. What a release leaves is copied to a second list, and the two
change places.

Equal (time, kind, tie) keep the order in which they came. A null value reaches the rule as None. Rows
without a time come first.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CHUNK = 20_000
ROWS = "o long, t long, kind int, tie long, a double"
END = 1 << 62


def flat_key(key: Column, kind: T.DataType):
    """(key that Python workers can give back, how to get the first again from its column): a
    key of a nested type travels as JSON, any other as it is."""
    if not isinstance(kind, (T.StructType, T.ArrayType)):
        return key, lambda c: c
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    schema = T.StructType([T.StructField("k", kind)])
    return (F.to_json(F.struct(key.alias("k")), options),
            lambda c: F.from_json(c, schema, options).getField("k"))


def micros(ts) -> np.ndarray:
    """Epoch microseconds of a column of times; naive ones are UTC."""
    return pd.to_datetime(pd.Series(ts), utc=True).to_numpy().astype("datetime64[us]").astype(np.int64)


def stamp(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


class OrderedProcessor(StatefulProcessor):
    """``columns`` of the output, ``state_name`` and ``state_schema`` of the rule's state, and the
    names of the input's value (``value``), its time (``ts``), kind (``kind``) and tie columns.
    Rules define ``row``, and ``due`` and ``until`` if they run on time."""

    columns: list = []
    chunk = CHUNK
    state_name, state_schema = "last", "v double"
    tagged: dict = {}  # kind -> value column, where kinds have columns of their own

    def __init__(self, reorder: bool = False, order: str = "ts", tie: str | None = None, value: str = "temperature"):
        if reorder and order != "ts":
            raise ValueError("a reorder buffer follows the event time")
        self.reorder, self.order, self.tie, self.value = reorder, order, tie, value

    # -- the rule -------------------------------------------------------------------------

    def row(self, state: list | None, t: int, kind: int, a: float | None, out: list) -> list | None:
        """The new state after a row at ``t`` microseconds; output rows without the key go to ``out``."""
        raise NotImplementedError

    def due(self, state: list) -> int | None:
        """When the rule wants to be told that nothing has come, in microseconds."""
        return None

    def until(self, state: list, t: int, out: list) -> list | None:
        """The new state when the clock has reached ``t`` and all rows up to it were seen."""
        return state

    # -- state ----------------------------------------------------------------------------

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(self.state_name, self.state_schema)
        self.lists = [handle.getListState(f"rows{i}", ROWS) for i in (0, 1)]
        # Which list is live, how many rows it holds, and the timer that is set.
        self.about = handle.getValueState("about", "live int, held long, earliest long, wake long")

    def _load(self) -> tuple[list | None, list]:
        state = list(self.state.get()) if self.state.exists() else None
        if state is not None:
            state = [None if v is None or v != v else v for v in state]
        return state, list(self.about.get()) if self.about.exists() else [0, 0, END, -1]

    def _save(self, state: list | None, about: list) -> None:
        live, held, earliest, wake = about
        if state is None:
            self.state.clear()
        else:
            self.state.update(tuple(state))
        due = self.due(state) if state is not None else None
        at = min(earliest if held else END, END if due is None else due)
        want = -1 if at == END else -(-at // 1000)  # the first millisecond by which it has passed
        if want != wake:
            if wake >= 0:
                self.handle.deleteTimer(wake)
            if want >= 0:
                self.handle.registerTimer(want)
        if held or want >= 0:
            self.about.update((live, held, earliest, want))
        else:
            self.about.clear()

    # -- rows -----------------------------------------------------------------------------

    def _rows(self, chunk: pd.DataFrame) -> list:
        n = len(chunk)
        t = micros(chunk["ts"]) if "ts" in chunk else np.zeros(n, np.int64)
        o = t if self.order == "ts" else chunk[self.order].to_numpy().astype(np.int64)
        kind = chunk["kind"].to_numpy().astype(np.int64) if "kind" in chunk else np.ones(n, np.int64)
        tie = chunk[self.tie].to_numpy().astype(np.int64) if self.tie else np.zeros(n, np.int64)
        if self.tagged:
            a = np.full(n, np.nan)
            for k, c in self.tagged.items():
                own = kind == k
                a[own] = chunk[c].to_numpy(dtype=np.float64, na_value=np.nan)[own]
        elif self.value in chunk:
            a = chunk[self.value].to_numpy(dtype=np.float64, na_value=np.nan)
        else:
            a = np.full(n, np.nan)
        a = [None if v != v else v for v in a.tolist()]
        return list(zip(o.tolist(), t.tolist(), kind.tolist(), tie.tolist(), a))

    def _run(self, state, rows: list, out: list):
        for _, t, kind, _, a in rows:
            due = self.due(state) if state is not None else None
            if due is not None and due < t:  # the clock passed it before this row
                state = self.until(state, due, out)
            state = self.row(state, t, kind, a, out)
        return state

    def _frame(self, key, out: list) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *r) for r in out], columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, about = self._load()
        fresh: list = []
        for chunk in rows:
            fresh += self._rows(chunk)
            if len(fresh) >= self.chunk:
                about = self._keep(fresh, about)
                fresh = []
        out: list = []
        if self.reorder:
            if fresh:
                about = self._keep(fresh, about)
        elif not about[1]:
            state = self._run(state, sorted(fresh, key=lambda r: (r[0], r[2], r[3])), out)
        else:
            about = self._keep(fresh, about)
            state, about = yield from self._release(key, state, about, END)
        self._save(state, about)
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, about = self._load()
        about[3] = -1 if about[3] == expiredTimerInfo.getExpiryTimeInMs() else about[3]
        # With a reorder buffer every row up to the watermark is here; without one, a timer is the clock.
        now = (timerValues.getCurrentWatermarkInMs() if self.reorder else expiredTimerInfo.getExpiryTimeInMs()) * 1000
        if about[1] and about[2] <= now:
            state, about = yield from self._release(key, state, about, now)
        out: list = []
        due = self.due(state) if state is not None else None
        while due is not None and due <= now:
            state = self.until(state, due, out)
            due = self.due(state) if state is not None else None
        self._save(state, about)
        yield self._frame(key, out)

    def _keep(self, rows: list, about: list) -> list:
        live, held, earliest, wake = about
        if rows:
            self.lists[live].appendList(rows)
            earliest = min(earliest, min(r[1] for r in rows))
        return [live, held + len(rows), earliest, wake]

    def _release(self, key, state, about: list, now: int):
        """Runs the rule over the kept rows up to ``now``, and keeps the others; yields output."""
        live, held, _, wake = about
        after, left, earliest, first = None, 0, END, True
        while True:
            best: list = []  # the next CHUNK rows in order
            later: list = []
            for seq, r in enumerate(self.lists[live].get()):
                o, t, kind, tie, a = r
                if t > now:
                    if first:
                        later.append(tuple(r))
                        left, earliest = left + 1, min(earliest, t)
                        if len(later) >= self.chunk:
                            self.lists[1 - live].appendList(later)
                            later = []
                    continue
                place = (o, kind, tie, seq)
                if after is None or place > after:
                    best.append((place, (o, t, kind, tie, None if a is None or a != a else a)))
                    if len(best) >= 2 * self.chunk:
                        best = sorted(best)[:self.chunk]
            if later:
                self.lists[1 - live].appendList(later)
            first = False
            best = sorted(best)[:self.chunk]
            out: list = []
            state = self._run(state, [r for _, r in best], out)
            if out:
                yield self._frame(key, out)
            if len(best) < self.chunk:
                break
            after = best[-1][0]
        self.lists[live].clear()
        return state, [1 - live, left, earliest, wake]

    def close(self) -> None:
        pass
