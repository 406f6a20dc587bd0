"""Running aggregates on a stream: the keyed state writes what a batch touches and survives replays."""

import os
import random

import pytest

from eventflow.sinks import fs
from eventflow.streaming.running import RunningAggregates

SCHEMA = "i long, k string, v long"
OUTS = [("v", "sum", "total"), ("v", "first", "first"), ("v", "max", "top")]


def want(rows):
    seen, out = {}, []
    for i, k, v in sorted(rows):
        total, first, top = seen.get(k, (0, None, None))
        total, first = total + (v or 0), first if first is not None else v
        top = v if top is None else top if v is None else max(top, v)
        seen[k] = (total, first, top)
        out.append((i, k, total, first, top))
    return out


def got(op):
    return sorted((r.i, r.k, r.total or 0, r.first, r.top) for r in op.read().collect())


@pytest.fixture()
def rows():
    rng = random.Random(8)
    return [(i, rng.choice(("a", "b", "c", None)), rng.choice((None, *range(-4, 9)))) for i in range(90)]


def test_a_replay_reads_the_state_before_its_batch(spark, tmp, rows, monkeypatch):
    """The state is committed, the ledger is not; the batch comes again."""
    op = RunningAggregates(spark, tmp, ["k"], "i", OUTS)
    plain, lost = fs.write_record, {"n": 0}

    def flaky(session, log, seq, text, **kw):
        if log.endswith("_ledger") and seq in (1, 2) and lost["n"] < 2 + seq:
            lost["n"] += 1
            raise IOError("driver died")
        plain(session, log, seq, text, **kw)

    monkeypatch.setattr(fs, "write_record", flaky)
    for b in range(3):
        part = spark.createDataFrame(rows[30 * b:30 * b + 30], SCHEMA)
        while True:
            try:
                op.process(part, b)
                break
            except IOError:
                assert got(op) == want(rows[:30 * b])
    assert lost["n"] == 4 and got(op) == want(rows)
    op.process(spark.createDataFrame(rows[:30], SCHEMA), 1)
    assert got(op) == want(rows)


def test_a_batch_writes_the_state_of_its_keys(spark, tmp):
    op = RunningAggregates(spark, tmp, ["k"], "i", OUTS)
    op.process(spark.createDataFrame([(i, f"k{i}", 1) for i in range(400)], SCHEMA), 0)
    op.process(spark.createDataFrame([(1000, "k3", 5), (1001, "k3", 6)], SCHEMA), 1)
    op.process(spark.createDataFrame([], SCHEMA), 2)
    delta = f"{tmp}/state/delta/{1:012d}"
    assert len([d for d in os.listdir(delta) if d.startswith("_bucket=")]) == 1
    assert [r for r in got(op) if r[0] >= 1000] == [(1000, "k3", 6, 1, 5), (1001, "k3", 12, 1, 6)]
