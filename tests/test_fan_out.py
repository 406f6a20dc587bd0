"""Many results of one reading (O-E9): rows read once, a failing result alone retried, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from eventflow.sinks.files import WriteAheadSink
from eventflow.sinks.upsert import VersionedKeyedTable
from eventflow.streaming import jobs as SJ
from tests.replay import write_replay_files


@pytest.fixture()
def source(spark, tmp):
    src = spark.range(300).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("k"))
    write_replay_files(src, f"{tmp}/src", "event_id", 3)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return SJ.replay_stream(spark, f"{tmp}/src", src.schema).mapInPandas(counted, src.schema), seen


def results(spark, tmp, broken=lambda batch_id: False):
    sinks = {n: WriteAheadSink(spark, f"{tmp}/{n}") for n in ("even", "odd")}
    table = VersionedKeyedTable(spark, f"{tmp}/keyed", ["k"], ["event_id"], buckets=2)
    calls = []

    def writer(name, write):
        def go(df, batch_id):
            calls.append((name, batch_id))
            if name == "odd" and broken(batch_id):
                raise IOError("sink is down")
            write(df, batch_id)
        return go

    found = [SJ.BatchResult("even", "even ids", lambda d: d.filter("event_id % 2 = 0"), writer("even", sinks["even"].write_batch)),
             SJ.BatchResult("odd", "odd ids", lambda d: d.filter("event_id % 2 = 1"), writer("odd", sinks["odd"].write_batch)),
             SJ.BatchResult("keyed", "the last of each key", lambda d: d, writer("keyed", table.upsert))]
    return found, sinks, table, calls


def check(sinks, table):
    assert sorted(r.event_id for r in sinks["even"].read().collect()) == list(range(0, 300, 2))
    assert sorted(r.event_id for r in sinks["odd"].read().collect()) == list(range(1, 300, 2))
    assert {(r.k, r.event_id) for r in table.read().collect()} == {(i % 7, i) for i in range(293, 300)}


def run(fan, stream, tmp):
    q = fan.start(stream, f"{tmp}/checkpoint")
    q.awaitTermination()
    return q


def test_source_is_read_once_for_all_results(spark, source, tmp):
    stream, seen = source
    found, sinks, table, calls = results(spark, tmp)
    fan = SJ.FanOut(spark, f"{tmp}/commits", found)
    run(fan, stream, tmp)
    check(sinks, table)
    assert seen.value == 300 and len(calls) == 9
    assert [fan.committed(n) for n in ("even", "odd", "keyed")] == [2, 2, 2]


def test_a_failing_result_is_tried_again_alone(spark, source, tmp):
    """It recovers within the batch: nothing is read or written again for the others."""
    stream, seen = source
    tries = {"n": 0}

    def broken(batch_id):
        tries["n"] += batch_id == 1
        return batch_id == 1 and tries["n"] <= 2

    found, sinks, table, calls = results(spark, tmp, broken)
    run(SJ.FanOut(spark, f"{tmp}/commits", found, attempts=3, delay_s=0.01), stream, tmp)
    check(sinks, table)
    assert seen.value == 300
    assert sorted(calls) == sorted([(n, b) for n in ("even", "odd", "keyed") for b in range(3)] + [("odd", 1)] * 2)


def test_a_restart_writes_what_has_no_record(spark, source, tmp):
    stream, _ = source
    flag = f"{tmp}/down"
    open(flag, "w").close()
    found, sinks, table, calls = results(spark, tmp, lambda b: b == 1 and os.path.exists(flag))
    fan = SJ.FanOut(spark, f"{tmp}/commits", found, attempts=2, delay_s=0.01)
    with pytest.raises(Exception):
        run(fan, stream, tmp)
    assert [fan.committed(n) for n in ("even", "odd", "keyed")] == [1, 0, 1]
    os.remove(flag)
    calls.clear()
    run(fan, stream, tmp)
    check(sinks, table)
    assert sorted(calls) == [("even", 2), ("keyed", 2), ("odd", 1), ("odd", 2)]


def test_names_must_differ(spark, tmp):
    same = SJ.BatchResult("x", "", lambda d: d, lambda d, b: None)
    with pytest.raises(ValueError):
        SJ.FanOut(spark, tmp, [same, same])
