"""The log-structured keyed table: what a batch writes, compaction, removal, replays, lookups."""

import os
import random

import pytest

from eventflow.sinks.upsert import VersionedKeyedTable

SCHEMA = "k string, at long, v long"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(root, kind="delta"):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(f"{root}/{kind}") for f in names
            if f.endswith(".parquet")}


def rows(df):
    return sorted(((r.k, r.at, r.v) for r in df.collect()), key=repr)


def test_a_batch_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at"], buckets=32)
    table.upsert(batch(spark, [(f"k{i}", 1, i) for i in range(500)]), 0)
    first = files(tmp_path)
    assert len(first) == 32
    table.upsert(batch(spark, [(f"k{i}", 2, -i) for i in (3, 4, 5)] * 4), 1)
    new = files(tmp_path) - first
    assert 1 <= len(new) <= 3 and first <= files(tmp_path)
    assert rows(table.read()) == sorted(((f"k{i}", 2, -i) if i in (3, 4, 5) else (f"k{i}", 1, i) for i in range(500)), key=repr)


def test_compaction_and_removal(spark, tmp_path):
    """One busy key: its bucket alone is compacted, and its old files go after a few versions."""
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at"], buckets=8, max_deltas=2, keep_versions=2)
    table.upsert(batch(spark, [(f"k{i}", 0, i) for i in range(100)]), 0)
    for b in range(1, 12):
        table.upsert(batch(spark, [("k7", b, b)]), b)
        want = [("k7", b, b) if i == 7 else (f"k{i}", 0, i) for i in range(100)]
        assert rows(table.read()) == sorted(want, key=repr)
    live = table._version()["live"]
    busy = [b for b, folders in live.items() if folders != [f"delta/{0:012d}/_bucket={b}"]]
    assert len(busy) == 1 and len(live[busy[0]]) <= 3 and live[busy[0]][0].startswith("base/")
    assert len(files(tmp_path, "base")) <= 2 and len(files(tmp_path)) <= 7 + 2 + 2 * 3
    assert len([f for f in os.listdir(f"{tmp_path}/_versions") if f.endswith(".json") and f[0] != "."]) <= 2


def test_a_reader_of_the_last_version_is_not_disturbed(spark, tmp_path):
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at"], buckets=2, max_deltas=1, keep_versions=3)
    table.upsert(batch(spark, [("a", 0, 0), ("b", 0, 0)]), 0)
    reader = table.read()
    for b in (1, 2):
        table.upsert(batch(spark, [("a", b, b)]), b)
    assert rows(reader) == [("a", 0, 0), ("b", 0, 0)] and rows(table.read()) == [("a", 2, 2), ("b", 0, 0)]


def test_replays_late_rows_ties_and_null_keys(spark, tmp_path):
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at", "v"], buckets=4)
    assert table.read() is None and table.lookup(batch(spark, [])) is None
    table.upsert(batch(spark, [("a", 5, 1), ("a", 5, 2), (None, 1, 1)]), 0)
    table.upsert(batch(spark, [("a", 4, 9), (None, 2, 2)]), 1)  # an older row of "a" comes late
    table.upsert(batch(spark, [("a", 99, 99)]), 1)  # a replay under a known id
    assert rows(table.read()) == sorted([("a", 5, 2), (None, 2, 2)], key=repr)
    table.upsert(batch(spark, []), 2)
    assert rows(table.read()) == sorted([("a", 5, 2), (None, 2, 2)], key=repr)


def test_a_batch_that_died_before_its_record_is_not_seen(spark, tmp_path, monkeypatch):
    from eventflow.sinks import fs
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at"], buckets=4, max_deltas=1)
    table.upsert(batch(spark, [("a", 0, 0)]), 0)
    plain = fs.write_record
    monkeypatch.setattr(fs, "write_record", lambda *a, **b: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        table.upsert(batch(spark, [("a", 1, 1), ("b", 1, 1)]), 1)
    assert rows(table.read()) == [("a", 0, 0)]
    monkeypatch.setattr(fs, "write_record", plain)
    table.upsert(batch(spark, [("a", 1, 1), ("b", 1, 1)]), 1)
    assert rows(table.read()) == [("a", 1, 1), ("b", 1, 1)]


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    table = VersionedKeyedTable(spark, str(tmp_path), ["k"], ["at"], buckets=32)
    table.upsert(batch(spark, [(f"k{i}", 1, i) for i in range(300)] + [(None, 1, -1)]), 0)
    table.upsert(batch(spark, [("k5", 2, 0)]), 1)
    keys = spark.createDataFrame([("k5",), ("k6",), (None,), ("none",)], "k string")
    got = table.lookup(keys)
    assert rows(got) == sorted([("k5", 2, 0), ("k6", 1, 6), (None, 1, -1)], key=repr)
    assert len(got.inputFiles()) <= 5


def test_any_cut_into_batches_gives_the_same_table(spark, tmp_path):
    rng = random.Random(4)
    data = [(f"k{rng.randrange(20)}", i, rng.randrange(100)) for i in range(200)]
    rng.shuffle(data)
    want = {}
    for k, at, v in data:
        want[k] = max(want.get(k, (-1, 0)), (at, v))
    for n, size in enumerate((200, 61, 17)):
        table = VersionedKeyedTable(spark, f"{tmp_path}/{n}", ["k"], ["at"], buckets=4, max_deltas=3)
        for b, i in enumerate(range(0, 200, size)):
            table.upsert(batch(spark, data[i:i + size]), b)
        assert rows(table.read()) == sorted(((k, *w) for k, w in want.items()), key=repr)
