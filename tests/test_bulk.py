"""The bulk document sink: bulk size, retries, aborts, and streams that restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventflow.sinks.bulk import BulkDocuments, FolderClient
from eventflow.sinks.files import to_json_documents


@pytest.fixture(autouse=True)
def registered(spark):
    spark.dataSource.register(BulkDocuments)


def docs(spark, n=1050, parts=3):
    return to_json_documents(spark.range(0, n, 1, parts).withColumn("v", F.col("id") * 2))


def send(df, root, **options):
    w = df.write.format("bulk_documents").option("url", str(root)).option("index", "events").option("type", "event")
    for k, v in options.items():
        w = w.option(k, v)
    w.mode("append").save()


def visible(root):
    """{folder: {file: number of documents}} of what is not hidden."""
    base = f"{root}/events/event"
    return {d: {f: sum(1 for _ in open(f"{base}/{d}/{f}")) for f in os.listdir(f"{base}/{d}")}
            for d in os.listdir(base) if not d.startswith("_")} if os.path.isdir(base) else {}


def staged(root):
    return [f for _, _, files in os.walk(f"{root}/events/event/_staging") for f in files]


def test_bulk_size_and_receipts(spark, tmp_path):
    send(docs(spark), tmp_path, bulk_size=100)
    (write, files), = visible(tmp_path).items()
    assert max(files.values()) == 100 and len(files) == 3 * 4 and sum(files.values()) == 1050 and not staged(tmp_path)
    record = json.load(open(f"{tmp_path}/events/event/_commits/{write}.json"))
    assert record["documents"] == 1050 and sorted(record["bulks"]) == sorted(files)
    back = spark.read.json(f"{tmp_path}/events/event/{write}")
    assert {(r.id, r.v) for r in back.collect()} == {(i, 2 * i) for i in range(1050)}
    send(docs(spark, 30), tmp_path, bulk_size=1000)
    assert sum(sum(f.values()) for f in visible(tmp_path).values()) == 1080


def test_a_failing_bulk_is_sent_again(spark, tmp_path):
    send(docs(spark, 90, 1), tmp_path, bulk_size=30, client="tests.bulk_clients:Flaky", log=f"{tmp_path}/log", fails=3,
         attempts=4, backoff_ms=1)
    (files,) = visible(tmp_path).values()
    assert sorted(files.values()) == [30, 30, 30]
    assert len(open(f"{tmp_path}/log").readlines()) == 3 + 3


@pytest.mark.parametrize("parts", [1, 4])
def test_a_bulk_that_never_succeeds_aborts_the_write(spark, tmp_path, parts):
    """Nothing is published, and the bulks sent before are taken back."""
    with pytest.raises(Exception):
        send(docs(spark, 400, parts), tmp_path, bulk_size=20, client="tests.bulk_clients:Flaky", log=f"{tmp_path}/log",
             fails=1000, attempts=2, backoff_ms=1, poison='{"id":390,"v":780}')
    assert visible(tmp_path) == {} and (parts > 1 or staged(tmp_path) == [])
    assert len(open(f"{tmp_path}/log").readlines()) == 2
    FolderClient({"url": str(tmp_path), "index": "events", "type": "event"}).discard_staged()
    assert staged(tmp_path) == []


def test_nulls_and_empty_tables(spark, tmp_path):
    send(spark.createDataFrame([("{}",), (None,)], "doc string").coalesce(1), tmp_path)
    (files,) = visible(tmp_path).values()
    assert list(files.values()) == [2]
    send(spark.createDataFrame([], "doc string"), tmp_path / "none")
    assert [f for d in visible(tmp_path / "none").values() for f in d] == []


@pytest.mark.parametrize("bad", ["two", "mode", "size"])
def test_what_is_refused(spark, tmp_path, bad):
    df = docs(spark, 5)
    with pytest.raises(Exception):
        if bad == "two":
            send(df.withColumn("x", F.lit("y")), tmp_path)
        elif bad == "size":
            send(df, tmp_path, bulk_size=0)
        else:
            df.write.format("bulk_documents").option("url", str(tmp_path)).mode("overwrite").save()
    assert visible(tmp_path) == {}


def test_stream_restarts_after_a_lost_commit(spark, tmp_path):
    """The driver fails in the middle of publishing the second batch; the restarted query
    publishes each batch once."""
    for i in range(3):
        docs(spark, 50, 2).withColumn("doc", F.concat(F.lit(f'{{"b":{i},"d":'), "doc", F.lit("}"))).write.parquet(
            f"{tmp_path}/in/{i}")

    def start(client):
        rows = (spark.readStream.schema("doc string").option("maxFilesPerTrigger", 2).option("recursiveFileLookup", "true")
                .parquet(f"{tmp_path}/in"))
        w = rows.writeStream.format("bulk_documents").option("checkpointLocation", f"{tmp_path}/ck")
        for k, v in {"url": f"{tmp_path}/out", "index": "events", "type": "event", "bulk_size": 20, "client": client,
                     "log": f"{tmp_path}/log"}.items():
            w = w.option(k, str(v))
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q

    with pytest.raises(Exception):
        start("tests.bulk_clients:FailingCommit")
    start("tests.bulk_clients:FailingCommit")
    got = visible(f"{tmp_path}/out")
    assert sorted(got) == ["batch=0", "batch=1", "batch=2"]
    lines = [json.loads(x) for b, fs in got.items() for f in fs for x in open(f"{tmp_path}/out/events/event/{b}/{f}")]
    assert sorted((x["b"], x["d"]["id"]) for x in lines) == [(b, i) for b in range(3) for i in range(50)]
    client = FolderClient({"url": f"{tmp_path}/out", "index": "events", "type": "event"})
    client.discard_staged()
    assert staged(f"{tmp_path}/out") == []
