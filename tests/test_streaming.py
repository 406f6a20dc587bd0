"""Streaming forms: batch/stream equality on a file-stream replay of
``events`` and failure/restart behaviour of the sinks."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventflow.operators import keyed as K
from eventflow.plans.common import sensors
from eventflow.sinks.files import WriteAheadSink
from eventflow.sinks.upsert import VersionedKeyedTable, latest_per_key
from eventflow.sources.files import kafka_options
from eventflow.sources.tables import events, out_of_order
from eventflow.streaming import jobs as SJ
from eventflow.streaming.late import LateSplitter
from eventflow.streaming.processors import (ALERT_SCHEMA, COUNT_SCHEMA, CountWithTimeoutProcessor,
                                            DeltaAlertProcessor, apply_processor)
from tests.replay import write_replay_files
from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    """sf0.001 sensor readings replayed as 3 parquet files (arrival order)."""
    path = str(tmp_path_factory.mktemp("replay"))
    ev = out_of_order(events(spark, SF_SMALL))
    d = sensors(ev).join(ev.select("event_id", "ts2"), "event_id").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    write_replay_files(d, path, "event_id", 3)
    return path, d.schema


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_delta_alert_stream_equals_batch(spark, replay, tmp):
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts", "temperature")
    out = apply_processor(stream, "id", DeltaAlertProcessor(50.0), ALERT_SCHEMA)
    q = (out.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, r.ts.replace(tzinfo=None), round(r.diff, 6))
                 for r in spark.read.parquet(f"{tmp}/out").collect())
    batch = K.delta_alert(sensors(events(spark, SF_SMALL)), "id", "ts", "temperature", 50.0)
    want = sorted((r.id, r.ts, round(r.diff, 6)) for r in batch.collect())
    assert got == want and len(got) > 0


def test_count_timeout_stream_fires_closed_keys(spark, replay, tmp):
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts")
    out = apply_processor(stream, "id", CountWithTimeoutProcessor(12 * 3600 * 1000), COUNT_SCHEMA)
    q = (out.writeStream.format("memory").queryName("cwt").outputMode("append")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    def ms(t):  # timers run on epoch milliseconds
        return pd.Timestamp(t).replace(tzinfo=None).floor("ms")
    got = sorted((r.id, r.cnt, ms(r.emit_ts)) for r in spark.sql("select * from cwt").collect())
    batch = K.count_with_timeout(sensors(events(spark, SF_SMALL)), "id", "ts", "12 hours")
    last = events(spark, SF_SMALL).agg(F.max("ts")).first()[0]
    want = sorted((r.id, r.cnt, ms(r.emit_ts)) for r in batch.collect() if r.emit_ts <= last)
    assert len(got) > 0
    assert got == want


def test_late_split_stream_equals_batch(spark, replay, tmp):
    path, schema = replay
    splitter = LateSplitter(spark, f"{tmp}/late", "ts2", "event_id", "5 hours")
    stream = SJ.replay_stream(spark, path, schema)
    q = (stream.writeStream.foreachBatch(splitter.process)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    late = sorted(r.event_id for r in splitter.read("late").collect())
    main = splitter.read("main").count()
    from __spark_entry__ import queries
    b = queries()["m6_late_split"](spark, SF_SMALL)
    want = sorted(r.event_id for r in b.filter("output = 'late'").collect())
    assert late == want and main + len(late) == 1000
    # a replayed batch id is a no-op
    before = splitter.read("late").count()
    splitter.process(spark.read.option("recursiveFileLookup", "true").parquet(path), 0)
    assert splitter.read("late").count() == before


def test_exactly_once_file_sink_survives_failure(spark, replay, tmp):
    path, schema = replay
    flag = os.path.join(tmp, "fail-once")
    open(flag, "w").close()

    @F.udf("long")
    def maybe_fail(x):
        if x == 700 and os.path.exists(flag):
            raise RuntimeError("injected failure")
        return x

    def start():
        s = SJ.replay_stream(spark, path, schema).withColumn("event_id", maybe_fail("event_id"))
        return SJ.exactly_once_file_sink(s, f"{tmp}/table", f"{tmp}/ck")

    q = start()
    with pytest.raises(Exception):
        q.awaitTermination()
    os.remove(flag)
    _run(start())
    ids = [r.event_id for r in spark.read.parquet(f"{tmp}/table").collect()]
    assert len(ids) == 1000 and len(set(ids)) == 1000


def test_write_ahead_sink_replay_once(spark, tmp):
    sink = WriteAheadSink(spark, f"{tmp}/wal")
    df = spark.range(10)
    assert sink.write_batch(df, 0) is True
    assert sink.write_batch(df, 0) is False      # replayed checkpoint: skipped
    assert sink.write_batch(spark.range(10, 15), 1) is True
    assert sink.read().count() == 15


def test_upsert_stream_keeps_last_write(spark, replay, tmp):
    path, schema = replay
    table = VersionedKeyedTable(spark, f"{tmp}/kv", ["id"], ["ts", "event_id"])
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts", "event_id", "temperature")
    q = (stream.writeStream.foreachBatch(table.foreach_batch())
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, r.temperature) for r in table.read().collect())
    latest = latest_per_key(sensors(events(spark, SF_SMALL)).select(
        "id", "ts", "event_id", "temperature"), ["id"], ["ts", "event_id"])
    assert got == sorted((r.id, r.temperature) for r in latest.collect())


def test_fan_out_with_restart(spark, replay, tmp):
    path, schema = replay
    attempts = {"n": 0}

    def sink(name):
        def start(df, ck):
            return (df.writeStream.format("parquet").option("path", f"{tmp}/{name}")
                    .option("checkpointLocation", ck).trigger(availableNow=True).start())
        return start

    results = [
        SJ.NamedResult("hot", "readings above 100", lambda d: d.filter("temperature > 100"),
                       sink("hot")),
        SJ.NamedResult("cold", "readings below 32", lambda d: d.filter("temperature < 32"),
                       sink("cold")),
    ]

    def start():
        attempts["n"] += 1
        if attempts["n"] == 1:
            raise RuntimeError("broker unavailable")
        qs = SJ.start_results(SJ.replay_stream(spark, path, schema), results, f"{tmp}/ck")
        for q in qs.values():
            q.awaitTermination()
        return qs["hot"]

    SJ.run_with_restarts(start, attempts=3, delay_s=0.1)
    ev = sensors(events(spark, SF_SMALL))
    assert spark.read.parquet(f"{tmp}/hot").count() == ev.filter("temperature > 100").count()
    assert spark.read.parquet(f"{tmp}/cold").count() == ev.filter("temperature < 32").count()


def test_kafka_options():
    o = kafka_options("h:9092", "t", "latest", "g1")
    assert o["startingOffsets"] == "latest" and o["subscribe"] == "t" and o["kafka.group.id"] == "g1"
    assert kafka_options("h:9092", "t", "group")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_options("h", "t", "nowhere")


def test_switch_filter_stream_equals_batch(spark, tmp):
    from eventflow.streaming.processors import SWITCH_SCHEMA, SwitchFilterProcessor, tag_union
    from __spark_entry__ import queries
    ev = events(spark, SF_SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{tmp}/src"
    src = ev.select("event_id", F.col("user_id").alias("id"), "ts", "event_type",
                    F.col("value").alias("temperature"))
    write_replay_files(src, path, "event_id", 3)
    s = SJ.replay_stream(spark, path, src.schema)
    readings = s.filter("event_type = 'purchase'").select("id", "ts", "temperature")
    switches = s.filter("event_type = 'signup'").select(
        "id", "ts", F.round(F.col("temperature") * 3.6e6).cast("long").alias("dur_ms"))
    u = tag_union(readings, switches)
    out = apply_processor(u, "id", SwitchFilterProcessor(), SWITCH_SCHEMA)
    q = (out.writeStream.format("memory").queryName("sw").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, r.ts.replace(tzinfo=None)) for r in spark.sql("select * from sw").collect())
    want = sorted((r.id, r.ts) for r in queries()["j3_interval_forward"](spark, SF_SMALL).collect())
    assert got == want and len(got) > 0


def test_threshold_alert_stream_equals_batch(spark, tmp):
    from eventflow.streaming.processors import (THRESHOLD_ALERT_SCHEMA, ThresholdAlertProcessor,
                                                tag_union)
    from __spark_entry__ import queries
    ev = events(spark, SF_SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{tmp}/src"
    src = ev.select("event_id", F.col("user_id").alias("id"), "ts", "event_type",
                    F.col("value").alias("temperature"))
    write_replay_files(src, path, "event_id", 3)
    s = SJ.replay_stream(spark, path, src.schema)
    readings = s.filter("event_type <> 'signup'").select("id", "ts", "temperature")
    thr = s.filter("event_type = 'signup'").select(
        "id", "ts", F.when(F.pmod("event_id", F.lit(4)) == 0, F.lit(0.0))
        .otherwise(F.col("temperature")).alias("threshold"))
    out = apply_processor(tag_union(readings, thr), "id", ThresholdAlertProcessor(),
                          THRESHOLD_ALERT_SCHEMA)
    q = (out.writeStream.format("memory").queryName("thr").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, r.ts.replace(tzinfo=None), round(r.diff, 6))
                 for r in spark.sql("select * from thr").collect())
    want = sorted((r.id, r.ts, r.diff) for r in queries()["j2_threshold_alert"](spark, SF_SMALL).collect())
    assert got == want and len(got) > 0


def test_rise_alert_stream_equals_batch_before_final_watermark(spark, replay, tmp):
    from eventflow.streaming.processors import RISE_SCHEMA, RiseAlertProcessor
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts", "temperature")
    out = apply_processor(stream, "id", RiseAlertProcessor(6 * 3600 * 1000), RISE_SCHEMA)
    q = (out.writeStream.format("memory").queryName("rise").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, pd.Timestamp(r.alert_ts).floor("ms")) for r in spark.sql("select * from rise").collect())
    last = events(spark, SF_SMALL).agg(F.max("ts")).first()[0]
    batch = K.rise_alerts(sensors(events(spark, SF_SMALL)), "id", "ts", "temperature", "6 hours")
    want = sorted((r.id, pd.Timestamp(r.alert_ts).floor("ms")) for r in batch.collect()
                  if r.alert_ts <= last)
    assert got == want and len(got) > 0


def test_hot_items_stream_equals_batch_on_closed_windows(spark, tmp):
    from eventflow.plans.windowed import e2_hot_items
    ev = events(spark, SF_SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{tmp}/src"
    write_replay_files(ev, path, "event_id", 3)
    s = SJ.replay_stream(spark, path, ev.schema)
    from eventflow.sources.tables import item_id
    views = (s.filter("event_type = 'view'").select("ts", item_id().alias("item_id"))
             .withWatermark("ts", "0 seconds"))
    w = F.window("ts", "1 day", "6 hours")
    counts = (views.groupBy(w.alias("w"), "item_id").agg(F.count(F.lit(1)).alias("view_count"))
              .select(F.col("w.end").alias("window_end"), "item_id", "view_count"))
    collected = []

    def sink(df, batch_id):
        collected.extend(tuple(r) for r in df.select("window_end", "item_id", "view_count", "rank").collect())

    fn = SJ.top_n_per_batch(3, ["window_end"], [F.desc("view_count"), F.asc("item_id")], sink)
    q = (counts.writeStream.outputMode("append").foreachBatch(fn)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    last = ev.agg(F.max("ts")).first()[0]
    got = sorted((pd.Timestamp(a).tz_localize(None) if pd.Timestamp(a).tzinfo else pd.Timestamp(a), b, c, d)
                 for a, b, c, d in collected)
    want = sorted((pd.Timestamp(r.window_end), r.item_id, r.view_count, r.rank)
                  for r in e2_hot_items(spark, SF_SMALL).collect()
                  if pd.Timestamp(r.window_end) <= pd.Timestamp(last))
    assert got == want and len(got) > 0


def test_early_firing_stream_equals_batch(spark, tmp):
    """Every (key, window, tick) up to the last watermark, over batches whose first has
    no watermark and whose rows are out of order inside the delay."""
    from eventflow.operators.windows import early_firing_counts
    from eventflow.streaming.windows import early_firing
    base = pd.Timestamp("2024-03-01", tz="UTC")
    secs = [7, 3, 12, 14, 11, 26, 23, 31, 44, 38, 41, 58, 62, 61, 95, 100, 130]
    rows = [(i, i % 2, base + pd.Timedelta(seconds=s)) for i, s in enumerate(secs)]
    src = spark.createDataFrame(pd.DataFrame(rows, columns=["event_id", "id", "ts"]))
    write_replay_files(src, f"{tmp}/src", "event_id", 4)
    stream = SJ.replay_stream(spark, f"{tmp}/src", src.schema).select("id", "ts")
    out = early_firing(stream, "id", "ts", "20 seconds", "5 seconds", "10 seconds")
    q = (out.writeStream.format("memory").queryName("early").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = spark.sql("select * from early").toPandas()
    batch = early_firing_counts(src, ["id"], "ts", "20 seconds", "5 seconds").toPandas()

    def rows_of(pdf, upto=None):
        f = [(int(r.id), pd.Timestamp(r.window_end).tz_localize(None), pd.Timestamp(r.eval_time).tz_localize(None),
              int(r.cnt)) for r in pdf.itertuples()]
        return sorted(r for r in f if upto is None or r[2] <= upto)
    # The last watermark is the greatest time less the delay.
    last = base.tz_localize(None) + pd.Timedelta(seconds=120)
    want = rows_of(batch, last)
    assert len(want) > 15 and rows_of(got) == want


def test_allowed_lateness_stream_runs_in_update_mode(spark, replay, tmp):
    from eventflow.streaming.windows import allowed_lateness_count
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", F.col("ts2").cast("timestamp").alias("ts2"))
    out = allowed_lateness_count(stream, ["id"], "ts2", "1 hour", "1 hour", "2 hours")
    q = (out.writeStream.format("memory").queryName("lat").outputMode("update")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    got = spark.sql("select * from lat").toPandas()
    assert len(got) > 0
    final = got.groupby(["id", "window_end"]).cnt.max()
    # every row of the replay is counted once at most
    assert final.sum() <= 1000


def test_json_document_sink_stream(spark, replay, tmp):
    from eventflow.sinks.files import JsonDocumentSink, to_json_documents, with_retries
    path, schema = replay
    sink = JsonDocumentSink(f"{tmp}/docs", "event_data", "event", max_docs_per_file=100)
    stream = SJ.replay_stream(spark, path, schema)
    docs = to_json_documents(stream.select("id", "temperature"))
    q = (docs.writeStream.foreachBatch(sink.foreach_batch())
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    back = spark.read.json(f"{tmp}/docs/event_data/event")
    assert back.count() == 1000
    assert set(back.columns) >= {"id", "temperature"}
    files = [f for f in os.listdir(f"{tmp}/docs/event_data/event/batch=0") if f.endswith(".txt")]
    assert len(files) >= 3    # bulk size caps documents per file
    calls = {"n": 0}

    def flaky():
        calls["n"] += 1
        if calls["n"] < 3:
            raise IOError("bulk rejected")
        return "ok"
    assert with_retries(flaky, attempts=5, backoff_s=0.01) == "ok" and calls["n"] == 3


def test_self_cleaning_alert_stream_equals_batch(spark, replay, tmp):
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts", "temperature")
    proc = DeltaAlertProcessor(50.0, first_as_zero=True, ttl_ms=24 * 3600 * 1000)
    out = apply_processor(stream, "id", proc, ALERT_SCHEMA)
    q = (out.writeStream.format("memory").queryName("p2s").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, r.ts.replace(tzinfo=None), round(r.diff, 6))
                 for r in spark.sql("select * from p2s").collect())
    batch = K.self_cleaning_delta_alert(sensors(events(spark, SF_SMALL)), "id", "ts",
                                        "temperature", 50.0, "1 day")
    want = sorted((r.id, r.ts, round(r.diff, 6)) for r in batch.collect())
    assert got == want and len(got) > 0


@pytest.mark.parametrize("sink_kind", ["upsert", "write_ahead"])
def test_sinks_survive_failure_after_write(spark, replay, tmp, sink_kind):
    """Fail right after a batch was written (before Spark commits the batch),
    restart on the same checkpoint: the replayed batch must not duplicate or
    change the result."""
    path, schema = replay
    if sink_kind == "upsert":
        table = VersionedKeyedTable(spark, f"{tmp}/kv", ["id"], ["ts", "event_id"])
        write = table.foreach_batch()
    else:
        wal = WriteAheadSink(spark, f"{tmp}/wal")
        write = wal.foreach_batch()
    failed = {"done": False}

    def fn(df, batch_id):
        write(df, batch_id)
        if batch_id == 1 and not failed["done"]:
            failed["done"] = True
            raise RuntimeError("crash after write, before commit")

    def start():
        s = SJ.replay_stream(spark, path, schema).select("id", "ts", "event_id", "temperature")
        return (s.writeStream.foreachBatch(fn).option("checkpointLocation", f"{tmp}/ck")
                .trigger(availableNow=True).start())

    q = start()
    with pytest.raises(Exception):
        q.awaitTermination()
    _run(start())
    if sink_kind == "upsert":
        got = sorted((r.id, r.temperature) for r in table.read().collect())
        latest = latest_per_key(sensors(events(spark, SF_SMALL)).select(
            "id", "ts", "event_id", "temperature"), ["id"], ["ts", "event_id"])
        assert got == sorted((r.id, r.temperature) for r in latest.collect())
    else:
        ids = [r.event_id for r in wal.read().collect()]
        assert len(ids) == 1000 and len(set(ids)) == 1000


def test_allowed_lateness_exact_stream_equals_batch(spark, replay, tmp):
    from eventflow.operators import eventtime as T
    from eventflow.streaming.lateness import LatenessWindowCounter
    path, schema = replay
    counter = LatenessWindowCounter(spark, f"{tmp}/lat", ["id"], "ts2", "event_id", "1 hour",
                                    "1 hour", "2 hours")
    stream = SJ.replay_stream(spark, path, schema)
    q = (stream.writeStream.foreachBatch(counter.process)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.id, pd.Timestamp(r.window_end), r.cnt, r.kind) for r in counter.read().collect())
    base = out_of_order(events(spark, SF_SMALL)).withColumnRenamed("user_id", "id")
    d = T.with_watermark_column(base, "ts2", "event_id", "1 hour", "wm")
    batch = T.allowed_lateness_counts(d, ["id"], "ts2", "1 hour", "2 hours", "event_id").toPandas()
    wm = counter.watermark_us()
    # late rows only exist for windows the watermark has passed, so the stream
    # equals the bounded result on every window its final watermark passed
    want = sorted((r.id, pd.Timestamp(r.window_end), r.cnt, r.kind) for r in batch.itertuples()
                  if pd.Timestamp(r.window_end).value // 1000 - 1000 <= wm)
    assert got == want and any(k == "update" for *_, k in got)
    # replaying a batch id is a no-op
    before = counter.read().count()
    counter.process(spark.read.option("recursiveFileLookup", "true").parquet(path), 0)
    assert counter.read().count() == before


def test_read_keyed_state_back(spark, replay, tmp):
    from eventflow.streaming.processors import read_state
    path, schema = replay
    stream = SJ.replay_stream(spark, path, schema).select("id", "ts", "temperature")
    out = apply_processor(stream, "id", DeltaAlertProcessor(50.0), ALERT_SCHEMA)
    q = (out.writeStream.format("noop").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    st = read_state(spark, f"{tmp}/ck", "last").toPandas()
    got = {int(r.key["id"]): float(r.value["v"]) for r in st.itertuples()}
    latest = latest_per_key(sensors(events(spark, SF_SMALL)).select("id", "ts", "temperature"),
                            ["id"], ["ts"])
    assert got == {r.id: r.temperature for r in latest.collect()}


def test_text_stream_word_counts(spark, tmp):
    from eventflow.functions import tokens as TK
    from eventflow.plans.common import table
    from eventflow.streaming.windows import text_word_counts
    conv = table(spark, SF_SMALL, "conversations").select("conv_id", "text")
    for i in range(3):
        conv.filter(F.pmod("conv_id", F.lit(3)) == i).select("text").write.text(f"{tmp}/text/part{i}")
    lines = (spark.readStream.option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
             .text(f"{tmp}/text"))
    out = text_word_counts(lines, TK.stopword_tokens, "1 hour")
    q = (out.writeStream.outputMode("update").format("memory").queryName("wc")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    _run(q)
    got = spark.sql("select word, window_end, max(cnt) as cnt from wc group by word, window_end")
    got = {r.word: r.cnt for r in got.groupBy("word").agg(F.sum("cnt").alias("cnt")).collect()}
    lines_b = conv.select(F.explode(F.split("text", "\\n")).alias("value"))
    want = {r.word: r["count"] for r in TK.stopword_tokens(lines_b, "value").groupBy("word").count().collect()}
    assert got == want and len(got) > 0


def test_decode_json_records_from_a_kafka_shaped_stream(spark, tmp):
    """O-S5/O-S6: (key, value, timestamp) records, as a Kafka source yields
    them, replayed from files and decoded on the stream."""
    from eventflow.plans.common import event_json
    from eventflow.sources.decode import decode_event
    from __spark_entry__ import queries
    raw = event_json(events(spark, SF_SMALL)).select(
        F.col("event_id").cast("string").alias("key"), F.col("raw").alias("value"),
        F.current_timestamp().alias("timestamp"), "event_id")
    write_replay_files(raw, f"{tmp}/kafka", "event_id", 3)
    s = SJ.replay_stream(spark, f"{tmp}/kafka", raw.schema)
    out = decode_event(s.withColumn("event_id", F.col("key").cast("long")), "value",
                       keep=("event_id",))
    q = (out.writeStream.format("memory").queryName("kdec").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    _run(q)
    got = sorted(tuple(r) for r in spark.sql("select event_id, id, name, tm from kdec").collect())
    want = sorted(tuple(r) for r in queries()["s6_decode_event"](spark, SF_SMALL)
                  .select("event_id", "id", "name", "tm").collect())
    assert got == want and len(got) == 1000


def test_global_window_average_into_exactly_once_sink(spark, replay, tmp):
    """O-E14 stream form: watermark -> global 1 day window average -> ISO end
    -> exactly-once file sink; equal to the batch job on closed windows."""
    from eventflow.functions.scalar import iso_local
    from __spark_entry__ import queries
    path, schema = replay
    s = SJ.replay_stream(spark, path, schema).withWatermark("ts", "0 seconds")
    w = F.window("ts", "1 day")
    avg = (s.groupBy(w.alias("w")).agg(F.round(F.avg("temperature"), 6).alias("avg_temp"))
            .select(iso_local(F.col("w.end").cast("timestamp_ntz")).alias("window_end"), "avg_temp"))
    _run(SJ.exactly_once_file_sink(avg, f"{tmp}/out", f"{tmp}/ck"))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/out").collect())
    last = events(spark, SF_SMALL).agg(F.max("ts")).first()[0]
    want = sorted(tuple(r) for r in queries()["e14_global_avg"](spark, SF_SMALL).collect()
                  if pd.Timestamp(r.window_end) <= pd.Timestamp(last))
    assert got == want and len(got) > 0


def test_json_jobs_on_a_stream(spark, tmp):
    """O-E7 / O-E8 stream forms: decoded records -> windows in append mode ->
    JSON documents (search-index sink) and key/value records (Kafka shape).
    Runs on sf0.01: at sf0.001 no user id passes the mean job's ``id > 20``."""
    from eventflow.functions import tokens as TK
    from eventflow.functions.scalar import from_epoch_ms, json_dynamic_key
    from eventflow.plans.common import event_json
    from eventflow.sinks.files import JsonDocumentSink, kafka_records
    from eventflow.sources.decode import decode_event
    from __spark_entry__ import queries
    raw = event_json(events(spark, SF_CHECK))
    write_replay_files(raw, f"{tmp}/src", "event_id", 3)
    d = decode_event(SJ.replay_stream(spark, f"{tmp}/src", raw.schema), "raw", keep=("event_id",))
    d = d.withColumn("t", from_epoch_ms("tm").cast("timestamp")).withWatermark("t", "0 seconds")
    w = F.window("t", "1 day")
    # E7: tag counts as JSON documents
    tags = (d.filter((F.col("id") > 10) & F.col("name").isNotNull())
             .select("event_id", "tm", "t", F.explode(TK.jvm_split("name", "s")).alias("word"))
             .groupBy(w.alias("w"), "word")
             .agg(F.count(F.lit(1)).alias("cnt"), F.min_by("tm", "event_id").alias("first_tm")))
    docs = tags.select(json_dynamic_key([("count", F.col("cnt")), ("name", F.col("word")),
                                         ("timestamp", F.col("first_tm"))]).alias("doc"))
    sink = JsonDocumentSink(f"{tmp}/docs", "event_data", "event")
    _run(docs.writeStream.foreachBatch(sink.foreach_batch()).option("checkpointLocation", f"{tmp}/ck1")
         .trigger(availableNow=True).start())
    got7 = sorted(r.value for r in spark.read.text(f"{tmp}/docs/event_data/event").collect())
    # E8: integer mean per name as Kafka records
    mean = (d.filter((F.col("id") > 20) & F.col("name").isNotNull()).groupBy(w.alias("w"), "name")
             .agg(F.expr("sum(cast(id as bigint)) div count(1)").alias("m"), F.max("tm").alias("mx")))
    rec = kafka_records(mean.withColumn("doc", json_dynamic_key(
        [("count", F.col("m")), ("agg", F.lit("result")), ("timestamp", F.col("mx"))])), "doc", "name")
    _run(rec.writeStream.format("memory").queryName("e8s").option("checkpointLocation", f"{tmp}/ck2")
         .trigger(availableNow=True).start())
    got8 = sorted(tuple(r) for r in spark.sql("select key, value from e8s").collect())
    # batch forms restricted to windows closed by the final watermark
    last = events(spark, SF_CHECK).agg(F.max("ts")).first()[0]
    closed = lambda end: pd.Timestamp(end) <= pd.Timestamp(last)
    want7 = sorted(r.doc for r in queries()["e7_tag_counts"](spark, SF_CHECK).collect() if closed(r.window_end))
    b8 = queries()["g10_int_mean"](spark, SF_CHECK).collect()
    keep = {(r.name, r.mean_id, r.max_tm) for r in b8 if closed(r.window_end)}
    want8 = sorted(tuple(r) for r in queries()["e8_mean_id"](spark, SF_CHECK).collect()
                   if any(r.key == k and r.value == f'{{"count":{m},"agg":"result","timestamp":{t}}}'
                          for k, m, t in keep))
    assert got7 == want7 and len(got7) > 0
    assert got8 == want8 and len(got8) > 0


def test_sensor_jobs_on_a_stream(spark, replay, tmp):
    """O-E1 (average per window, Celsius) and O-E13 -> O-P5 (window max kept in
    a keyed latest-value table) on the replay; equal to the batch jobs on
    windows the watermark closed."""
    from eventflow.functions.scalar import fahrenheit_to_celsius
    from __spark_entry__ import queries
    path, schema = replay
    s = SJ.replay_stream(spark, path, schema).withWatermark("ts", "0 seconds")
    w = F.window("ts", "1 day")
    e1 = (s.withColumn("c", fahrenheit_to_celsius("temperature")).groupBy("id", w.alias("w"))
           .agg(F.round(F.avg("c"), 6).alias("avg_celsius"))
           .select("id", F.col("w.end").cast("timestamp_ntz").alias("ts"), "avg_celsius"))
    _run(e1.writeStream.format("memory").queryName("e1s").option("checkpointLocation", f"{tmp}/ck1")
         .trigger(availableNow=True).start())
    mx = (s.groupBy("id", w.alias("w")).agg(F.max("temperature").alias("max_temp"))
           .select("id", F.col("w.end").cast("timestamp_ntz").alias("window_end"), "max_temp"))
    table = VersionedKeyedTable(spark, f"{tmp}/latest", ["id"], ["window_end"])
    _run(mx.writeStream.foreachBatch(table.foreach_batch()).option("checkpointLocation", f"{tmp}/ck2")
         .trigger(availableNow=True).start())
    last = pd.Timestamp(events(spark, SF_SMALL).agg(F.max("ts")).first()[0])
    got1 = sorted(tuple(r) for r in spark.sql("select id, ts, avg_celsius from e1s").collect())
    want1 = sorted(tuple(r) for r in queries()["e1_avg_sensor"](spark, SF_SMALL).collect()
                   if pd.Timestamp(r.ts) <= last)
    assert got1 == want1 and len(got1) > 0
    closed = queries()["e13_max_temp_tracker"](spark, SF_SMALL).filter(
        F.col("window_end") <= F.lit(last.to_pydatetime()))
    want13 = sorted(tuple(r) for r in latest_per_key(closed, ["id"], ["window_end"])
                    .select("id", "window_end", "max_temp").collect())
    got13 = sorted(tuple(r) for r in table.read().select("id", "window_end", "max_temp").collect())
    assert got13 == want13 and len(got13) > 0


def test_code_time_detail_stream_equals_batch(spark, tmp):
    """O-E11: parsed code/time lines replayed as a stream, per-element running
    window detail from keyed state; equal to the batch job."""
    from eventflow.functions.scalar import from_epoch_ms
    from eventflow.plans.texts import _code_lines
    from eventflow.sources.decode import parse_code_time
    from eventflow.streaming.windows import running_detail_stream
    from __spark_entry__ import queries
    lines = _code_lines(spark, SF_SMALL)
    write_replay_files(lines, f"{tmp}/src", "event_id", 3)
    s = SJ.replay_stream(spark, f"{tmp}/src", lines.schema)
    p = parse_code_time(s, "line", keep=("event_id",)).withColumn(
        "ts", from_epoch_ms("tm").cast("timestamp"))
    out = running_detail_stream(p, "code", "ts", "1 day", "event_id")
    _run(out.writeStream.format("memory").queryName("e11s").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    cols = ["code", "size", "first_ts", "ts", "window_start", "window_end"]
    norm = lambda r: tuple(pd.Timestamp(x).tz_localize(None) if hasattr(x, "year") else x for x in r)
    got = sorted(norm(tuple(r)) for r in spark.sql("select * from e11s").select(*cols).collect())
    want = sorted(norm(tuple(r)) for r in queries()["e11_code_time_detail"](spark, SF_SMALL)
                  .select(*cols).collect())
    assert got == want and len(got) > 0


def test_room_min_max_stream_with_own_clock(spark, tmp):
    """O-E10 stream form: decode -> clamp -> per-row watermark (ts - 5 ms) ->
    (room, id) 1 h windows -> min/max; equal to the batch job on every window
    the final watermark passed."""
    from eventflow.functions.scalar import clamp_future, from_epoch_ms
    from eventflow.plans.common import room_json
    from eventflow.plans.texts import MOVE_MS, NOW_MS
    from eventflow.sources.decode import decode_room_event
    from eventflow.streaming.lateness import OwnClockWindowAggregate
    from __spark_entry__ import queries
    raw = room_json(events(spark, SF_SMALL))
    write_replay_files(raw, f"{tmp}/src", "event_id", 3)
    s = SJ.replay_stream(spark, f"{tmp}/src", raw.schema)
    d = decode_room_event(s, "raw", keep=("event_id",))
    d = d.withColumn("tm", clamp_future("tm", F.lit(NOW_MS), MOVE_MS)).withColumn(
        "ts", from_epoch_ms("tm"))
    agg = OwnClockWindowAggregate(spark, f"{tmp}/e10", ["room", "id"], "ts", "event_id", "1 hour",
                                  "5 milliseconds", {"min_v": ("min", "v"), "max_v": ("max", "v"),
                                                     "tm": ("max", "tm")})
    _run(d.writeStream.foreachBatch(agg.process).option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    cols = ["room", "id", "window_end", "min_v", "max_v", "tm"]
    key = lambda t: tuple("" if x is None else x for x in t)   # room may be null
    got = sorted((tuple(r) for r in agg.read().select(*cols).collect()), key=key)
    wm = agg.watermark_us()
    want = sorted((tuple(r) for r in queries()["e10_room_min_max"](spark, SF_SMALL)
                   .select(*cols).collect()
                   if pd.Timestamp(r.window_end).value // 1000 - 1000 <= wm), key=key)
    assert got == want and len(got) > 0


def test_asof_control_stream_equals_batch(spark, tmp):
    """O-J1 stream form: the smoke-level control stream and the readings in one
    replayed stream; the ledger carries the last level across micro-batches."""
    from eventflow.streaming.lateness import AsOfControlStream
    from __spark_entry__ import queries
    ev = events(spark, SF_SMALL)
    src = ev.select("event_id", F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature"),
                    F.when(F.col("event_type") == "error", 0).otherwise(1).alias("kind"),
                    F.when(F.col("value") > 50, "High").otherwise("Low").alias("level"))
    write_replay_files(src, f"{tmp}/src", "event_id", 3)
    s = SJ.replay_stream(spark, f"{tmp}/src", src.schema)
    op = AsOfControlStream(spark, f"{tmp}/j1", "ts", "level", "smoke")
    _run(s.writeStream.foreachBatch(op.process).option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    alerts = op.read().filter((F.coalesce("smoke", F.lit("Low")) == "High") & (F.col("temperature") > 100))
    got = sorted(r.event_id for r in alerts.collect())
    want = sorted(r.event_id for r in queries()["j1_asof_alert"](spark, SF_SMALL).collect())
    assert got == want and len(got) > 0


def test_window_counts_with_late_side_output_stream(spark, replay, tmp):
    """O-M7 stream form: own-clock watermark (1 h), 1 h window counts of
    on-time rows, late rows to a side output; equal to the batch queries."""
    from eventflow.streaming.lateness import OwnClockWindowAggregate
    from __spark_entry__ import queries
    path, schema = replay
    s = SJ.replay_stream(spark, path, schema).select("event_id", "id", "ts2")
    agg = OwnClockWindowAggregate(spark, f"{tmp}/m7", ["id"], "ts2", "event_id", "1 hour",
                                  "1 hour", {"cnt": ("count", "event_id")})
    _run(s.writeStream.foreachBatch(agg.process).option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    wm = agg.watermark_us()
    got = sorted(tuple(r) for r in agg.read().select("id", "window_end", "cnt").collect())
    want = sorted(tuple(r) for r in queries()["m7_window_counts"](spark, SF_SMALL).collect()
                  if pd.Timestamp(r.window_end).value // 1000 - 1000 <= wm)
    assert got == want and len(got) > 0
    late = sorted(r.event_id for r in agg.read_late().collect())
    want_late = sorted(r.event_id for r in queries()["m7_late_rows"](spark, SF_SMALL).collect())
    assert late == want_late and len(late) > 0


def test_side_output_stream(spark, replay, tmp):
    """O-M9 stream form: all readings to the main output, freezing ones also
    to the alarm side output, in one foreachBatch."""
    path, schema = replay
    main_p, side_p = f"{tmp}/main", f"{tmp}/side"
    fn = SJ.side_output_batch(
        F.col("temperature") < 32.0,
        lambda df, b: df.write.mode("overwrite").parquet(f"{main_p}/batch={b}"),
        lambda df, b: df.select("id", F.format_string("Freezing Alarm for %s", "id").alias("message"))
                       .write.mode("overwrite").parquet(f"{side_p}/batch={b}"))
    _run(SJ.replay_stream(spark, path, schema).writeStream.foreachBatch(fn)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    ev = sensors(events(spark, SF_SMALL))
    assert spark.read.parquet(main_p).count() == 1000
    assert spark.read.parquet(side_p).count() == ev.filter("temperature < 32").count()


def test_as_of_control_stream_goes_by_time(spark, tmp):
    from eventflow.streaming.lateness import AsOfControlStream
    schema = "event_id long, kind int, ts timestamp, level int"
    t = lambda s: (pd.Timestamp("2024-03-01") + pd.Timedelta(seconds=s)).to_pydatetime()
    batches = [
        [(1, 0, t(10), 7)],                                  # a control
        [(2, 1, t(5), None), (3, 1, t(12), None)],           # one reading before it, one after
        [(4, 0, t(8), 3), (5, 1, t(11), None), (6, 1, t(9), None)],  # an old control, late
        [(7, 0, t(20), None), (8, 1, t(21), None)],          # a control without a value
    ]
    op = AsOfControlStream(spark, f"{tmp}/j1", "ts", "level", "smoke", tie="event_id")
    for i, rows in enumerate(batches):
        for _ in range(2):  # a replayed batch changes nothing
            op.process(spark.createDataFrame(rows, schema), i)
    got = {r.event_id: r.smoke for r in op.read().collect()}
    assert got == {2: None, 3: 7, 5: 7, 6: 3, 8: None}


def test_keyed_table_does_not_depend_on_batches(spark, tmp):
    rows = [("a", 30, 1), ("a", 10, 2), (None, 5, 3), (None, 9, 4), ("b", 1, 5)]
    schema = "k string, ts long, v long"
    results = []
    for name, parts in (("one", [rows]), ("many", [[r] for r in rows]), ("back", [[r] for r in rows[::-1]])):
        table = VersionedKeyedTable(spark, f"{tmp}/{name}", ["k"], ["ts"])
        for i, part in enumerate(parts):
            table.upsert(spark.createDataFrame(part, schema), i)
        results.append(sorted((r.k or "", r.ts, r.v) for r in table.read().collect()))
    assert results == [[("", 9, 4), ("a", 30, 1), ("b", 1, 5)]] * 3


def test_write_ahead_sink_hides_uncommitted_batches(spark, tmp):
    sink = WriteAheadSink(spark, f"{tmp}/wal")
    sink.write_batch(spark.range(3), 0)
    spark.range(5).write.parquet(f"{tmp}/wal/data/batch=1")  # written, not recorded: a crash
    assert sink.read().count() == 3
    sink.write_batch(spark.range(5), 1)
    assert sink.read().count() == 8


def test_window_operators_run_on_watermarked_streams(spark, replay, tmp):
    from eventflow.operators import windows as W
    path, schema = replay
    src = SJ.replay_stream(spark, path, schema).select("id", "ts").withWatermark("ts", "0 seconds")
    batch = sensors(events(spark, SF_SMALL)).select("id", F.col("ts").cast("timestamp").alias("ts"))
    forms = {
        "tumble": lambda d: W.window_agg(d, "ts", "1 day", ["id"], [F.count(F.lit(1)).alias("cnt")]),
        "slide4": lambda d: W.sliding_agg(d, "ts", "1 day", "6 hours", ["id"], {}),
        "slide2": lambda d: W.sliding_agg(d, "ts", "1 day", "12 hours", ["id"], {}),
    }
    for name, form in forms.items():
        out = form(src)
        want = form(batch)
        assert [f.dataType for f in out.schema] == [f.dataType for f in want.schema]
        _run(out.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", f"{tmp}/{name}").trigger(availableNow=True).start())
        got = sorted(tuple(r) for r in spark.sql(f"select * from {name}").collect())
        last = max(r[1] for r in got)
        assert got == sorted(tuple(r) for r in want.collect() if r.window_end <= last) and got


def test_processor_takes_any_key_and_names_in_arrival_order(spark, tmp):
    base = pd.Timestamp("2024-03-01", tz="UTC")
    # Out of order within the watermark: 50 comes at 5 s, then 48 at 3 s.
    rows = [(0, "sensor_1", base + pd.Timedelta(seconds=0), 10.0), (1, "sensor_1", base + pd.Timedelta(seconds=5), 50.0),
            (2, "sensor_2", base + pd.Timedelta(seconds=1), 1.0), (3, "sensor_1", base + pd.Timedelta(seconds=3), 48.0),
            (4, "sensor_1", base + pd.Timedelta(seconds=6), 5.0), (5, "sensor_2", base + pd.Timedelta(seconds=2), 99.0)]
    src = spark.createDataFrame(pd.DataFrame(rows, columns=["seq", "device", "at", "level"]))
    results = []
    for n in (1, 3):
        write_replay_files(src, f"{tmp}/src{n}", "seq", n)
        s = SJ.replay_stream(spark, f"{tmp}/src{n}", src.schema)
        out = apply_processor(s, "device", DeltaAlertProcessor(30.0, order="seq"), ALERT_SCHEMA,
                              "1 minute", "at", "level")
        assert out.columns == ["device", "at", "level", "diff"]
        _run(out.writeStream.format("memory").queryName(f"any{n}").option("checkpointLocation", f"{tmp}/ck{n}")
             .trigger(availableNow=True).start())
        results.append(sorted((r.device, r.level, r.diff) for r in spark.sql(f"select * from any{n}").collect()))
    assert results[0] == results[1] == [("sensor_1", 5.0, 43.0), ("sensor_1", 50.0, 40.0), ("sensor_2", 99.0, 98.0)]


def test_running_aggregates_across_batches(spark, tmp):
    """O-A2, O-A3 and O-A5 on a stream: any split into batches gives the batch result."""
    from eventflow.streaming.running import RunningAggregates
    from __spark_entry__ import queries
    rows = events(spark, SF_SMALL).select("event_id", F.col("user_id").alias("id"), "value", "event_type")
    want = sorted((r.event_id, r.id, r.running_sum, r.event_type) for r in queries()["a2_rolling_sum"](spark, SF_SMALL).collect())
    counts = {r.event_id: r.cnt for r in queries()["a3_running_count"](spark, SF_SMALL).collect()}
    op = RunningAggregates(spark, f"{tmp}/run", ["id"], "event_id", [
        ("value", "sum", "running_sum"), ("event_type", "first", "first_type"), ("one", "sum", "cnt")])
    for i in range(3):
        part = rows.filter((F.col("event_id") >= i * 400) & (F.col("event_id") < (i + 1) * 400))
        for _ in range(2):  # a replayed batch changes nothing
            op.process(part.withColumn("one", F.lit(1)), i)
    got = op.read().collect()
    assert sorted((r.event_id, r.id, round(r.running_sum, 6), r.first_type) for r in got) == want
    assert {r.event_id: r.cnt for r in got} == counts


def test_punctuated_watermark_across_batches(spark, tmp):
    """O-M3 on a stream: only marker rows advance the watermark; batches equal the table."""
    from eventflow.operators import eventtime as T
    src = out_of_order(events(spark, SF_SMALL)).select("event_id", "user_id", "ts2")
    batch = T.with_watermark_column(src, "ts2", "event_id", "1 hour", marker=F.col("user_id") % 3 == 0)
    main, late = T.late_split(batch, "ts2")
    op = LateSplitter(spark, f"{tmp}/m3", "ts2", "event_id", "1 hour", marker="user_id % 3 = 0")
    for i in range(4):
        op.process(src.filter((F.col("event_id") >= i * 250) & (F.col("event_id") < (i + 1) * 250)), i)
    for which, want in (("main", main), ("late", late)):
        assert sorted(r.event_id for r in op.read(which).collect()) == sorted(r.event_id for r in want.collect())
    assert late.count() > 0
