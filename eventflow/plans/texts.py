"""Registered source, row-function, text and JSON-job queries (O-S3..S8,
O-R*, O-A1, O-G10..G12, O-K1, O-K6, O-K7, O-E4..E8, O-E10..E12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.functions import tokens as TK
from eventflow.functions.scalar import (clamp_future, epoch_ms, fahrenheit_to_celsius,
                                        format_message, from_epoch_ms, iso_local, json_dynamic_key)
from eventflow.operators import eventtime as T
from eventflow.operators import windows as W
from eventflow.plans.common import (EVENT_JSON_SQL, ROOM_JSON_SQL, TUMBLE, event_json, events,
                                    r6, room_json, sensors, table)
from eventflow.sources.tables import text_table
from eventflow.plans.registry import register
from eventflow.plans.windowed import _HOT_ITEMS_SQL, e2_hot_items
from eventflow.session import scratch_path
from eventflow.sinks.files import kafka_records, write_delimited, write_json_documents
from eventflow.sources import decode as D
from eventflow.sources import files as S

# Fixed values (test bindings).
NOW_MS = 1706140800000          # 2024-01-25T00:00:00Z, the "now" of O-R12
MOVE_MS = 86_400_000            # allowed look-ahead of event time
TAG_MIN_ID, MEAN_MIN_ID = 10, 20
TAG_SEPARATOR = "s"             # the reference splits names on the letter s
ROOM_WINDOW = "1 hour"
WORD_SLIDE_SIZE, WORD_SLIDE_STEP = "5 seconds", "1 second"
STOPWORD_WINDOW = "10 seconds"


# ---------------------------------------------------------------- sources ----

@register("s3_text_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def s3_text_lines(spark, sf):
    """O-S3: text-line source over files written from ``documents.text``."""
    path = scratch_path(spark, "s3-text")
    text_table(spark, sf, "documents").select("text").write.text(path)
    return S.text_lines(spark, path)


@register("s4_delimited_edges", """
SELECT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1""")
def s4_delimited_edges(spark, sf):
    """O-S4 + O-K1: edges written as space-delimited text (with an extra
    field) and read back with a fixed schema, selecting fields 0 and 1."""
    path = scratch_path(spark, "s4-edges")
    write_delimited(_edges_with_qty(spark, sf), path, sep=" ")
    return S.delimited(spark, path, "src bigint, dst bigint, qty double", " ", ["src", "dst"])


def _edges_with_qty(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    a, b = li.alias("a"), li.alias("b")
    return (a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
                   & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1))
             .select(F.col("a.l_partkey").alias("src"), F.col("b.l_partkey").alias("dst"),
                     F.col("b.l_quantity").alias("qty")))


@register("s6_decode_event", f"WITH {EVENT_JSON_SQL} SELECT * FROM event_data")
def s6_decode_event(spark, sf):
    """O-S6: JSON records -> (id, name, tm); broken records -> (0, "", 0)."""
    return D.decode_event(event_json(events(spark, sf)), "raw", keep=("event_id",))


@register("s7_decode_room_event", f"WITH {ROOM_JSON_SQL} SELECT * FROM room_event")
def s7_decode_room_event(spark, sf):
    """O-S7: JSON records with text fields -> (v float, room, id, tm)."""
    return D.decode_room_event(room_json(events(spark, sf)), "raw", keep=("event_id",))


def _code_lines(spark, sf):
    ev = events(spark, sf)
    line = F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lpad((F.col("user_id") % 100).cast("string"), 4, "0"), F.lit(","),
                 F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return ev.select("event_id", line.alias("line"))


_CODE_LINES_SQL = """
l AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ''
             ELSE lpad(CAST(user_id % 100 AS VARCHAR), 4, '0') || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S')
             END AS line FROM events),
p AS (SELECT event_id, split_part(line, ',', 1) AS code,
             epoch_ms(strptime(split_part(line, ',', 2), '%Y-%m-%d %H:%M:%S')) AS tm
      FROM l WHERE line <> '')"""


@register("s8_code_time", f"WITH {_CODE_LINES_SQL} SELECT event_id, code, tm FROM p")
def s8_code_time(spark, sf):
    """O-S8: ``code,yyyy-MM-dd HH:mm:ss`` lines -> (code, epoch ms), empty lines dropped."""
    return D.parse_code_time(_code_lines(spark, sf), "line", keep=("event_id",))


@register("s8_stock", """
SELECT event_id, CAST(trim(split_part(line, ',', 1)) AS INTEGER) AS price,
       CAST(trim(split_part(line, ',', 2)) AS INTEGER) AS volume FROM (
  SELECT event_id, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
         || CASE WHEN event_id % 2 = 0 THEN ', ' ELSE ',' END || CAST(user_id AS VARCHAR) AS line
  FROM events)""")
def s8_stock(spark, sf):
    """O-S8: ``"price, volume"`` lines -> trimmed ints."""
    ev = events(spark, sf)
    line = F.concat(F.floor("value").cast("bigint").cast("string"),
                    F.when(F.col("event_id") % 2 == 0, F.lit(", ")).otherwise(F.lit(",")),
                    F.col("user_id").cast("string"))
    return D.parse_stock(ev.select("event_id", line.alias("line")), "line", keep=("event_id",))


# ------------------------------------------------------------ row functions ----

@register("r1_celsius", """
SELECT event_id, user_id AS id, round((value - 32) * (5.0 / 9.0), 6) AS temp_c FROM events""")
def r1_celsius(spark, sf):
    """O-R1: Fahrenheit to Celsius."""
    d = sensors(events(spark, sf))
    return d.select("event_id", "id", r6(fahrenheit_to_celsius("temperature")).alias("temp_c"))


@register("r2_projection", "SELECT user_id AS id FROM events")
def r2_projection(spark, sf):
    """O-R2: projection (only ``user_id`` is read from parquet)."""
    return sensors(events(spark, sf)).select("id")


@register("r3_filter", """
SELECT event_id, user_id AS id, ts, value AS temperature FROM events WHERE value >= 25""")
def r3_filter(spark, sf):
    """O-R3: threshold filter ``temperature >= 25`` (pushed into the scan)."""
    return sensors(events(spark, sf)).filter(F.col("temperature") >= 25)


@register("r4_split_ids", """
SELECT c_custkey, unnest(string_split(c_name, '#')) AS part FROM customer""")
def r4_split_ids(spark, sf):
    """O-R4: flatMap ``id.split(sep)`` to one row per part."""
    return TK.split_explode(table(spark, sf, "customer"), "c_name", "#", "part", keep=("c_custkey",))


@register("r5_word_tokens", r"""
SELECT doc_id, word FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents)
WHERE word <> ''""")
def r5_word_tokens(spark, sf):
    """O-R5: lower-case ``\\W+`` tokens of whole documents."""
    return TK.word_tokens(text_table(spark, sf, "documents"), "text", keep=("doc_id",))


@register("r6_stopword_tokens", """
SELECT conv_id, turn, lower(w) AS word FROM (
  SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w FROM conversations)
WHERE w <> '' AND lower(w) NOT IN ('a', 'an', 'the')""")
def r6_stopword_tokens(spark, sf):
    """O-R6: space tokens, lower-cased, stop words removed."""
    return TK.stopword_tokens(text_table(spark, sf, "conversations"), "text", keep=("conv_id", "turn"))


_WS_TOKENS_SQL = r"""
lines AS (SELECT {keys}, unnest(string_split(text, chr(10))) AS line FROM {src}),
toks AS (SELECT {keys}, unnest(CASE WHEN line = '' THEN [''::VARCHAR]
                                    WHEN regexp_replace(line, '\s+$', '') = '' THEN []::VARCHAR[]
                                    ELSE string_split_regex(regexp_replace(line, '\s+$', ''), '\s') END)
                 AS word FROM lines)"""


@register("r7_whitespace_tokens", "WITH " + _WS_TOKENS_SQL.format(keys="conv_id, turn", src="conversations")
          + " SELECT conv_id, turn, word FROM toks")
def r7_whitespace_tokens(spark, sf):
    """O-R7: lines split on a single ``\\s``, interior empty tokens kept,
    trailing empties dropped (JVM split semantics)."""
    return TK.whitespace_tokens(text_table(spark, sf, "conversations"), "text", keep=("conv_id", "turn"))


@register("r8_point_chain", """
WITH s AS (SELECT sum(p_size) AS x, sum(p_partkey) AS y FROM part WHERE p_size > 1),
u AS (SELECT 'x' AS name, x AS v FROM s UNION ALL SELECT 'y', y FROM s)
SELECT name, CAST(sum(v) AS BIGINT) AS total FROM u GROUP BY name""")
def r8_point_chain(spark, sf):
    """O-R8: filter x > 1 -> global sum of points -> one row per coordinate
    name -> group by name (points = (p_size, p_partkey))."""
    pts = table(spark, sf, "part").select(F.col("p_size").cast("bigint").alias("x"),
                                          F.col("p_partkey").alias("y"))
    s = pts.filter(F.col("x") > 1).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    u = s.unpivot([], ["x", "y"], "name", "v")
    return u.groupBy("name").agg(F.sum("v").cast("bigint").alias("total"))


@register("r9_json_encode", """
SELECT event_type, user_id,
       '{"count":' || count(*) || ',"' || event_type || '":"' || CAST(user_id AS VARCHAR)
       || '","timestamp":' || (epoch_us(arg_min(ts, event_id)) // 1000) || '}' AS doc
FROM events GROUP BY event_type, user_id""")
def r9_json_encode(spark, sf):
    """O-R9: JSON document whose field *name* is the value of a column
    (``{"count": n, "<type>": "<word>", "timestamp": t}``)."""
    g = events(spark, sf).groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.min_by("ts", "event_id").alias("first_ts"))
    doc = json_dynamic_key([("count", F.col("cnt")),
                            (F.col("event_type"), F.col("user_id").cast("string")),
                            ("timestamp", epoch_ms("first_ts"))])
    return g.select("event_type", "user_id", doc.alias("doc"))


@register("r10_iso_format", """
SELECT event_id, strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS iso
FROM events""")
def r10_iso_format(spark, sf):
    """O-R10: ISO local date-time text (UTC) of each event's window end."""
    ev = events(spark, sf)
    return ev.select("event_id", iso_local(F.window("ts", "1 hour").end).alias("iso"))


@register("r11_composite_key", """
SELECT event_type AS room, user_id AS id, count(*) AS cnt FROM events GROUP BY ALL""")
def r11_composite_key(spark, sf):
    """O-R11: grouping by (room, id) as two real key columns."""
    return (events(spark, sf).groupBy(F.col("event_type").alias("room"), F.col("user_id").alias("id"))
            .agg(F.count(F.lit(1)).alias("cnt")))


@register("r12_clamp_future", f"""
SELECT event_id, CASE WHEN (epoch_us(ts) // 1000) > {NOW_MS} + {MOVE_MS} THEN {NOW_MS} ELSE (epoch_us(ts) // 1000) END AS tm
FROM events""")
def r12_clamp_future(spark, sf):
    """O-R12: event times too far in the future are clamped to ``now``."""
    ev = events(spark, sf)
    return ev.select("event_id", clamp_future(epoch_ms("ts"), F.lit(NOW_MS), MOVE_MS).alias("tm"))


@register("r13_message_format", """
SELECT window_end, 'No' || rank || ': item=' || item_id || ', views=' || view_count AS message
FROM (""" + _HOT_ITEMS_SQL + ")")
def r13_message_format(spark, sf):
    """O-R13: formatted result text (the hot-items ranking lines)."""
    d = e2_hot_items(spark, sf)
    return d.select("window_end", format_message("No%d: item=%d, views=%d", "rank", "item_id",
                                                 "view_count").alias("message"))


@register("a1_group_sum", """
SELECT l_partkey, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY l_partkey""")
def a1_group_sum(spark, sf):
    """O-A1: hash aggregation group/sum (partial + final around one exchange)."""
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("sum_qty"))


# ------------------------------------------------------------ word counts ----

@register("e4_word_count", r"""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def e4_word_count(spark, sf):
    """O-E4: batch word count over whole documents."""
    toks = TK.word_tokens(text_table(spark, sf, "documents"), "text")
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@register("k1_csv_roundtrip", r"""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def k1_csv_roundtrip(spark, sf):
    """O-K1: word counts written as ``word count`` lines and read back."""
    path = scratch_path(spark, "k1-words")
    write_delimited(e4_word_count(spark, sf), path, sep=" ")
    return S.delimited(spark, path, "word string, cnt bigint", " ")


@register("e5_sliding_word_count", "WITH " + _WS_TOKENS_SQL.format(
    keys="doc_id", src="documents") + """
SELECT word, make_timestamp((doc_id + 1 + i) * 1000000) AS window_end, count(*) AS cnt
FROM toks, range(5) t(i) GROUP BY ALL""")
def e5_sliding_word_count(spark, sf):
    """O-E5: sliding (5 s / 1 s) word count on a text stream; documents
    arrive one per second (arrival clock = doc_id seconds)."""
    docs = table(spark, sf, "documents").select(
        F.timestamp_seconds("doc_id").cast("timestamp_ntz").alias("at"), "text")
    return W.sliding_counts_of(
        docs, "at", WORD_SLIDE_SIZE, WORD_SLIDE_STEP, ["word"],
        lambda rows, keep: TK.whitespace_tokens(rows, "text", keep=keep), F.octet_length("text")).drop("window_start")


@register("e6_stopword_count", """
SELECT lower(w) AS word, make_timestamp((conv_id // 10) * 10000000 + 10000000) AS window_end,
       count(*) AS cnt FROM (
  SELECT conv_id, unnest(string_split(text, ' ')) AS w FROM conversations)
WHERE w <> '' AND lower(w) NOT IN ('a', 'an', 'the') GROUP BY ALL""")
def e6_stopword_count(spark, sf):
    """O-E6: stop-word-filtered tumbling (10 s) word count; one conversation
    arrives per second (arrival clock = conv_id seconds)."""
    conv = text_table(spark, sf, "conversations").select(
        F.timestamp_seconds("conv_id").cast("timestamp_ntz").alias("at"), "text")
    toks = TK.stopword_tokens(conv, "text", keep=("at",))
    w = F.window("at", STOPWORD_WINDOW)
    return toks.groupBy("word", w.end.alias("window_end")).agg(F.count(F.lit(1)).alias("cnt"))


# -------------------------------------------------------------- JSON jobs ----

def _event_data(spark, sf):
    return D.decode_event(event_json(events(spark, sf)), "raw", keep=("event_id",))


_TAG_SQL = f"""WITH {EVENT_JSON_SQL},
parts AS (
  SELECT event_id, tm, unnest(CASE WHEN name = '' THEN [''::VARCHAR]
         WHEN regexp_replace(name, '(s)+$', '') = '' THEN []::VARCHAR[]
         ELSE string_split(regexp_replace(name, '(s)+$', ''), '{TAG_SEPARATOR}') END) AS word
  FROM event_data WHERE id > {TAG_MIN_ID} AND name IS NOT NULL),
g AS (SELECT word, time_bucket(INTERVAL 1 DAY, make_timestamp(tm * 1000)) + INTERVAL 1 DAY AS window_end,
             count(*) AS cnt, arg_min(tm, event_id) AS first_tm FROM parts GROUP BY ALL)"""


def _tag_counts(spark, sf):
    d = _event_data(spark, sf).filter((F.col("id") > TAG_MIN_ID) & F.col("name").isNotNull())
    parts = d.select("event_id", "tm", F.explode(TK.jvm_split("name", TAG_SEPARATOR)).alias("word"))
    parts = parts.withColumn("ts", from_epoch_ms("tm"))
    w = F.window("ts", TUMBLE)
    return (parts.groupBy("word", w.end.alias("window_end"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.min_by("tm", "event_id").alias("first_tm"))
            .filter(F.col("cnt") > 0))


@register("g11_reduce_plus", f"{_TAG_SQL} SELECT * FROM g WHERE cnt > 0")
def g11_reduce_plus(spark, sf):
    """O-G11: reduce with ``+`` per window (counts add, other fields from the
    first row), then keep totals > 0."""
    return _tag_counts(spark, sf)


@register("e7_tag_counts", f"""{_TAG_SQL}
SELECT word, window_end, '{{"count":' || cnt || ',"name":' || to_json(word) || ',"timestamp":' || first_tm || '}}' AS doc
FROM g WHERE cnt > 0""")
def e7_tag_counts(spark, sf):
    """O-E7: names of events with id > 10 split on the letter ``s``, counted
    per tumbling window, rendered as JSON documents."""
    g = _tag_counts(spark, sf)
    doc = json_dynamic_key([("count", F.col("cnt")), ("name", F.col("word")),
                            ("timestamp", F.col("first_tm"))])
    return g.select("word", "window_end", doc.alias("doc"))


_MEAN_SQL = f"""WITH {EVENT_JSON_SQL},
g AS (SELECT name, time_bucket(INTERVAL 1 DAY, make_timestamp(tm * 1000)) + INTERVAL 1 DAY AS window_end,
             CAST(sum(id) // count(*) AS BIGINT) AS mean_id, max(tm) AS max_tm
      FROM event_data WHERE id > {MEAN_MIN_ID} AND name IS NOT NULL GROUP BY ALL)"""


def _mean_id(spark, sf):
    d = _event_data(spark, sf).filter((F.col("id") > MEAN_MIN_ID) & F.col("name").isNotNull())
    w = F.window(from_epoch_ms("tm"), TUMBLE)
    return d.groupBy("name", w.end.alias("window_end")).agg(
        F.expr("sum(cast(id as bigint)) div count(1)").alias("mean_id"), F.max("tm").alias("max_tm"))


@register("g10_int_mean", f"{_MEAN_SQL} SELECT * FROM g")
def g10_int_mean(spark, sf):
    """O-G10: integer mean (truncating division) and latest tm per window."""
    return _mean_id(spark, sf)


@register("e8_mean_id", f"""{_MEAN_SQL}
SELECT name AS key, '{{"count":' || mean_id || ',"agg":"result","timestamp":' || max_tm || '}}' AS value FROM g""")
def e8_mean_id(spark, sf):
    """O-E8 + O-K7: ids > 20 keyed by name, integer mean per window, as
    Kafka (key, JSON value) records."""
    g = _mean_id(spark, sf)
    doc = json_dynamic_key([("count", F.col("mean_id")), ("agg", F.lit("result")),
                            ("timestamp", F.col("max_tm"))])
    return kafka_records(g.withColumn("doc", doc), "doc", "name")


@register("k6_json_documents", f"""{_TAG_SQL}
SELECT '{{"count":' || cnt || ',"name":' || to_json(word) || ',"timestamp":' || first_tm || '}}' AS value
FROM g WHERE cnt > 0""")
def k6_json_documents(spark, sf):
    """O-K6: the tag-count documents written to an index/type folder and read back."""
    path = scratch_path(spark, "k6-docs")
    write_json_documents(e7_tag_counts(spark, sf), path, "doc", index="event_data", doc_type="event")
    return spark.read.text(f"{path}/event_data/event")


_ROOM_SQL = f"""WITH {ROOM_JSON_SQL},
c AS (SELECT event_id, v, room, id,
             CASE WHEN tm > {NOW_MS} + {MOVE_MS} THEN {NOW_MS} ELSE tm END AS tm FROM room_event),
w AS (SELECT *, max(tm) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5 AS wm,
             (tm // 3600000) * 3600000 + 3600000 AS end_ms FROM c)
SELECT room, id, min(v) AS min_v, max(v) AS max_v, max(tm) AS tm,
       make_timestamp(end_ms * 1000) AS window_end
FROM w WHERE NOT coalesce(end_ms - 1 <= wm, false) GROUP BY room, id, end_ms"""


def _room_minmax(spark, sf):
    d = D.decode_room_event(room_json(events(spark, sf)), "raw", keep=("event_id",))
    d = d.withColumn("tm", clamp_future("tm", F.lit(NOW_MS), MOVE_MS))
    d = d.withColumn("ts", from_epoch_ms("tm"))
    d = T.with_watermark_column(d, "ts", "event_id", "5 milliseconds", "wm")
    d = d.filter(~T.window_late_flag("ts", ROOM_WINDOW, "_wm_us"))
    w = F.window("ts", ROOM_WINDOW)
    return d.groupBy("room", "id", w.end.alias("window_end")).agg(
        F.min("v").alias("min_v"), F.max("v").alias("max_v"), F.max("tm").alias("tm"))


@register("g12_room_min_max", _ROOM_SQL)
def g12_room_min_max(spark, sf):
    """O-G12: min/max v and latest tm per (room, id) window."""
    return _room_minmax(spark, sf)


@register("e10_room_min_max", _ROOM_SQL)
def e10_room_min_max(spark, sf):
    """O-E10: decode room events, clamp future times, per-row watermark
    (5 ms), (room, id) key, 1 h windows, min/max; late rows are dropped."""
    return _room_minmax(spark, sf)


@register("e11_code_time_detail", f"""WITH {_CODE_LINES_SQL},
q AS (SELECT event_id, code, make_timestamp(tm * 1000) AS ts FROM p)
SELECT code, count(*) OVER w AS size, first(ts) OVER w AS first_ts, ts,
       time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end
FROM q WINDOW w AS (PARTITION BY code, time_bucket(INTERVAL 1 DAY, ts) ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def e11_code_time_detail(spark, sf):
    """O-E11: parsed code/time lines, tumbling window per code, one detail
    row per element."""
    p = D.parse_code_time(_code_lines(spark, sf), "line", keep=("event_id",))
    p = p.withColumn("ts", from_epoch_ms("tm"))
    return W.running_detail(p, ["code"], "ts", TUMBLE, "event_id")


@register("e12_passthrough_etl", "SELECT * FROM events")
def e12_passthrough_etl(spark, sf):
    """O-E12: passthrough ETL into a file table (written, then read back)."""
    path = scratch_path(spark, "e12-etl")
    events(spark, sf).write.parquet(path)
    return spark.read.parquet(path)
