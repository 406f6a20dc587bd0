"""Registered window queries (O-W*, O-G*) and window jobs (O-E1, O-E2, ...)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.functions.scalar import fahrenheit_to_celsius
from eventflow.operators import windows as W
from eventflow.plans.common import (CUSTOM_SIZE, EARLY_TICK, EARLY_WINDOW, SLIDE_SIZE,
                                    SLIDE_STEP, TUMBLE, events, item_id, r6, sensors)
from eventflow.plans.registry import register

# ---------------------------------------------------------------- O-E2 ----

_HOT_ITEMS_SQL = """
WITH v AS (SELECT ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
           FROM events WHERE event_type = 'view'),
w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 1 DAY - i * INTERVAL 6 HOUR AS window_end,
             item_id FROM v, range(4) t(i)),
c AS (SELECT window_end, item_id, count(*) AS view_count FROM w GROUP BY window_end, item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rk
      FROM c)
SELECT window_end, item_id, view_count, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 3
"""


@register("e2_hot_items", _HOT_ITEMS_SQL)
def e2_hot_items(spark, sf):
    """Hot items: views only, 1 day windows sliding by 6 h, top 3 per window."""
    v = events(spark, sf).filter(F.col("event_type") == "view").select(
        "ts", item_id().alias("item_id"))
    counts = W.sliding_agg(v, "ts", SLIDE_SIZE, SLIDE_STEP, ["item_id"], {}, "view_count")
    top = W.top_n(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], 3)
    return top.select("window_end", "item_id", "view_count", "rank")


def _sensors(spark, sf):
    return sensors(events(spark, sf))


_DAY = """time_bucket(INTERVAL 1 DAY, ts)"""

# ---------------------------------------------------------------- windows ----


@register("w1_tumbling_count", f"""
SELECT user_id AS id, {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end,
       count(*) AS cnt
FROM events GROUP BY ALL""")
def w1_tumbling_count(spark, sf):
    """O-W1: tumbling 1 day event-time window, count per sensor."""
    d = W.tumbling(_sensors(spark, sf), "ts", TUMBLE)
    return d.groupBy("id", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


@register("w2_sliding_count", """
SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 1 DAY - i * INTERVAL 6 HOUR - INTERVAL 1 DAY AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 1 DAY - i * INTERVAL 6 HOUR AS window_end,
       count(*) AS cnt
FROM events, range(4) t(i) GROUP BY ALL""")
def w2_sliding_count(spark, sf):
    """O-W2: 1 day windows sliding by 6 h, count per event type."""
    return W.sliding_agg(events(spark, sf), "ts", SLIDE_SIZE, SLIDE_STEP, ["event_type"], {}, "cnt")


@register("w3_global_window", f"""
SELECT {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end, count(*) AS cnt,
       round(avg(value), 6) AS avg_value
FROM events GROUP BY ALL""")
def w3_global_window(spark, sf):
    """O-W3: non-keyed tumbling window (partial aggregation keeps it parallel)."""
    d = W.tumbling(events(spark, sf), "ts", TUMBLE)
    return d.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("cnt"), r6(F.avg("value")).alias("avg_value"))


@register("w4_custom_window", """
SELECT user_id AS id, make_timestamp(((epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 43200000) * 1000) AS window_start,
       make_timestamp(((epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 43200000 + 43200000) * 1000) AS window_end,
       count(*) AS cnt
FROM events GROUP BY ALL""")
def w4_custom_window(spark, sf):
    """O-W4: user assigner ``start = ts - ts % size`` (12 h) as column expressions."""
    d = W.custom_window(_sensors(spark, sf), "ts", W.epoch_aligned(CUSTOM_SIZE))
    return d.groupBy("id", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


@register("w5_early_firing", """
WITH r AS (
  SELECT user_id AS id, time_bucket(INTERVAL 12 HOUR, ts) AS ws, (epoch_us(ts) // 1000) AS t FROM events),
g AS (SELECT id, ws, epoch_ms(ws) + 43200000 AS end_ms, min(t) AS first_t, count(*) AS total
      FROM r GROUP BY id, ws),
ticks AS (
  SELECT g.id, g.ws, g.end_ms, tick
  FROM g, LATERAL (SELECT unnest(generate_series((g.first_t // 7200000 + 1) * 7200000,
                                                 g.end_ms - 7200000, 7200000)) AS tick) s)
SELECT t.id, make_timestamp(t.end_ms * 1000) AS window_end, make_timestamp(t.tick * 1000) AS eval_time,
       (SELECT count(*) FROM r WHERE r.id = t.id AND r.ws = t.ws AND r.t <= t.tick) AS cnt
FROM ticks t
UNION ALL
SELECT id, make_timestamp(end_ms * 1000), make_timestamp((end_ms - 1) * 1000), total FROM g""")
def w5_early_firing(spark, sf):
    """O-W5: 12 h windows firing early every 2 h of event time, plus the final
    firing at end - 1 ms."""
    return W.early_firing_counts(_sensors(spark, sf), ["id"], "ts", EARLY_WINDOW, EARLY_TICK)


@register("w6_processing_time", """
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
FROM events GROUP BY ALL""")
def w6_processing_time(spark, sf):
    """O-W6: processing-time window. On a bounded table the arrival clock is
    the ``ts`` column (in a stream: ``processing_time()`` adds it)."""
    w = F.window("ts", "1 hour")
    return events(spark, sf).groupBy("event_type", w.end.alias("window_end")).agg(
        F.count(F.lit(1)).alias("cnt"))


# ------------------------------------------------------- window aggregates ----

_DAY_KEYED = f"user_id AS id, {_DAY} + INTERVAL 1 DAY AS window_end"


@register("g1_window_sum", f"""
SELECT {_DAY_KEYED}, round(sum(value), 6) AS sum_temp FROM events GROUP BY ALL""")
def g1_window_sum(spark, sf):
    """O-G1: windowed sum of a field."""
    w = F.window("ts", TUMBLE)
    return _sensors(spark, sf).groupBy("id", w.end.alias("window_end")).agg(
        r6(F.sum("temperature")).alias("sum_temp"))


@register("g2_window_max_field", f"""
SELECT {_DAY_KEYED}, max(value) AS max_temp, arg_min(ts, event_id) AS ts,
       min(event_id) AS event_id FROM events GROUP BY ALL""")
def g2_window_max_field(spark, sf):
    """O-G2: max of a field; the other fields keep the window's first row."""
    w = F.window("ts", TUMBLE)
    return _sensors(spark, sf).groupBy("id", w.end.alias("window_end")).agg(
        F.max("temperature").alias("max_temp"), *W.first_row_values(["ts", "event_id"], "event_id"))


_ROW_SQL = """
SELECT id, window_end, event_id, ts, temperature FROM (
  SELECT user_id AS id, {day} + INTERVAL 1 DAY AS window_end, event_id, ts, value AS temperature,
         row_number() OVER (PARTITION BY user_id, {day} ORDER BY value DESC, event_id {tie}) AS rn
  FROM events) WHERE rn = 1"""


@register("g3_window_max_row", _ROW_SQL.format(day=_DAY, tie="ASC"))
def g3_window_max_row(spark, sf):
    """O-G3: ``maxBy`` - the whole row with the max value, first row on ties."""
    w = F.window("ts", TUMBLE)
    return (_sensors(spark, sf).groupBy("id", w.end.alias("window_end"))
            .agg(W.max_row("temperature", "event_id", ["event_id", "ts", "temperature"], True)
                 .alias("r"))
            .select("id", "window_end", "r.*"))


@register("g4_window_reduce_max", _ROW_SQL.format(day=_DAY, tie="DESC"))
def g4_window_reduce_max(spark, sf):
    """O-G4: reduce keeping the hotter row, the later row on ties."""
    w = F.window("ts", TUMBLE)
    return (_sensors(spark, sf).groupBy("id", w.end.alias("window_end"))
            .agg(W.max_row("temperature", "event_id", ["event_id", "ts", "temperature"], False)
                 .alias("r"))
            .select("id", "window_end", "r.*"))


@register("g5_window_min", f"SELECT {_DAY_KEYED}, min(value) AS min_temp FROM events GROUP BY ALL")
def g5_window_min(spark, sf):
    """O-G5: reduce to the minimum per window."""
    w = F.window("ts", TUMBLE)
    return _sensors(spark, sf).groupBy("id", w.end.alias("window_end")).agg(
        F.min("temperature").alias("min_temp"))


@register("g6_window_avg", f"""
SELECT user_id AS id, {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end,
       round(avg(value), 6) AS avg_temp FROM events GROUP BY ALL""")
def g6_window_avg(spark, sf):
    """O-G6: average by an incremental (sum, count) accumulator."""
    d = W.tumbling(_sensors(spark, sf), "ts", TUMBLE)
    return d.groupBy("id", "window_start", "window_end").agg(
        r6(F.sum("temperature") / F.count(F.lit(1))).alias("avg_temp"))


@register("g7_window_avg_end", f"""
SELECT user_id AS id, {_DAY} + INTERVAL 1 DAY AS ts, round(avg(value), 6) AS avg_temp
FROM events GROUP BY ALL""")
def g7_window_avg_end(spark, sf):
    """O-G7: average per window; the output timestamp is the window end."""
    w = F.window("ts", TUMBLE)
    return _sensors(spark, sf).groupBy("id", w.end.alias("ts")).agg(
        r6(F.avg("temperature")).alias("avg_temp"))


@register("g8_window_min_max", f"""
SELECT user_id AS id, min(value) AS min_temp, max(value) AS max_temp,
       {_DAY} + INTERVAL 1 DAY AS end_ts FROM events GROUP BY user_id, {_DAY}""")
def g8_window_min_max(spark, sf):
    """O-G8: min and max per window with the window end."""
    w = F.window("ts", TUMBLE)
    return _sensors(spark, sf).groupBy("id", w.end.alias("end_ts")).agg(
        F.min("temperature").alias("min_temp"), F.max("temperature").alias("max_temp"))


@register("g9_sliding_count_end", """
WITH v AS (SELECT ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
           FROM events WHERE event_type = 'view')
SELECT item_id, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 1 DAY - i * INTERVAL 6 HOUR AS window_end,
       count(*) AS view_count
FROM v, range(4) t(i) GROUP BY ALL""")
def g9_sliding_count_end(spark, sf):
    """O-G9: count per item and sliding window, with the window end."""
    v = events(spark, sf).filter(F.col("event_type") == "view").select(
        "ts", item_id().alias("item_id"))
    return W.sliding_agg(v, "ts", SLIDE_SIZE, SLIDE_STEP, ["item_id"], {}, "view_count").drop(
        "window_start")


@register("g13_running_detail", f"""
SELECT user_id AS id,
       count(*) OVER w AS size, first(ts) OVER w AS first_ts, ts,
       {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end
FROM events
WINDOW w AS (PARTITION BY user_id, {_DAY} ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def g13_running_detail(spark, sf):
    """O-G13: per element, the running window size, the first and current ts."""
    return W.running_detail(_sensors(spark, sf), ["id"], "ts", TUMBLE, "event_id")


@register("g14_top_n", f"""
SELECT * FROM (
  SELECT {_DAY} + INTERVAL 1 DAY AS window_end, user_id, round(sum(value), 6) AS spend,
         CAST(row_number() OVER (PARTITION BY {_DAY} ORDER BY sum(value) DESC, user_id) AS INTEGER) AS rank
  FROM events WHERE event_type = 'purchase' GROUP BY {_DAY}, user_id) WHERE rank <= 3""")
def g14_top_n(spark, sf):
    """O-G14: true top-N per window end (top 3 spenders per day)."""
    p = events(spark, sf).filter(F.col("event_type") == "purchase")
    w = F.window("ts", TUMBLE)
    s = p.groupBy(w.end.alias("window_end"), "user_id").agg(F.sum("value").alias("_s"))
    top = W.top_n(s, ["window_end"], [F.desc("_s"), F.asc("user_id")], 3)
    return top.select("window_end", "user_id", r6("_s").alias("spend"), "rank")


@register("e1_avg_sensor", f"""
SELECT user_id AS id, {_DAY} + INTERVAL 1 DAY AS ts,
       round(avg((value - 32) * (5.0 / 9.0)), 6) AS avg_celsius
FROM events GROUP BY ALL""")
def e1_avg_sensor(spark, sf):
    """O-E1: average sensor temperature - Celsius, tumbling window, average
    with the window end as timestamp (input is in time order: no late rows)."""
    d = _sensors(spark, sf).withColumn("celsius", fahrenheit_to_celsius("temperature"))
    w = F.window("ts", TUMBLE)
    return d.groupBy("id", w.end.alias("ts")).agg(r6(F.avg("celsius")).alias("avg_celsius"))
