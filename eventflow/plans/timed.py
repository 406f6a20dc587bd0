"""Registered event-time, join and keyed-state queries (O-M*, O-J1..J4,
O-A2/A3/A5/A6, O-P*, O-E13..E15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventflow.functions.scalar import fahrenheit_to_celsius, format_message, iso_local
from eventflow.operators import eventtime as T
from eventflow.operators import joins as J
from eventflow.operators import keyed as K
from eventflow.plans.common import (FIRE_ALERT, FREEZING_ALARM, LATE_DELAY, LATE_LATENESS,
                                    LATE_WINDOW, ROOM_PREFIX, SPLIT_DELAY, TUMBLE, UNKNOWN_ROOM,
                                    events, out_of_order, r6, sensors)
from eventflow.operators.scan import time_bounds
from eventflow.plans.registry import register
from eventflow.sinks.upsert import latest_per_key

# Fixed values (test bindings, see SURVEY 7.3).
ALERT_THRESHOLD = 50.0
HIGH_TEMP = 100.0
INSTANCES = 4
TTL = "1 day"
RISE_INTERVAL = "6 hours"
COUNT_TIMEOUT = "12 hours"
LOOKUP_MAX_SENSOR = 80
DASHBOARD_IDS = [1, 2, 3, 4, 5]

_EV2 = "ev2 AS (SELECT *, ts + to_seconds((event_id * 7919) % 25200) AS ts2 FROM events)"


def _wm_sql(delay_us: int, marker: str | None = None) -> str:
    v = "epoch_us(ts2)" if marker is None else f"CASE WHEN {marker} THEN epoch_us(ts2) END"
    return (f"wmq AS (SELECT *, max({v}) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING) - {delay_us} AS wm_us FROM ev2)")


def _ooo(spark, sf):
    return out_of_order(events(spark, sf))


def _wm_query(spark, sf, delay, marker=None):
    d = T.with_watermark_column(_ooo(spark, sf), "ts2", "event_id", delay, "wm",
                                marker=marker)
    return d.select("event_id", "ts2", "wm")


def _wm_oracle(delay_us, marker=None):
    return (f"WITH {_EV2}, {_wm_sql(delay_us, marker)} "
            f"SELECT event_id, ts2, make_timestamp(wm_us) AS wm FROM wmq")


# ------------------------------------------------------------ watermarks ----

@register("m1_bounded_watermark", _wm_oracle(5 * 3600 * 10**6))
def m1_bounded_watermark(spark, sf):
    """O-M1: bounded out-of-orderness watermark (max event time - 5 h)."""
    return _wm_query(spark, sf, SPLIT_DELAY)


@register("m2_periodic_watermark", _wm_oracle(3600 * 10**6))
def m2_periodic_watermark(spark, sf):
    """O-M2: periodic assigner, max event time - 1 h."""
    return _wm_query(spark, sf, LATE_DELAY)


@register("m3_punctuated_watermark", _wm_oracle(3600 * 10**6, "user_id = 1"))
def m3_punctuated_watermark(spark, sf):
    """O-M3: punctuated - only marker rows (sensor 1) advance the watermark."""
    return _wm_query(spark, sf, LATE_DELAY, marker=F.col("user_id") == 1)


@register("m4_ascending_watermark", """
SELECT event_id, ts, make_timestamp(max(epoch_us(ts)) OVER (ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS wm FROM events""")
def m4_ascending_watermark(spark, sf):
    """O-M4: ascending timestamps - zero delay on the in-order ``ts``."""
    d = T.with_watermark_column(events(spark, sf), "ts", "event_id", "0 seconds", "wm")
    return d.select("event_id", "ts", "wm")


@register("m5_every_row_watermark", _wm_oracle(5000))
def m5_every_row_watermark(spark, sf):
    """O-M5: punctuated on every row, event time - 5 ms."""
    return _wm_query(spark, sf, "5 milliseconds")


@register("m6_late_split", f"""
WITH {_EV2}, {_wm_sql(5 * 3600 * 10**6)}
SELECT event_id, ts2, make_timestamp(wm_us) AS wm,
       CASE WHEN epoch_us(ts2) < wm_us THEN 'late' ELSE 'main' END AS output FROM wmq""")
def m6_late_split(spark, sf):
    """O-M6: rows older than the current watermark go to the late output."""
    d = T.with_watermark_column(_ooo(spark, sf), "ts2", "event_id", SPLIT_DELAY, "wm")
    output = F.when(T.late_flag("ts2"), "late").otherwise("main")
    return d.select("event_id", "ts2", "wm", output.alias("output"))


_LATE_BASE = f"""{_EV2}, {_wm_sql(3600 * 10**6)},
f AS (SELECT event_id, user_id AS id, ts2, wm_us,
             time_bucket(INTERVAL 1 HOUR, ts2) + INTERVAL 1 HOUR AS window_end FROM wmq),
g AS (SELECT *, epoch_us(window_end) - 1000 AS e_us FROM f)"""


@register("m7_window_counts", f"""
WITH {_LATE_BASE}
SELECT id, window_end, count(*) AS cnt FROM g
WHERE NOT coalesce(e_us <= wm_us, false) GROUP BY id, window_end""")
def m7_window_counts(spark, sf):
    """O-M7: per-window count of on-time rows (late rows are redirected)."""
    d = T.with_watermark_column(_ooo(spark, sf).withColumnRenamed("user_id", "id"),
                                "ts2", "event_id", LATE_DELAY, "wm")
    counts, _ = T.window_count_with_late(d, ["id"], "ts2", LATE_WINDOW)
    return counts


@register("m7_late_rows", f"""
WITH {_LATE_BASE}
SELECT event_id, id, ts2 FROM g WHERE coalesce(e_us <= wm_us, false)""")
def m7_late_rows(spark, sf):
    """O-M7: the side output of rows too late for their window."""
    d = T.with_watermark_column(_ooo(spark, sf).withColumnRenamed("user_id", "id"),
                                "ts2", "event_id", LATE_DELAY, "wm")
    _, late = T.window_count_with_late(d, ["id"], "ts2", LATE_WINDOW)
    return late.select("event_id", "id", "ts2")


@register("m8_allowed_lateness", f"""
WITH {_LATE_BASE},
h AS (SELECT *, (wm_us IS NULL OR wm_us < e_us) AS on_time,
             (wm_us >= e_us AND wm_us < e_us + 7200000000) AS late_ok FROM g),
k AS (SELECT * FROM h WHERE on_time OR late_ok),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id, window_end ORDER BY event_id) AS rn FROM k)
SELECT id, window_end, count(*) AS cnt, 'first' AS kind FROM k WHERE on_time GROUP BY id, window_end
UNION ALL
SELECT id, window_end, rn AS cnt, CASE WHEN rn = 1 THEN 'first' ELSE 'update' END AS kind
FROM ranked WHERE late_ok""")
def m8_allowed_lateness(spark, sf):
    """O-M8: allowed lateness 2 h on 1 h windows: a first result, then one
    update per accepted late row; rows later than that are dropped."""
    base = _ooo(spark, sf).withColumnRenamed("user_id", "id")
    d = T.with_watermark_column(base, "ts2", "event_id", LATE_DELAY, "wm")
    return T.allowed_lateness_counts(d, ["id"], "ts2", LATE_WINDOW, LATE_LATENESS, "event_id")


@register("m9_side_output", """
SELECT 'main' AS output, event_id, user_id AS id, ts, value AS temperature, NULL AS message FROM events
UNION ALL
SELECT 'side', event_id, user_id, ts, value, 'Freezing Alarm for ' || user_id FROM events WHERE value < 32.0""")
def m9_side_output(spark, sf):
    """O-M9: readings below 32 F also raise an alarm on a side output; all
    rows continue on the main output. Both outputs, told apart by a column."""
    main, side = T.side_outputs(sensors(events(spark, sf)), F.col("temperature") < 32.0)
    cols = ["event_id", "id", "ts", "temperature"]
    return (main.select(F.lit("main").alias("output"), *cols, F.lit(None).cast("string").alias("message"))
            .unionByName(side.select(F.lit("side").alias("output"), *cols,
                                     format_message(FREEZING_ALARM, "id").alias("message"))))


# ----------------------------------------------------------------- joins ----

@register("j1_asof_alert", """
WITH c AS (SELECT ts, arg_max(CASE WHEN value > 50 THEN 'High' ELSE 'Low' END, event_id) AS level
           FROM events WHERE event_type = 'error' GROUP BY ts),
r AS (SELECT event_id, user_id AS id, ts, value AS temperature FROM events
      WHERE event_type <> 'error' AND value > 100)
SELECT r.event_id, r.id, r.ts, r.temperature,
       'Risk of fire!, the temperature is: ' || CAST(r.temperature AS VARCHAR) AS message
FROM r ASOF LEFT JOIN c ON r.ts >= c.ts
WHERE coalesce(c.level, 'Low') = 'High'""")
def j1_asof_alert(spark, sf):
    """O-J1: latest smoke level (initially Low) as of each reading; alert when
    High and temperature > 100. Controls are not keyed: a time-bucketed scan
    replaces the broadcast state."""
    ev = events(spark, sf)
    smoke = ev.filter(F.col("event_type") == "error").select(
        "event_id", "ts", F.when(F.col("value") > 50, "High").otherwise("Low").alias("level"))
    readings = sensors(ev.filter(F.col("event_type") != "error")).filter(
        F.col("temperature") > HIGH_TEMP)
    d = J.asof_join(readings, smoke, "ts", ["level"], tie="event_id")
    return (d.filter(F.coalesce("level", F.lit("Low")) == "High")
             .select("event_id", "id", "ts", "temperature",
                     F.concat(F.lit(FIRE_ALERT),
                              F.col("temperature").cast("string")).alias("message")))


@register("j2_threshold_alert", """
WITH t AS (SELECT user_id AS id, ts,
                  arg_max(CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END, event_id) AS threshold
           FROM events WHERE event_type = 'signup' GROUP BY user_id, ts),
r AS (SELECT event_id, user_id AS id, ts, value AS temperature,
             coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS last_temp
      FROM events WHERE event_type <> 'signup')
SELECT r.id, r.ts, r.temperature, round(abs(r.temperature - r.last_temp), 6) AS diff
FROM r ASOF LEFT JOIN t ON r.id = t.id AND r.ts >= t.ts
WHERE t.threshold IS NOT NULL AND t.threshold <> 0.0 AND abs(r.temperature - r.last_temp) > t.threshold""")
def j2_threshold_alert(spark, sf):
    """O-J2: per-sensor thresholds (0 deletes) as of each reading; alert when
    |temperature - last temperature| exceeds the threshold in force."""
    ev = events(spark, sf)
    thr = ev.filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("id"), "ts", "event_id",
        F.when(F.pmod("event_id", F.lit(4)) == 0, F.lit(0.0)).otherwise(F.col("value"))
        .alias("threshold"))
    readings = sensors(ev.filter(F.col("event_type") != "signup"))
    # One set of time buckets from the base events serves both scans.
    bounds = time_bounds(ev, T.epoch_us("ts"))
    readings = K.previous_value(readings, "id", "ts", "temperature", "event_id", out="last_temp",
                                bounds=bounds)
    d = J.asof_join(readings, thr, "ts", ["threshold"], keys=("id",), tie="event_id", bounds=bounds)
    diff = F.abs(F.col("temperature") - F.coalesce("last_temp", F.lit(0.0)))
    return (d.filter(F.col("threshold").isNotNull() & (F.col("threshold") != 0.0)
                     & (diff > F.col("threshold")))
             .select("id", "ts", "temperature", r6(diff).alias("diff")))


@register("j3_interval_forward", """
WITH s AS (SELECT user_id AS id, ts,
                  make_timestamp(epoch_us(ts) + CAST(round(value * 3600000000) AS BIGINT)) AS until
           FROM events WHERE event_type = 'signup'),
r AS (SELECT event_id, user_id AS id, ts, value AS temperature FROM events WHERE event_type = 'purchase')
SELECT * FROM r WHERE EXISTS (SELECT 1 FROM s WHERE s.id = r.id AND s.ts <= r.ts AND r.ts < s.until)""")
def j3_interval_forward(spark, sf):
    """O-J3: a switch (signup) forwards that sensor's readings (purchases) for
    ``value`` hours; overlapping switches extend to the later deadline."""
    ev = events(spark, sf)
    sw = ev.filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("id"), "ts",
        F.timestamp_micros(T.epoch_us("ts") + F.round(F.col("value") * 3.6e9).cast("bigint"))
        .cast("timestamp_ntz").alias("until"))
    readings = sensors(ev.filter(F.col("event_type") == "purchase"))
    return J.interval_semi_join(readings, sw, ["id"], "ts", "until",
                                bounds=time_bounds(ev, T.epoch_us("ts")))


@register("j4_lookup_enrich", f"""
WITH lk AS (SELECT DISTINCT user_id, 'room_' || (user_id % 10) AS room FROM events
            WHERE user_id BETWEEN 1 AND {LOOKUP_MAX_SENSOR})
SELECT e.event_id, e.user_id AS id, coalesce(lk.room, 'UNKNOWN ROOM') AS room
FROM events e LEFT JOIN lk USING (user_id)""")
def j4_lookup_enrich(spark, sf):
    """O-J4: enrich readings with a room from a keyed lookup, 'UNKNOWN ROOM'
    for missing keys (one bulk join instead of per-row requests)."""
    ev = events(spark, sf)
    lookup = (ev.filter(F.col("user_id").between(1, LOOKUP_MAX_SENSOR)).select("user_id").distinct()
                .withColumn("room", F.concat(F.lit(ROOM_PREFIX),
                                             F.pmod("user_id", F.lit(10)).cast("string"))))
    d = J.lookup_enrich(ev.select("event_id", "user_id"), lookup, "user_id", "room",
                        UNKNOWN_ROOM)
    return d.select("event_id", F.col("user_id").alias("id"), "room")


# ------------------------------------------------- keyed running state ----

_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@register("a2_rolling_sum", f"""
SELECT event_id, user_id AS id, round(sum(value) OVER w, 6) AS running_sum,
       first_value(event_type) OVER w AS event_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id {_RUN})""")
def a2_rolling_sum(spark, sf):
    """O-A2: ``keyBy(id).sum(value)`` - running sum per row; other fields keep
    the key's first row."""
    d = events(spark, sf).select("event_id", F.col("user_id").alias("id"), "value", "event_type")
    d = K.rolling_sum(d, "id", "value", "event_id", ["event_type"])
    return d.select("event_id", "id", r6("running_sum").alias("running_sum"), "event_type")


@register("a3_running_count", f"""
SELECT event_id, user_id AS id, count(*) OVER (PARTITION BY user_id ORDER BY event_id {_RUN}) AS cnt
FROM events""")
def a3_running_count(spark, sf):
    """O-A3: running count per key, emitted per row."""
    d = events(spark, sf).select("event_id", F.col("user_id").alias("id"))
    return K.running_count(d, "id", "event_id").withColumn("cnt", F.col("cnt").cast("bigint"))


@register("a5_threshold_counters", f"""
SELECT event_id, user_id AS id, user_id % {INSTANCES} AS instance,
       count(*) OVER (PARTITION BY user_id ORDER BY event_id {_RUN}) AS key_cnt,
       count(*) OVER (PARTITION BY user_id % {INSTANCES} ORDER BY event_id {_RUN}) AS op_cnt
FROM events WHERE value > {HIGH_TEMP}""")
def a5_threshold_counters(spark, sf):
    """O-A5: running high-temperature count per key and per instance."""
    d = sensors(events(spark, sf))
    d = K.threshold_counters(d, "id", "temperature", "event_id", HIGH_TEMP, INSTANCES)
    return d.select("event_id", "id", "instance", F.col("key_cnt").cast("bigint").alias("key_cnt"),
                    F.col("op_cnt").cast("bigint").alias("op_cnt"))


@register("a6_instance_counters", f"""
SELECT event_id, user_id % {INSTANCES} AS instance,
       count(*) OVER (PARTITION BY user_id % {INSTANCES} ORDER BY event_id {_RUN}) AS cnt
FROM events WHERE value > {HIGH_TEMP}""")
def a6_instance_counters(spark, sf):
    """O-A6: counter per (deterministic) instance bucket."""
    d = K.instance_counters(sensors(events(spark, sf)), "id", "temperature", "event_id",
                            HIGH_TEMP, INSTANCES)
    return d.select("event_id", "instance", F.col("cnt").cast("bigint").alias("cnt"))


@register("p1_delta_alert", f"""
SELECT id, ts, temperature, round(d, 6) AS diff FROM (
  SELECT user_id AS id, ts, value AS temperature,
         abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS d FROM events)
WHERE d > {ALERT_THRESHOLD}""")
def p1_delta_alert(spark, sf):
    """O-P1: |temperature - previous| > 50 (first reading never alerts)."""
    d = K.delta_alert(sensors(events(spark, sf)), "id", "ts", "temperature", ALERT_THRESHOLD,
                      tie="event_id")
    return d.withColumn("diff", r6("diff"))


@register("p2_self_cleaning_alert", f"""
SELECT id, ts, temperature, round(d, 6) AS diff FROM (
  SELECT id, ts, temperature,
         abs(temperature - CASE WHEN prev_ts IS NOT NULL AND ts - prev_ts < INTERVAL 1 DAY
                                THEN prev ELSE 0.0 END) AS d
  FROM (SELECT user_id AS id, ts, value AS temperature,
               lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
               lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events))
WHERE d > {ALERT_THRESHOLD}""")
def p2_self_cleaning_alert(spark, sf):
    """O-P2: delta alert whose state is cleared 1 day after a key's last
    reading; an empty state reads as 0.0."""
    d = K.self_cleaning_delta_alert(sensors(events(spark, sf)), "id", "ts", "temperature",
                                    ALERT_THRESHOLD, TTL, tie="event_id")
    return d.withColumn("diff", r6("diff"))


@register("p3_rise_alert", """
WITH RECURSIVE
r AS (SELECT user_id AS id, epoch_us(ts) AS o, event_id, value AS v,
             lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, (prev IS NULL OR v < prev OR prev = 0.0) AS is_reset FROM r),
g AS (SELECT *, sum(CASE WHEN is_reset THEN 1 ELSE 0 END) OVER
                (PARTITION BY id ORDER BY o, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
runs AS (SELECT id, run, min(o) AS run_start FROM g GROUP BY id, run),
run_end AS (SELECT a.id, a.run, b.run_start AS next_reset FROM runs a
            LEFT JOIN runs b ON a.id = b.id AND b.run = a.run + 1),
rises AS (SELECT id, run, o FROM g WHERE NOT is_reset AND v > prev),
chain(id, run, fire) AS (
  SELECT id, run, min(o) + 21600000000 FROM rises GROUP BY id, run
  UNION ALL
  SELECT c.id, c.run, n.nxt + 21600000000 FROM chain c,
         LATERAL (SELECT min(x.o) AS nxt FROM rises x
                  WHERE x.id = c.id AND x.run = c.run AND x.o >= c.fire) n
  WHERE n.nxt IS NOT NULL)
SELECT c.id, make_timestamp(c.fire) AS alert_ts FROM chain c JOIN run_end e USING (id, run)
WHERE e.next_reset IS NULL OR e.next_reset >= c.fire""")
def p3_rise_alert(spark, sf):
    """O-P3: alert when a sensor's temperature rose monotonically for 6 h;
    a decrease cancels, a firing re-arms at the next rise."""
    return K.rise_alerts(sensors(events(spark, sf)), "id", "ts", "temperature", RISE_INTERVAL,
                         tie="event_id")


@register("p4_count_timeout", f"""
SELECT id, cnt, ts + INTERVAL 12 HOUR AS emit_ts FROM (
  SELECT user_id AS id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id {_RUN}) AS cnt,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
WHERE nxt IS NULL OR epoch_us(nxt) - epoch_us(ts) > 43200000000""")
def p4_count_timeout(spark, sf):
    """O-P4: running count per key, emitted 12 h after a key's last row if no
    newer row came (count not reset)."""
    return K.count_with_timeout(sensors(events(spark, sf)), "id", "ts", COUNT_TIMEOUT,
                                tie="event_id")


def _window_max(spark, sf):
    w = F.window("ts", TUMBLE)
    return sensors(events(spark, sf)).groupBy("id", w.end.alias("window_end")).agg(
        F.max("temperature").alias("max_temp"))


_LATEST_MAX_SQL = """
latest AS (SELECT user_id AS id, max(time_bucket(INTERVAL 1 DAY, ts)) + INTERVAL 1 DAY AS window_end
           FROM events GROUP BY user_id),
latest_max AS (SELECT l.id, l.window_end, max(e.value) AS max_temp FROM latest l
               JOIN events e ON e.user_id = l.id
                AND time_bucket(INTERVAL 1 DAY, e.ts) + INTERVAL 1 DAY = l.window_end
               GROUP BY l.id, l.window_end)"""


@register("p5_latest_max", f"WITH {_LATEST_MAX_SQL} SELECT * FROM latest_max")
def p5_latest_max(spark, sf):
    """O-P5: keyed 'latest' table of the windowed max (last write per key)."""
    return latest_per_key(_window_max(spark, sf), ["id"], ["window_end"])


@register("p5_dashboard", f"""WITH {_LATEST_MAX_SQL}
SELECT {", ".join(f"max(CASE WHEN id = {i} THEN max_temp END) AS sensor_{i}" for i in DASHBOARD_IDS)}
FROM latest_max""")
def p5_dashboard(spark, sf):
    """O-P5: point queries for sensors 1..5 shown as one row, one column per key."""
    latest = latest_per_key(_window_max(spark, sf), ["id"], ["window_end"])
    p = (latest.filter(F.col("id").isin(DASHBOARD_IDS)).groupBy()
               .pivot("id", DASHBOARD_IDS).agg(F.first("max_temp")))
    return p.select(*[F.col(str(i)).alias(f"sensor_{i}") for i in DASHBOARD_IDS])


# ------------------------------------------------------------------ jobs ----

@register("e13_max_temp_tracker", """
SELECT user_id AS id, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       max(value) AS max_temp FROM events GROUP BY ALL""")
def e13_max_temp_tracker(spark, sf):
    """O-E13: projection, tumbling window max per sensor (the stream that
    feeds the keyed latest-value table of O-P5)."""
    return _window_max(spark, sf)


@register("e14_global_avg", """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS window_end,
       round(avg(value), 6) AS avg_temp FROM events GROUP BY ALL""")
def e14_global_avg(spark, sf):
    """O-E14: global per-window average with the window end as ISO local
    date-time - the rows handed to the exactly-once / write-ahead sinks."""
    w = F.window("ts", TUMBLE)
    return (events(spark, sf).groupBy(w.end.alias("_end"))
            .agg(r6(F.avg("value")).alias("avg_temp"))
            .select(iso_local("_end").alias("window_end"), "avg_temp"))


@register("e15_celsius_upsert", """
SELECT user_id AS id, round(arg_max((value - 32) * (5.0 / 9.0), (ts, event_id)), 6) AS temp_c
FROM events GROUP BY user_id""")
def e15_celsius_upsert(spark, sf):
    """O-E15: readings to Celsius, upserted by sensor: the final keyed table
    holds the last write per sensor."""
    d = sensors(events(spark, sf)).withColumn("temp_c", fahrenheit_to_celsius("temperature"))
    latest = latest_per_key(d.select("id", "ts", "event_id", "temp_c"), ["id"], ["ts", "event_id"])
    return latest.select("id", r6("temp_c").alias("temp_c"))
