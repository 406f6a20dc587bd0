"""Shared bindings of the reference's streams onto the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.sources.tables import events, item_id, out_of_order, table  # noqa: F401

# Durations chosen for the test data (30 days of events, a
# median gap per user of ~7 h); the reference's seconds scale to hours/days.
TUMBLE = "1 day"
SLIDE_SIZE, SLIDE_STEP = "1 day", "6 hours"
CUSTOM_SIZE = "12 hours"
EARLY_WINDOW, EARLY_TICK = "12 hours", "2 hours"
LATE_DELAY, LATE_WINDOW, LATE_LATENESS = "1 hour", "1 hour", "2 hours"
SPLIT_DELAY = "5 hours"
ROUND = 6

# Message texts and defaults the reference's jobs emit.
FIRE_ALERT = "Risk of fire!, the temperature is: "
FREEZING_ALARM = "Freezing Alarm for %s"
UNKNOWN_ROOM = "UNKNOWN ROOM"
ROOM_PREFIX = "room_"


def sensors(ev: DataFrame) -> DataFrame:
    """Sensor readings: id = user_id, temperature = value, timestamp = ts."""
    return ev.select("event_id", F.col("user_id").alias("id"), "ts",
                     F.col("value").alias("temperature"))


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND)


# ------------------------------------------------------------------------
# Derived JSON streams (O-S6 / O-S7 inputs). Every 10th record is broken;
# some records miss fields. Built identically in Spark and in the oracle SQL.

def event_json(ev: DataFrame) -> DataFrame:
    """(event_id, raw) - JSON records of (id, name, tm) derived from events."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    uid = F.col("user_id").cast("string")
    et = F.col("event_type")
    raw = (F.when(F.col("event_id") % 10 == 9,
                  F.concat(F.lit('{"id": '), uid, F.lit(', "name": "'), et, F.lit('", "tm": '), ms))
            .when(et == "signup", F.concat(F.lit('{"id": '), uid, F.lit(', "tm": '), ms, F.lit("}")))
            .when((et == "error") & (F.col("value") > 40),
                  F.concat(F.lit('{"id": '), uid, F.lit(', "name": "'), et, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"id": '), uid, F.lit(', "name": "'), et,
                                F.lit('", "tm": '), ms, F.lit("}"))))
    return ev.select("event_id", raw.alias("raw"))


EVENT_JSON_SQL = """
event_json AS (
  SELECT event_id, CASE
    WHEN event_id % 10 = 9 THEN '{"id": ' || user_id || ', "name": "' || event_type || '", "tm": ' || (epoch_us(ts) // 1000)
    WHEN event_type = 'signup' THEN '{"id": ' || user_id || ', "tm": ' || (epoch_us(ts) // 1000) || '}'
    WHEN event_type = 'error' AND value > 40 THEN '{"id": ' || user_id || ', "name": "' || event_type || '"}'
    ELSE '{"id": ' || user_id || ', "name": "' || event_type || '", "tm": ' || (epoch_us(ts) // 1000) || '}'
  END AS raw FROM events),
valid AS (SELECT event_id, CASE WHEN json_valid(raw) THEN raw END AS raw FROM event_json),
decoded AS (
  SELECT event_id,
         raw IS NOT NULL AND (raw::JSON->>'id') IS NOT NULL AND (raw::JSON->>'tm') IS NOT NULL AS ok,
         raw FROM valid),
event_data AS (
  SELECT event_id,
         CASE WHEN ok THEN CAST(raw::JSON->>'id' AS INTEGER) ELSE 0 END AS id,
         CASE WHEN ok THEN raw::JSON->>'name' ELSE '' END AS name,
         CASE WHEN ok THEN CAST(raw::JSON->>'tm' AS BIGINT) ELSE CAST(0 AS BIGINT) END AS tm
  FROM decoded)"""


def room_json(ev: DataFrame) -> DataFrame:
    """(event_id, raw) - JSON records of (v, room, id, tm) with text fields."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    uid = F.col("user_id").cast("string")
    v = F.col("value").cast("string")
    et = F.col("event_type")
    full = F.concat(F.lit('{"v": "'), v, F.lit('", "room": "'), et, F.lit('", "id": "'), uid,
                    F.lit('", "tm": "'), ms, F.lit('"}'))
    raw = (F.when(F.col("event_id") % 10 == 3,
                  F.concat(F.lit('{"v": "'), v, F.lit('", "room": "'), et))
            .when(et == "view", F.concat(F.lit('{"room": "'), et, F.lit('", "id": "'), uid,
                                         F.lit('", "tm": "'), ms, F.lit('"}')))
            .when(et == "click", F.concat(F.lit('{"v": "'), v, F.lit('", "id": "'), uid,
                                          F.lit('", "tm": "'), ms, F.lit('"}')))
            .when((et == "error") & (F.col("value") > 45),
                  F.concat(F.lit('{"v": "'), v, F.lit('", "room": "'), et, F.lit('", "id": "u'),
                           uid, F.lit('", "tm": "'), ms, F.lit('"}')))
            .otherwise(full))
    return ev.select("event_id", raw.alias("raw"))


ROOM_JSON_SQL = """
room_json AS (
  SELECT event_id, CASE
    WHEN event_id % 10 = 3 THEN '{"v": "' || CAST(value AS VARCHAR) || '", "room": "' || event_type
    WHEN event_type = 'view' THEN '{"room": "' || event_type || '", "id": "' || user_id || '", "tm": "' || (epoch_us(ts) // 1000) || '"}'
    WHEN event_type = 'click' THEN '{"v": "' || CAST(value AS VARCHAR) || '", "id": "' || user_id || '", "tm": "' || (epoch_us(ts) // 1000) || '"}'
    WHEN event_type = 'error' AND value > 45 THEN '{"v": "' || CAST(value AS VARCHAR) || '", "room": "' || event_type || '", "id": "u' || user_id || '", "tm": "' || (epoch_us(ts) // 1000) || '"}'
    ELSE '{"v": "' || CAST(value AS VARCHAR) || '", "room": "' || event_type || '", "id": "' || user_id || '", "tm": "' || (epoch_us(ts) // 1000) || '"}'
  END AS raw FROM events),
room_valid AS (SELECT event_id, CASE WHEN json_valid(raw) THEN raw END AS raw FROM room_json),
room_parsed AS (
  SELECT event_id, raw,
         CASE WHEN raw IS NOT NULL THEN
              CASE WHEN (raw::JSON->>'v') IS NULL THEN CAST(0.0 AS FLOAT)
                   ELSE TRY_CAST(trim(raw::JSON->>'v') AS FLOAT) END END AS v0,
         TRY_CAST(trim(raw::JSON->>'id') AS BIGINT) AS id0,
         TRY_CAST(trim(raw::JSON->>'tm') AS BIGINT) AS tm0,
         raw::JSON->>'room' AS room0
  FROM room_valid),
room_event AS (
  SELECT event_id,
         CASE WHEN ok THEN v0 ELSE CAST(0.0 AS FLOAT) END AS v,
         CASE WHEN ok THEN room0 ELSE '' END AS room,
         CASE WHEN ok THEN id0 ELSE CAST(0 AS BIGINT) END AS id,
         CASE WHEN ok THEN tm0 ELSE CAST(0 AS BIGINT) END AS tm
  FROM (SELECT *, (v0 IS NOT NULL AND id0 IS NOT NULL AND tm0 IS NOT NULL) AS ok FROM room_parsed))"""
