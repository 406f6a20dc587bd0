"""Record decoders (O-S6, O-S7, O-S8): JSON and delimited text to typed rows.

All decoding is ``from_json`` / ``split`` / ``try_cast`` - JVM-side, vectorised,
and identical for a bounded table and a stream's ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default rows produced when a record cannot be decoded.
EVENT_DEFAULT = {"id": 0, "name": "", "tm": 0}
ROOM_EVENT_DEFAULT = {"v": 0.0, "room": "", "id": 0, "tm": 0}

EVENT_SCHEMA = "id string, name string, tm string"
ROOM_EVENT_SCHEMA = "v string, room string, id string, tm string"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parse_once(df: DataFrame, raw, schema: str, keep: tuple) -> DataFrame:
    """``from_json`` evaluated exactly once per record.

    A filter on decoded fields would otherwise be pushed below the decoding
    projection with ``from_json`` inlined once per referenced field; a
    generator (``inline`` of a one-element array) is a boundary predicate
    pushdown does not cross. Field ``_ok`` is false for unparsable text."""
    one = F.struct(F.from_json(_c(raw), schema).alias("_p"), _c(raw).alias("_raw"))
    return df.select(*keep, F.inline(F.array(one))).withColumn("_ok", F.col("_p").isNotNull())


def _number(field: str, kind: str) -> Column:
    """A number given as such, as text, or with a fraction, which is cut off."""
    return F.expr(f"coalesce(try_cast(trim({field}) as {kind}), "
                  f"try_cast(try_cast(trim({field}) as double) as {kind}))")


def decode_event(df: DataFrame, raw: str, keep: tuple = ()) -> DataFrame:
    """O-S6: JSON text -> (id int, name string, tm bigint).

    Numbers may be quoted or have a fraction. Malformed JSON, or a missing/non-numeric
    id or tm, gives the default row (0, "", 0); a missing name alone stays null."""
    d = _parse_once(df, raw, EVENT_SCHEMA, keep)
    id_, tm = _number("_p.id", "int"), _number("_p.tm", "bigint")
    ok = F.col("_ok") & id_.isNotNull() & tm.isNotNull()
    return d.select(
        *keep,
        F.when(ok, id_).otherwise(F.lit(EVENT_DEFAULT["id"])).alias("id"),
        F.when(ok, F.col("_p.name")).otherwise(F.lit(EVENT_DEFAULT["name"])).alias("name"),
        F.when(ok, tm).otherwise(F.lit(EVENT_DEFAULT["tm"]).cast("bigint")).alias("tm"))


def decode_room_event(df: DataFrame, raw: str, keep: tuple = ()) -> DataFrame:
    """O-S7: JSON text -> (v float, room string, id bigint, tm bigint).

    Fields are read as text: ``v`` missing -> 0.0 (an explicit null is unparsable), ``room`` may be null, ``id``
    and ``tm`` are parsed from text. Malformed JSON or an unparsable or
    missing id/tm/v gives (0.0, "", 0, 0)."""
    d = _parse_once(df, raw, ROOM_EVENT_SCHEMA, keep)
    absent = ~F.coalesce(F.array_contains(F.json_object_keys("_raw"), "v"), F.lit(False))
    v = F.when(F.col("_p.v").isNotNull(), F.expr("try_cast(trim(_p.v) as float)")).when(
        absent, F.lit(0.0).cast("float"))
    idv = F.expr("try_cast(trim(_p.id) as bigint)")
    tmv = F.expr("try_cast(trim(_p.tm) as bigint)")
    d = d.select(*keep, "_ok", F.col("_p.room").alias("_room"), v.alias("_v"),
                 idv.alias("_id"), tmv.alias("_tm"))
    ok = F.col("_ok") & F.col("_id").isNotNull() & F.col("_tm").isNotNull() & F.col("_v").isNotNull()
    return d.select(
        *keep,
        F.when(ok, F.col("_v")).otherwise(F.lit(ROOM_EVENT_DEFAULT["v"]).cast("float")).alias("v"),
        F.when(ok, F.col("_room")).otherwise(F.lit(ROOM_EVENT_DEFAULT["room"])).alias("room"),
        F.when(ok, F.col("_id")).otherwise(F.lit(ROOM_EVENT_DEFAULT["id"]).cast("bigint")).alias("id"),
        F.when(ok, F.col("_tm")).otherwise(F.lit(ROOM_EVENT_DEFAULT["tm"]).cast("bigint")).alias("tm"))


def parse_code_time(df: DataFrame, line: str, fmt: str = "yyyy-MM-dd HH:mm:ss",
                    keep: tuple = ()) -> DataFrame:
    """O-S8: ``"code,<fmt>"`` lines -> (code, epoch ms); empty lines dropped."""
    parts = F.split(_c(line), ",")
    return (df.filter(_c(line) != "")
              .select(*keep, parts[0].alias("code"),
                      F.unix_millis(F.to_timestamp(parts[1], fmt)).alias("tm")))


def parse_stock(df: DataFrame, line: str, keep: tuple = ()) -> DataFrame:
    """O-S8: ``"price, volume"`` -> (price int, volume int), fields trimmed."""
    parts = F.split(_c(line), ",")
    return df.select(*keep, F.trim(parts[0]).cast("int").alias("price"),
                     F.trim(parts[1]).cast("int").alias("volume"))
