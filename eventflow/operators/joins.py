"""Control-stream joins and lookups (O-J1 .. O-J6).

As-of and interval joins are expressed as one ordered scan over the union of
both inputs (controls sort before readings on equal time), bucketed in time so
that neither a hot key nor a global (unkeyed) control stream forces a
single-task sort. No range-join nested loops, no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.operators.eventtime import epoch_us
from eventflow.operators.scan import scan, time_bounds, with_time_bucket


def asof_join(left: DataFrame, right: DataFrame, ts: str, right_cols: list,
              keys: tuple = (), tie: str | None = None, bounds: list | None = None) -> DataFrame:
    """Left rows with the latest right row at or before their ``ts`` (same
    keys); right rows win ties on ``ts``. ``right_cols`` come back null when
    no right row precedes. ``tie`` is an order column present in both inputs: of several
    right rows at one instant the last by ``tie`` counts. ``bounds``: time buckets
    found before (see ``scan.time_bounds``).
    """
    keys = list(keys)
    extra = [tie] if tie else []
    r_struct = F.struct(*[F.col(c) for c in right_cols])
    r = right.select(*keys, ts, *extra, F.lit(0).alias("_side"), r_struct.alias("_r"))
    l = left.withColumn("_side", F.lit(1)).withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))
    u = l.unionByName(r, allowMissingColumns=True).withColumn("_o", epoch_us(ts))
    bounds = time_bounds(u, F.col("_o")) if bounds is None else bounds
    u = scan(with_time_bucket(u, F.col("_o"), bounds, "_bk"), [("_r", "last", "_m")],
             ["_o", "_side", *extra], F.col("_bk"), keys, buckets=len(bounds) + 1)
    out = u.filter(F.col("_side") == 1).drop("_side", "_r", "_o", "_bk")
    return out.select(*[c for c in out.columns if c != "_m"],
                      *[F.col("_m")[c].alias(c) for c in right_cols])


def interval_semi_join(left: DataFrame, right: DataFrame, keys: list, ts: str,
                       until: str, bounds: list | None = None) -> DataFrame:
    """O-J3: left rows with some right row of the same key such that
    ``right.ts <= left.ts < right.until``. Computed as: the max ``until`` over
    right rows at or before the left row is later than the left row.
    """
    l = left.withColumn("_side", F.lit(1)).withColumn("_until", F.lit(None).cast("bigint"))
    r = right.select(*keys, ts, F.lit(0).alias("_side"), epoch_us(until).alias("_until"))
    u = l.unionByName(r, allowMissingColumns=True).withColumn("_o", epoch_us(ts))
    bounds = time_bounds(u, F.col("_o")) if bounds is None else bounds
    u = scan(with_time_bucket(u, F.col("_o"), bounds, "_bk"), [("_until", "max", "_deadline")],
             ["_o", "_side"], F.col("_bk"), keys, buckets=len(bounds) + 1)
    return (u.filter((F.col("_side") == 1) & (F.col("_deadline") > F.col("_o")))
             .drop("_side", "_until", "_o", "_deadline", "_bk"))


def lookup_enrich(df: DataFrame, lookup: DataFrame, key: str, value: str,
                  default: str) -> DataFrame:
    """O-J4: enrich each row from a keyed lookup table, ``default`` when the
    key is missing. One bulk left join replaces per-row requests; Spark broadcasts
    the lookup side by its size in bytes, or not. Of several lookup rows of a key the
    one with the least value counts, so no row is multiplied."""
    lk = lookup.groupBy(key).agg(F.min(value).alias(value))
    return (df.join(lk, key, "left")
              .withColumn(value, F.coalesce(F.col(value), F.lit(default))))
