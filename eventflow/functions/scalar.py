"""Scalar column functions (stay JVM-side; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fahrenheit_to_celsius(c) -> Column:
    """O-R1: ``(t - 32) * (5.0 / 9.0)``."""
    return (_c(c) - F.lit(32)) * (F.lit(5.0) / F.lit(9.0))


def epoch_ms(c) -> Column:
    """Epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column (session TZ
    is UTC, so the cast to TIMESTAMP is the identity)."""
    return F.unix_millis(_c(c).cast("timestamp"))


def from_epoch_ms(c) -> Column:
    return F.timestamp_millis(_c(c)).cast("timestamp_ntz")


def iso_local(c) -> Column:
    """O-R10: ISO local date-time (``yyyy-MM-dd'T'HH:mm:ss``) of a whole-second
    timestamp such as a window bound."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss")


def clamp_future(ts, now, move_ms: int) -> Column:
    """O-R12: an event time more than ``move_ms`` ahead of ``now`` becomes
    ``now``. ``now`` is passed in (a literal or column) for determinism."""
    ts = _c(ts)
    now = _c(now) if not isinstance(now, (int,)) else F.lit(now)
    return F.when(ts > now + F.lit(move_ms), now).otherwise(ts)


def format_message(fmt: str, *cols) -> Column:
    """O-R13: printf-style message formatting."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def json_object(*pairs) -> Column:
    """O-R9: JSON-encode named columns: ``json_object(("count", c), ...)``."""
    return F.to_json(F.struct(*[_c(c).alias(n) for n, c in pairs]))


def _json_value(c) -> Column:
    """JSON text of one value (``null`` when null)."""
    s = F.to_json(F.struct(_c(c).alias("x")))
    return F.coalesce(F.nullif(F.regexp_extract(s, r'^\{"x":(.*)\}$', 1), F.lit("")),
                      F.lit("null"))


def json_dynamic_key(pairs) -> Column:
    """O-R9 (typed count document): build a JSON object from ``(name, column)``
    pairs where ``name`` is either a fixed string or a Column whose *value*
    becomes the field name. Field order is kept as given."""
    parts = []
    for name, c in pairs:
        key = (F.lit('"%s"' % name) if isinstance(name, str)
               else F.regexp_extract(F.to_json(F.array(name)), r"^\[(.*)\]$", 1))
        parts.append(F.concat(key, F.lit(":"), _json_value(c)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
