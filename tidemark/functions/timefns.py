"""Time helpers that behave the same for TIMESTAMP and TIMESTAMP_NTZ columns.

Everything is expressed with built-in functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(text: str | int) -> int:
    """'5 minutes', '1 hour', '10 s', 300 (seconds) -> microseconds."""
    if isinstance(text, (int, float)):
        return int(text * 1_000_000)
    total = 0
    for num, unit in re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text):
        u = unit.lower().rstrip("s") or "s"
        alias = {"s": "second", "sec": "second", "m": "minute", "min": "minute",
                 "h": "hour", "hr": "hour", "d": "day", "ms": "millisecond",
                 "milli": "millisecond", "us": "microsecond", "micro": "microsecond"}
        u = alias.get(u, u)
        if u not in _UNITS_US:
            raise ValueError(f"unknown unit in duration {text!r}")
        total += int(float(num) * _UNITS_US[u])
    if total == 0 and not re.search(r"\d", str(text)):
        raise ValueError(f"bad duration {text!r}")
    return total


def interval(text: str | int) -> Column:
    """A day-time interval literal usable in timestamp arithmetic."""
    return F.expr(f"make_dt_interval(0, 0, 0, {duration_us(text) / 1_000_000:.6f})")


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def epoch_us(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch.

    For NTZ columns the value is built from the wall-clock fields (days since
    1970-01-01, then time of day), so it does not depend on the session time
    zone; TIMESTAMP columns use ``unix_micros``.
    """
    if is_ntz(df, col):
        c = F.col(col)
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        secs_of_day = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
        micros = (F.expr(f"EXTRACT(SECOND FROM `{col}`)") * 1_000_000).cast("long")
        return days * 86_400_000_000 + secs_of_day * 1_000_000 + micros
    return F.unix_micros(F.col(col))


def from_epoch_us(us: Column, ntz: bool = True) -> Column:
    """Inverse of :func:`epoch_us`."""
    if ntz:
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
            secs=(us / F.lit(1_000_000)).cast("decimal(18,6)")
        )
    return F.timestamp_micros(us)


def seconds_to_ts(col: Column, ntz: bool = True) -> Column:
    """Epoch seconds (the reference's record time unit) -> timestamp."""
    ts = F.timestamp_seconds(col)
    return ts.cast("timestamp_ntz") if ntz else ts


def millis_to_ts(col: Column, ntz: bool = True) -> Column:
    ts = F.timestamp_millis(col)
    return ts.cast("timestamp_ntz") if ntz else ts


def bucket_of(df: DataFrame, col: str, width: str | int, offset: str | int = 0) -> Column:
    """Epoch-aligned bucket number of width ``width`` (same alignment as F.window).

    For a numeric ordering column (an arrival sequence number) the bucket is
    ``col // width`` with ``width`` a row count (a duration string means 2^20).
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.NumericType):
        n = width if isinstance(width, int) else 1 << 20
        return F.floor(F.col(col) / F.lit(n)).cast("long")
    w = duration_us(width)
    off = duration_us(offset) if offset else 0
    return F.floor((epoch_us(df, col) - F.lit(off)) / F.lit(w)).cast("long")


def to_event_time(df: DataFrame, col: str, out: str = "event_time") -> DataFrame:
    """NTZ -> session timestamp for watermarking (streaming needs TIMESTAMP)."""
    return df.withColumn(out, F.col(col).cast("timestamp"))
