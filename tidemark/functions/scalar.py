"""Scalar functions (F1-F7) and the reference's hash functions, all built-in expressions.

The two hashes fold the characters of a string with 64-bit arithmetic in the
reference.  ANSI Spark raises on long overflow, so each step is reduced
modulo a power of two; because 2^32 and 2^29 divide 2^64 the reduced value
equals the low bits of the wrapped one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO32 = 4294967296


def _chars(s: Column) -> Column:
    """The UTF-16 units of a string; a character outside the BMP is two."""
    units = F.regexp_extract_all(F.hex(F.encode(s, "UTF-16BE")), F.lit("(?s).{4}"), F.lit(0))
    return F.transform(units, lambda u: F.conv(u, 16, 10).cast("long"))


def java_string_hash(s: Column) -> Column:
    """``String.hashCode``: h = 31*h + c over UTF-16 units, as a signed 32-bit int."""
    h = F.aggregate(_chars(s), F.lit(0).cast("long"), lambda a, c: (a * 31 + c) % _TWO32)
    return F.when(h >= 2**31, h - _TWO32).otherwise(h).cast("int")


def double_to_int(x: Column) -> Column:
    """JVM ``Double.toInt``: NaN -> 0, clamp to the int range, truncate toward zero."""
    clamped = F.least(F.greatest(x, F.lit(-(2.0**31))), F.lit(2.0**31 - 1))
    return F.when(F.isnan(x), F.lit(0)).otherwise(clamped.cast("int"))


def scaled_hash(s: Column, factor: float) -> Column:
    """U1 ``HashCode(factor)``: ``(s.hashCode * factor).toInt``."""
    return double_to_int(java_string_hash(s).cast("double") * F.lit(float(factor)))


def bitmap_slot(s: Column, bits: int = 29, seed: int = 61) -> Column:
    """D4/A12 polynomial hash ``h = h*seed + c`` kept to its low ``bits`` bits."""
    mod = 1 << bits
    return F.aggregate(_chars(s), F.lit(0).cast("long"), lambda a, c: (a * seed + c) % mod)


def fahrenheit_to_celsius(f: Column) -> Column:
    """P10."""
    return (f - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def starts_with(s: Column, prefix: str) -> Column:
    """F7/P2 ``startsWith`` (note: ``sensor_1`` also matches ``sensor_10``)."""
    return s.startswith(prefix)
