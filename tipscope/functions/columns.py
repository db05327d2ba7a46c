"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions (no Python UDFs), so they stay
inside whole-stage code generation and are pushed down where possible.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from ..specs import (
    NIGHT_FROM_HOUR,
    NIGHT_TO_HOUR,
    WEEKDAY_NAMES,
    WEEKEND_DAYS,
    Bound,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c: str | Column, dtype: DataType | None = None) -> Column:
    """Whole seconds since the epoch, floored.

    ``timestamp_ntz`` values are read as UTC wall-clock times through their
    date and time fields, so the result never depends on the session time
    zone; ``timestamp`` values are instants and use ``unix_seconds``.
    """
    c = col(c)
    if isinstance(dtype, TimestampNTZType):
        return (
            F.unix_date(c.cast("date")).cast("long") * F.lit(86400)
            + F.hour(c) * F.lit(3600)
            + F.minute(c) * F.lit(60)
            + F.second(c)
        )
    return F.unix_seconds(c.cast("timestamp"))


def elapsed(start: str | Column, end: str | Column, unit_seconds: float,
            start_type: DataType | None = None, end_type: DataType | None = None) -> Column:
    """Whole-second difference ``end - start`` expressed in ``unit_seconds`` units."""
    diff = epoch_seconds(end, end_type) - epoch_seconds(start, start_type)
    return diff / F.lit(float(unit_seconds))


def rate(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(col(numerator), col(denominator))


def speed(distance: str | Column, duration: str | Column, time_divisor: float) -> Column:
    return F.try_divide(col(distance), col(duration) / F.lit(float(time_divisor)))


def within(c: str | Column, bound: Bound) -> Column:
    """Predicate for a range rule; NULL input gives NULL (the row is dropped)."""
    c = col(c)
    parts = []
    if bound.lo is not None:
        parts.append(c >= F.lit(bound.lo) if bound.lo_inclusive else c > F.lit(bound.lo))
    if bound.hi is not None:
        parts.append(c <= F.lit(bound.hi) if bound.hi_inclusive else c < F.lit(bound.hi))
    if not parts:
        return c.isNotNull()
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def is_weekend(ts: str | Column) -> Column:
    return F.dayofweek(col(ts)).isin(*WEEKEND_DAYS).cast("int")


def is_night(ts: str | Column) -> Column:
    h = F.hour(col(ts))
    return ((h >= NIGHT_FROM_HOUR) | (h <= NIGHT_TO_HOUR)).cast("int")


def weekday_name(dow: str | Column) -> Column:
    """Day-of-week index (1 = Sunday) to its short name."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), col(dow).cast("int"))


def threshold_label(numerator: str | Column, denominator: str | Column, threshold: float) -> Column:
    """1 when numerator/denominator < threshold, 0 otherwise, NULL when undefined."""
    return (rate(numerator, denominator) < F.lit(float(threshold))).cast("int")


def bin_index(c: str | Column, width: float) -> Column:
    """Integer index of the fixed-width bin holding ``c``."""
    return F.floor(col(c) / F.lit(float(width)))


def bin_start(c: str | Column, width: float) -> Column:
    """Left edge of the bin, computed as ``floor(x / w) * w`` in doubles."""
    return bin_index(c, width) * F.lit(float(width))


def hash_bucket(key: str | Column, modulus: int, salt: str = "", method: str = "md5") -> Column:
    """Layout-independent bucket in ``[0, modulus)`` from a hash of the key.

    ``md5`` (default) uses the first 28 bits of the hex digest, so the value is
    the same for any partitioning and can be reproduced by other engines;
    ``xxhash64`` is Spark's cheaper native hash for jobs that need no external
    reproduction.  A ``salt`` gives an independent bucketing of the same key
    (e.g. a split of a sample).
    """
    text = col(key).cast("string")
    salted = F.concat(text, F.lit(salt)) if salt else text
    if method == "xxhash64":
        return F.pmod(F.xxhash64(salted), F.lit(int(modulus)))
    digest = F.md5(salted)
    return F.pmod(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long"), F.lit(int(modulus)))


#: Range of :func:`hash_position`: 60 bits, the longest hex prefix that fits a signed 64-bit integer.
HASH_RANGE = 1 << 60


def hash_position(key: str | Column, salt: str = "") -> Column:
    """Layout-independent position of a key in ``[0, HASH_RANGE)``: the first 15
    hex digits of its md5, so other engines get the same number."""
    text = col(key).cast("string")
    salted = F.concat(text, F.lit(salt)) if salt else text
    return F.conv(F.substring(F.md5(salted), 1, 15), 16, 10).cast("long")
