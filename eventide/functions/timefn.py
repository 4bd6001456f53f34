"""Time helpers: durations, epoch conversion, formatting (FUN3, FUN4, FUN5, FUN10)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Unit names accepted in duration strings, in microseconds.
_UNIT_US = {
    "microsecond": 1, "microseconds": 1, "us": 1,
    "millisecond": 1_000, "milliseconds": 1_000, "ms": 1_000,
    "second": 1_000_000, "seconds": 1_000_000, "s": 1_000_000,
    "minute": 60_000_000, "minutes": 60_000_000, "min": 60_000_000,
    "hour": 3_600_000_000, "hours": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "days": 86_400_000_000, "d": 86_400_000_000,
}


def duration_us(d: str | int) -> int:
    """``'5 minutes'`` -> 300000000. Integers are taken as microseconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNIT_US:
        raise ValueError(f"unsupported duration {d!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2).lower()]


def epoch_us(ts: Column | str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ column, independent of the session zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def add_us(ts: Column | str, us: Column | int) -> Column:
    """``ts + us`` microseconds; keeps the timestamp type (NTZ stays NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    q = F.lit(us) if isinstance(us, int) else us
    return F.timestamp_add("MICROSECOND", q.cast("long"), c)


def from_epoch_us(us: Column) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ (zone independent)."""
    return add_us(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), us)


def slice_id(ts: Column | str, size: str | int) -> Column:
    """Index of the epoch-aligned time slice of length ``size`` holding ``ts``."""
    us = duration_us(size)
    if us <= 0:
        raise ValueError("a slice has a positive length")
    return F.floor(epoch_us(ts) / F.lit(us)).cast("long")


def parse_dmy_time(s: Column) -> Column:
    """Parse ``dd/MM/yyyy:HH:mm:ss`` text to TIMESTAMP_NTZ (FUN3)."""
    return F.to_timestamp_ntz(s, F.lit("dd/MM/yyyy:HH:mm:ss"))


def format_slash_time(ts: Column) -> Column:
    """Format a timestamp as ``yyyy/MM/dd-HH:mm:ss`` (FUN4)."""
    return F.date_format(ts, "yyyy/MM/dd-HH:mm:ss")


def ntz_from_epoch(c: Column | str, unit: str = "ms") -> Column:
    """Epoch seconds / milliseconds (long) -> TIMESTAMP_NTZ wall clock in UTC (STR1 input step)."""
    col = F.col(c) if isinstance(c, str) else c
    mult = {"s": 1_000_000, "ms": 1_000, "us": 1}[unit]
    return from_epoch_us(col.cast("long") * F.lit(mult))
