"""Epoch arithmetic on ``timestamp_ntz`` columns, independent of the
session time zone (casting NTZ to TIMESTAMP would read the wall clock in
the session zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_US = 86_400_000_000


def epoch_micros(ts: Column) -> Column:
    """Micro-seconds since 1970-01-01 00:00:00 of a wall-clock timestamp."""
    return (F.unix_date(F.to_date(ts)).cast("long") * _DAY_US
            + F.hour(ts).cast("long") * 3_600_000_000
            + F.minute(ts).cast("long") * 60_000_000
            + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long"))


def ntz_from_micros(us: Column) -> Column:
    """Inverse of :func:`epoch_micros`."""
    days = F.floor(us / _DAY_US)
    rest = us - days * _DAY_US
    base = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")).cast("timestamp_ntz")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     (rest / 1_000_000).cast("decimal(18,6)"))


UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": _DAY_US}


def chunk_of(us: Column, unit: str) -> Column:
    """Index of the ``unit``-long time chunk holding epoch micro-seconds ``us``
    (non-decreasing in ``us``; no time-zone rules involved)."""
    return F.floor(us / F.lit(UNIT_US[unit]))


def truncate_micros(us: Column, unit: str) -> Column:
    return chunk_of(us, unit) * F.lit(UNIT_US[unit])
