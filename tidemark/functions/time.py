"""Column expressions on event time.

Inside the library time is a bigint of epoch microseconds, named ``us``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

from tidemark.params import HOUR, SECOND

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PARTITION_FORMAT = "yyyy-MM-dd-HH"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division; no detour over floating point."""
    return F.call_function("div", value, F.lit(divisor).cast("bigint"))


def floor_to(us: Column | str, step_us: int) -> Column:
    """Largest multiple of ``step_us`` not after ``us``, also before 1970."""
    us = col(us)
    return us - F.pmod(us, F.lit(step_us).cast("bigint"))


def epoch_seconds(us: Column | str) -> Column:
    """Whole epoch seconds, rounding towards the past."""
    return whole_div(floor_to(us, SECOND), SECOND)


def seconds_to_us(seconds: Column | str) -> Column:
    return col(seconds).cast("bigint") * F.lit(SECOND).cast("bigint")


def timestamp_to_us(ts: Column | str) -> Column:
    """Microseconds of a TIMESTAMP; a TIMESTAMP_NTZ is read in session time (UTC)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def iso_z(ts: Column | str) -> Column:
    """``2025-08-06T12:00:00Z`` from a TIMESTAMP."""
    return F.date_format(col(ts), ISO_FORMAT)


def iso_z_from_seconds(seconds: Column | str) -> Column:
    return iso_z(F.timestamp_seconds(col(seconds)))


def partition_label(us: Column | str, hours: int) -> Column:
    """Name of the ``hours``-long partition that holds ``us``; sorts as time does."""
    return F.date_format(F.timestamp_micros(floor_to(us, hours * HOUR)), PARTITION_FORMAT)


def partition_name(seconds: int, hours: int) -> str:
    """``partition_label`` of a time known to the driver (epoch seconds)."""
    start = seconds // (hours * 3600) * (hours * 3600)
    return (datetime(1970, 1, 1) + timedelta(seconds=start)).strftime("%Y-%m-%d-%H")


def coerce_time(value: Column | str) -> Column:
    """Read text or numbers as time: whole numbers are epoch seconds, anything
    unreadable becomes null."""
    text = col(value).cast("string")
    return F.coalesce(
        F.timestamp_seconds(text.try_cast("bigint")),
        text.try_cast("timestamp"),
    )
