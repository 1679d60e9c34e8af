"""Timestamps without a zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of) -> Column:
    """A point in time given as a column, a datetime or text, as a zoneless timestamp."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def from_epoch_millis(millis: Column) -> Column:
    """Milliseconds since 1970 as a zoneless timestamp, whatever the session's zone."""
    return F.timestamp_add("MILLISECOND", millis, _epoch())


def to_epoch_millis(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), ts)


def to_epoch_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def to_second(ts: Column) -> Column:
    """Rounded to the nearest second, as a ``timestamp(0)`` column stores it."""
    micros = to_epoch_micros(ts) + 500_000
    return F.timestamp_add("MICROSECOND", micros - F.pmod(micros, F.lit(1_000_000)), _epoch())
