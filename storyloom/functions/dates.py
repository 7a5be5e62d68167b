"""Day arithmetic on naive timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, rounded down (-12 h is -1 day)."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY))).cast("int")


def state_age(to_date: Column, date: Column) -> Column:
    """Age of a state entry at the end of a window; the last day counts as 0."""
    return floor_days(to_date, date) - 1


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, with or without offset or Z, as a naive UTC timestamp; NULL if it is none."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def timestamp_ntz(value) -> Column:
    """Literal for a datetime, an ISO string or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")
