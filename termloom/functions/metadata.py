"""Document metadata expressions: sizes, time stamps and their term forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two time stamp formats.
READABLE_FORMAT = "dd/MM/yyyy HH:mm:ss"
SORTABLE_FORMAT = "yyyyMMddHHmmss"


def size_kb(n_bytes: Column) -> Column:
    """Whole kilobytes as a float."""
    return F.floor(n_bytes / F.lit(1024)).cast("float")


def readable_date(ts: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` in the session time zone."""
    return F.date_format(ts, READABLE_FORMAT)


def sortable_date(ts: Column) -> Column:
    """``yyyyMMddHHmmss``; the text order is the time order."""
    return F.date_format(ts, SORTABLE_FORMAT)


def utc(ts: Column) -> Column:
    """The wall clock of a zoned time stamp in UTC."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def between(value: Column, low=None, high=None) -> Column:
    """Closed range test; ``None`` leaves a side open."""
    test = F.lit(True)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test
