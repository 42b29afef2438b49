"""Seconds of work time: 08:30 to 21:00 every day, on wall-clock timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPENS = 8 * 3600 + 30 * 60
CLOSES = 21 * 3600
DAY = CLOSES - OPENS


def elapsed(t: Column) -> Column:
    """Work seconds from the epoch's day to t."""
    of_day = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t).cast("int")
    inside = F.least(F.greatest(of_day, F.lit(OPENS)), F.lit(CLOSES)) - OPENS
    return F.datediff(t, F.lit("1970-01-01").cast("date")).cast("long") * DAY + inside


def between(start: Column, end: Column) -> Column:
    """Work seconds from start to end, at least 0; null where either is null (greatest() would make a 0 of it)."""
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0), elapsed(end) - elapsed(start))).cast("long")


def waited_until(boundary_day: Column, first: Column) -> Column:
    """Work seconds from a first message to the end of the boundary day."""
    return between(first, F.date_add(boundary_day, 1).cast("timestamp_ntz"))
