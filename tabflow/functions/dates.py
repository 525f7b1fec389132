"""Calendar dates and time differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_of(ts: Column) -> Column:
    """Calendar date (UTC with the session zone of this package)."""
    return F.to_date(ts)


def shift_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), ts)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from start to end, cut toward zero."""
    return F.timestamp_diff("MILLISECOND", start, end)
