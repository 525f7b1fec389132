"""Ranges between ordered boundaries, as a partition column."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = int | float
CATCH_ALL = 0


def _checked(boundaries: Sequence[Number]) -> list[Number]:
    if len(boundaries) < 2 or any(not a < b for a, b in zip(boundaries, boundaries[1:])):
        raise ValueError("boundaries must be two or more, ascending")
    return list(boundaries)


def range_bucket(value: Column, boundaries: Sequence[Number]) -> Column:
    """How many boundaries are at or below a value: 0 below the first one; NULL for NULL."""
    bounds = _checked(boundaries)
    steps = {b - a for a, b in zip(bounds, bounds[1:])}
    if len(steps) == 1 and all(isinstance(b, int) for b in bounds):
        # Evenly spaced: arithmetic instead of a search, whatever their number.
        number = F.floor((value - bounds[0]) / F.lit(steps.pop())) + 1
        return F.greatest(F.lit(0), F.least(F.lit(len(bounds)), number)).cast("int") * F.when(value.isNotNull(), 1)
    found = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda bound: bound <= value))
    return F.when(value.isNotNull(), found)


def range_partition(value: Column, boundaries: Sequence[Number]) -> Column:
    """Partition i for a value from boundary i up to the next one; values outside all ranges, and NULL, share partition 0."""
    bucket = range_bucket(value, boundaries)
    return F.coalesce(F.when(bucket < len(boundaries), bucket), F.lit(CATCH_ALL))


def partitions_of(boundaries: Sequence[Number], low: Number | None, high: Number | None) -> list[int]:
    """The partitions that can hold values from ``low`` to ``high``, both included; None leaves a side open."""
    bounds = _checked(boundaries)
    first = 0 if low is None else bisect_right(bounds, low)
    last = len(bounds) if high is None else bisect_right(bounds, high)
    inside = set(range(max(1, first), min(len(bounds) - 1, last) + 1))
    return sorted(inside | ({CATCH_ALL} if first == 0 or last == len(bounds) else set()))
