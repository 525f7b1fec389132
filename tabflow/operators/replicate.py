"""Grow a table by copying one of its days to later days."""

from __future__ import annotations

import random
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_of, shift_days
from ..functions.hashing import Hasher, fraction_of, stable_hash


def shift_replicate(
    df: DataFrame,
    day: date | str,
    iterations: int | None,
    rate: float | None = None,
    *,
    ts: str = "tstamp",
    key: Sequence[Column] | None = None,
    seed: int | None = None,
    hasher: Hasher = stable_hash,
) -> DataFrame:
    """New rows for ``day`` + 1 … + (iterations - 1), each a random part of the rows of ``day``.

    One rate holds for the whole call, drawn if not given. Every row and shift is an
    independent draw: ``rand`` by default, a hash of ``key`` and the shift if given.
    No shift lands on ``day``, so all shifts are one narrow pass over that day's
    rows instead of one insert after another. ``iterations`` of NULL, 1 or less
    gives no rows.
    """
    columns = df.columns
    source = df.where(date_of(F.col(ts)) == F.lit(day).cast("date"))
    if iterations is None or iterations <= 1:
        return source.limit(0)
    if rate is None:
        rate = random.Random(seed).random()
    shifted = source.withColumn("_shift", F.explode(F.sequence(F.lit(1), F.lit(iterations - 1))))
    if key is None:
        kept = shifted.where(F.rand(seed) < rate)
    else:
        kept = shifted.where(fraction_of(*key, F.col("_shift"), hasher=hasher) < F.lit(rate))
    return kept.withColumn(ts, shift_days(F.col(ts), F.col("_shift"))).select(*columns)
