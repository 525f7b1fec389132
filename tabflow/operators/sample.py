"""Row samples and parameter picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import Hasher, fraction_of, stable_hash


def sample_rows(
    df: DataFrame,
    rate: float,
    key: Sequence[Column] | None = None,
    seed: int | None = None,
    hasher: Hasher = stable_hash,
) -> DataFrame:
    """Keep each row with probability ``rate``.

    Without ``key`` every row is an independent ``rand`` draw. With ``key`` the draw
    is a hash of those columns and ``seed``: the same rows whatever the
    partitioning, and copies of a row stay together.
    """
    if key is None:
        return df.where(F.rand(seed) < rate)
    salt = F.lit("" if seed is None else str(seed))
    return df.where(fraction_of(*key, salt, hasher=hasher) < F.lit(rate))


def first_values(df: DataFrame, value: Column, name: str, count: int = 10) -> DataFrame:
    """The ``count`` smallest distinct values: a repeatable parameter list."""
    return df.select(value.alias(name)).distinct().orderBy(name).limit(count)


def pick_values(
    values: DataFrame, name: str, count: int, salt: str, hasher: Hasher = stable_hash
) -> DataFrame:
    """``count`` values in a random order fixed by ``salt``."""
    order = hasher(F.col(name), F.lit(salt))
    return values.select(name, order.alias("_order")).orderBy("_order", name).limit(count).select(name)
