"""Repeatable hashes for buckets, samples and synthetic draws.

A *hasher* is a function of columns giving a non-negative BIGINT. ``stable_hash``
is the fast default; ``portable_hash`` gives numbers any SQL engine with md5 can
recompute. Neither depends on partitioning, so a retried task draws the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Hasher = Callable[..., Column]

_FRACTION_STEPS = 1_000_000_000


def stable_hash(*columns: Column) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(2**63 - 1))


def portable_hash(*columns: Column) -> Column:
    """The first 60 bits of md5 over the ``|``-joined text of the columns."""
    text = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket_of(column: Column, buckets: int, hasher: Hasher = stable_hash) -> Column:
    """Bucket 0 … buckets-1 of a key; folds to a constant for a literal key."""
    return F.abs(hasher(column) % F.lit(buckets))


def draw(key: Column, purpose: str, size: int, hasher: Hasher = stable_hash) -> Column:
    """0 … size-1, independent between purposes."""
    return hasher(key, F.lit(purpose)) % F.lit(size)


def fraction_of(*columns: Column, hasher: Hasher = stable_hash) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return (hasher(*columns) % F.lit(_FRACTION_STEPS)) / F.lit(float(_FRACTION_STEPS))
