"""Counts per key.

``count`` adds up inside every task before the shuffle, so a key holding a large
share of the rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_of
from ..functions.text import key_count_line


def count_per_country(accounts: DataFrame, key: str = "country_code") -> DataFrame:
    return accounts.groupBy(F.col(key).alias("country_name")).agg(F.count("*").alias("num_cc_card"))


def count_lines(counts: DataFrame) -> DataFrame:
    """``country: count`` text lines."""
    return counts.select(key_count_line(F.col("country_name"), F.col("num_cc_card")).alias("value"))


def count_per_window(
    accounts: DataFrame, ts: str, key: str = "country_code", width: str = "60 seconds"
) -> DataFrame:
    """Counts per key and tumbling, epoch-aligned window."""
    return (
        accounts.groupBy(F.window(ts, width).alias("w"), F.col(key).alias("country_name"))
        .agg(F.count("*").alias("num_cc_card"))
        .select(F.col("w.start").alias("window_start"), "country_name", "num_cc_card")
    )


def latest_date(df: DataFrame, ts: Column) -> DataFrame:
    return df.agg(F.max(date_of(ts)).alias("latest_date"))
