"""Jobs that make rows: account records, and copies of a table's day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, SparkSession

from ..functions.hashing import Hasher, stable_hash
from ..operators.accounts import generate_accounts
from ..operators.replicate import shift_replicate
from ..sinks.files import publish_messages, write_ndjson
from .layouts import DATE, Layout, cluster_by_range, with_date


def generate_accounts_job(
    spark: SparkSession,
    count: int,
    destination: str,
    location: str,
    partitions: int | None = None,
    seed: int = 0,
    **options: str,
) -> None:
    """``count`` account records to a folder of NDJSON files or to a topic.

    ``destination`` is ``file`` (``location`` a folder) or ``topic`` (``location`` its
    name; ``options`` go to the Kafka writer).
    """
    if destination not in ("file", "topic"):
        raise ValueError(f"destination must be file or topic, not {destination!r}")
    if not location:
        raise ValueError("a location is needed: the folder or the topic name")
    rows = generate_accounts(spark, count, partitions, seed)
    if destination == "file":
        write_ndjson(rows, location)
    else:
        publish_messages(rows, location, **options)


def replicate_day_job(
    spark: SparkSession,
    layout: Layout,
    day: date,
    iterations: int | None,
    rate: float | None = None,
    *,
    key: list[Column] | None = None,
    seed: int | None = None,
    hasher: Hasher = stable_hash,
    tasks: int | None = None,
) -> None:
    """Grow a date-clustered table: append copies of ``day`` to the days after it.

    Reads that day's partition only. All copies are one append, clustered like the
    rest of the table, so a copy of a large day is many files (``tasks``, as for the layouts).
    """
    if not layout.by_date:
        raise ValueError("the table must be partitioned by date")
    source = layout.pruned(spark, None, day).drop(DATE)
    copies = shift_replicate(source, day, iterations, rate, key=key, seed=seed, hasher=hasher)
    clustered = cluster_by_range(with_date(copies), DATE, "cust_identifier", tasks)
    clustered.write.mode("append").partitionBy(DATE).saveAsTable(layout.table)
