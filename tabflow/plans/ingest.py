"""Batch loads: one table counted, one CSV loaded, many files to many tables."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import COUNT_SCHEMA, SCENARIO_SCHEMA
from ..operators.counts import count_per_country
from ..operators.parse import REASON, REJECT_SCHEMA, accept_all, bad_rows, good_rows
from ..sinks.loads import append_load
from ..sources.lines import read_csv_positional, read_ndjson
from ..sources.registry import LoadEntry, read_load_config, read_schema_file
from ..sources.tables import read_table

Item = TypeVar("Item")
Append = Callable[[DataFrame], bool]  # False if the load is final and was skipped, see ``append_load``


def append_checked(tagged: DataFrame, append: Append, append_rejects: Callable[[DataFrame], object], mode: str) -> int:
    """Append the good rows of a tagged frame; the number of rejected ones.

    ``strict`` fails on the first bad row. ``permissive`` counts the bad rows while
    the good ones are written, and reads the input again only if there are any. If the
    good rows were skipped, it counts the bad ones by themselves: those may still have to be written.
    """
    if mode == "strict":
        append(accept_all(tagged))
        return 0
    if mode != "permissive":
        raise ValueError(f"mode must be strict or permissive, not {mode!r}")
    seen = Observation()
    written = append(good_rows(tagged.observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("rejected"))))
    rejected = seen.get["rejected"] if written else bad_rows(tagged).count()
    if rejected:
        append_rejects(bad_rows(tagged))
    return rejected


def append_parsed(tagged: DataFrame, table: str, schema, path: str | None, mode: str, load_id: str) -> int:
    """``append_checked`` to a table as one load, rejects to ``<table>_rejects``."""
    beside = f"{path}_rejects" if path else None
    return append_checked(
        tagged,
        lambda rows: append_load(rows, table, load_id, schema, path),
        lambda rows: append_load(rows, f"{table}_rejects", load_id, REJECT_SCHEMA, beside),
        mode,
    )


def count_accounts_job(spark: SparkSession, accounts: str, counts: str, run_id: str, path: str | None = None) -> None:
    """Append the number of accounts per country of one table to another; repeating a run changes nothing."""
    append_load(count_per_country(read_table(spark, accounts)), counts, run_id, COUNT_SCHEMA, path)


def load_csv_job(spark: SparkSession, source: str, table: str, run_id: str, path: str | None = None,
                 mode: str = "strict") -> int:
    """Append a positional CSV of scenario rows to a table; the number of rejected lines."""
    tagged = read_csv_positional(spark, source, SCENARIO_SCHEMA)
    return append_parsed(tagged, table, SCENARIO_SCHEMA, path, mode, run_id)


def load_tables_job(spark: SparkSession, config: str, run_id: str, mode: str = "strict", parallel: int = 8,
                    table_path: str | None = None) -> list[LoadEntry]:
    """Append every file of a load configuration to its table, with its own schema.

    The loads are independent Spark jobs, started from a few threads so that a small
    one does not wait for a large one (``spark.scheduler.mode=FAIR`` shares the
    cores). Loads of one target follow each other, since two jobs must not write to one
    folder at once. All loads run to their end; then the first failure is raised. Run the job again
    with the same ``run_id`` after mending it: what had succeeded is replaced, not doubled, wherever its entry now stands. A
    load is known by its source and target, and by how often the two came before.
    """
    entries = read_load_config(spark, config)
    by_target: dict[str, list[tuple[str, LoadEntry]]] = {}
    seen: Counter[tuple[str, str]] = Counter()
    for entry in entries:
        pair = (entry.source, entry.target)
        digest = hashlib.sha256("\n".join(pair).encode()).hexdigest()[:24]
        by_target.setdefault(entry.target, []).append((f"{run_id}_{digest}_{seen[pair]}", entry))
        seen[pair] += 1

    def load(target: str) -> None:
        path = f"{table_path}/{target}" if table_path else None
        for load_id, entry in by_target[target]:
            schema = read_schema_file(spark, entry.schema_uri)
            append_parsed(read_ndjson(spark, entry.source, schema), target, schema, path, mode, load_id)

    run_all(spark, load, list(by_target), parallel)
    return entries


def run_all(spark: SparkSession, work: Callable[[Item], None], items: Sequence[Item], parallel: int) -> None:
    """Call ``work`` for every item from a few threads; raise the first failure at the end.

    Every item has a scheduler pool of its own, as jobs of one pool queue up behind each other.
    """
    def run(position: int, item: Item) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{position % parallel}")
        work(item)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), i, item) for i, item in enumerate(items)]
    for future in started:
        future.result()
