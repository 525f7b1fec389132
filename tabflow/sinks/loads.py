"""Loads: appends that can be repeated, and the folding of finished days."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import conform, literal, quoted
from ..session import remove_path
from .tables import create_if_needed

LOAD_DAY, LOAD_ID = "load_day", "load_id"
FOLD, FOLDED = "fold", "folded_load"  # of the table of folded days: its second partition column, and the ids of its loads


def days_table(table: str) -> str:
    """The table beside ``table`` that holds its folded days."""
    return f"{table}_days"


def create_loads(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None, within: str | None = None) -> None:
    """A table of loads; ``within`` names a further partition column, a string that the rows bring along."""
    parts = [LOAD_DAY, LOAD_ID, *([within] if within else [])]
    create_if_needed(spark, table, T.StructType([*schema.fields, *(T.StructField(p, T.StringType()) for p in parts)]), path, tuple(parts))


def create_days(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None, within: str | None = None) -> None:
    """The table of its folded days."""
    parts = [LOAD_DAY, FOLD, *([within] if within else [])]
    fields = [*schema.fields, *(T.StructField(p, T.StringType()) for p in (FOLDED, *parts))]
    create_if_needed(spark, days_table(table), T.StructType(fields), f"{path}_days" if path else None, tuple(parts))


def _partitions(spark: SparkSession, table: str, load_id: str | None = None) -> list[tuple[str, str]]:
    """(day, load) or (day, fold) of a table's partitions; a folded day has one fold, so they stay few."""
    spec = f" PARTITION ({LOAD_ID} = {literal(load_id)})" if load_id else ""
    rows = spark.sql(f"SHOW PARTITIONS {table}{spec}").collect()
    return sorted({tuple(part.split("=", 1)[1] for part in r[0].split("/")[:2]) for r in rows})


def append_load(df: DataFrame, table: str, load_id: str, schema: T.StructType, path: str | None = None, repeated: bool = True,
                within: str | None = None) -> bool:
    """Append one load to a table so that repeating the load changes nothing; whether it was written.

    The rows fill the partition of that load below the day of its first attempt, and a repeat
    overwrites them, on whatever day it comes. ``fold_days`` gathers the loads of finished days;
    a load that has been folded is final: repeating it skips it, ``df`` isn't run, and the result is False.
    ``repeated=False`` says that this load was never tried before, which saves looking for it. ``within``: see ``create_loads``.
    """
    if not re.fullmatch(r"[\w-]+", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    spark, day = df.sparkSession, datetime.now(timezone.utc).date().isoformat()
    create_loads(spark, table, schema, path, within)
    if repeated:
        if spark.catalog.tableExists(days_table(table)) and not folded_loads(spark, table).where(F.col(FOLDED) == load_id).isEmpty():
            return False
        day = next((first for first, _ in _partitions(spark, table, load_id)), day)
    beside = [T.StructField(within, T.StringType())] if within else []
    rows = conform(df, T.StructType([*schema.fields, *beside]))
    last = f", {quoted(within)}" if within else ""
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_DAY} = '{day}', {LOAD_ID} = '{load_id}'{last}) BY NAME SELECT * FROM {{rows}}", rows=rows)
    return True


def folded_loads(spark: SparkSession, table: str) -> DataFrame:
    """load_day and folded_load of all loads that have been folded; files that hold rows are skipped by their statistics."""
    spark.catalog.refreshTable(days_table(table))
    return spark.table(days_table(table)).where(F.col(FOLDED).isNotNull()).select(LOAD_DAY, FOLDED)


def read_loads(spark: SparkSession, table: str, load_id: str | None = None) -> DataFrame:
    """All loads of a table, or one that isn't folded, without the load columns.

    A stream writes in a session of its own, so the files this session remembers may be out of date. Loads that are
    folded but not yet dropped, as after an interrupted fold, count once.
    """
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    if load_id is not None:
        return rows.where(F.col(LOAD_ID) == load_id).drop(LOAD_DAY, LOAD_ID)
    if not spark.catalog.tableExists(days_table(table)):
        return rows.drop(LOAD_DAY, LOAD_ID)
    if days := {day for day, _ in _partitions(spark, table)}:
        folded = folded_loads(spark, table).where(F.col(LOAD_DAY).isin(*days))
        rows = rows.join(folded.select(F.col(FOLDED).alias(LOAD_ID)), LOAD_ID, "left_anti")
    gathered = spark.table(days_table(table)).where(F.col(FOLDED).isNull())
    return rows.drop(LOAD_DAY, LOAD_ID).unionByName(gathered.drop(LOAD_DAY, FOLD, FOLDED))


def fold_days(spark: SparkSession, table: str, before: date, path: str | None = None,
              combine: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[str]:
    """Gather the loads of every day before ``before`` into one partition a day of a second table; the days folded.

    A table that a stream fills every minute then has 1,440 partitions for the running day, and the second one for each day
    folded. One write holds a day's rows and the ids of its loads, so a fold counts as a whole or not at all; then the
    loads are dropped. If that was interrupted, the next run drops them. ``combine`` may shrink a day's rows, such as adding
    up partial counts. Run it from one place at a time. ``path`` is the table's folder, whose files of folded loads are then removed.
    """
    loads = [(day, load_id) for day, load_id in _partitions(spark, table) if day < before.isoformat()]
    if not loads:
        return []
    spark.catalog.refreshTable(table)
    rows, days = spark.table(table), sorted({day for day, _ in loads})
    within = rows.columns[rows.columns.index(LOAD_ID) + 1:]
    schema = T.StructType([f for f in rows.schema.fields if f.name not in (LOAD_DAY, LOAD_ID, *within)])
    create_days(spark, table, schema, path, *within)
    done = {r[FOLDED] for r in folded_loads(spark, table).where(F.col(LOAD_DAY).isin(*days)).collect()}
    for day in days:
        todo = [load_id for first, load_id in loads if first == day and load_id not in done]
        if todo:
            part = combine(rows.where((F.col(LOAD_DAY) == day) & F.col(LOAD_ID).isin(todo)).drop(LOAD_DAY, LOAD_ID)).hint("rebalance", *within)
            ids = spark.createDataFrame([(load_id,) for load_id in todo], f"{FOLDED} string").coalesce(1)
            both = part.unionByName(ids, allowMissingColumns=True).select(*schema.names, FOLDED, *within)
            spark.sql(f"INSERT OVERWRITE TABLE {days_table(table)} PARTITION ({LOAD_DAY} = '{day}', {FOLD} = '{uuid.uuid4().hex}'"
                      f"{''.join(', ' + quoted(c) for c in within)}) BY NAME SELECT * FROM {{rows}}", rows=both)
    # A partition is dropped by all its columns, some at a time.
    known = set(loads)
    listed = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    gone = [[p.split("=", 1) for p in parts] for parts in listed if tuple(p.split("=", 1)[1] for p in parts[:2]) in known]
    specs = ["PARTITION (" + ", ".join(f"{quoted(c)} = {literal(unquote(v))}" for c, v in parts) + ")" for parts in gone]
    # Files first: what is interrupted here is still listed, and the next run goes on.
    for day, load_id in loads if path else ():
        remove_path(spark, f"{path}/{LOAD_DAY}={day}/{LOAD_ID}={load_id}")
    for lo in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(specs[lo:lo + 100]))
    spark.catalog.refreshTable(table)
    return days
