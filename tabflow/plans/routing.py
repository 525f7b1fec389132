"""One input, many tables: each message names the table it belongs to.

Tables of one declared schema share a *store*, a table partitioned by load and by route, so that a load of messages for any number
of such tables is one write. What a reader sees under a table's name is a view of its rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import literal, quoted
from ..operators.parse import OBJECT, REJECT_SCHEMA, bad_rows, good_rows, parse_object, tag_object
from ..operators.registry_join import table_name
from ..session import remove_path
from ..sinks.loads import FOLDED, LOAD_DAY, LOAD_ID, append_load, create_days, create_loads, days_table, fold_days, read_loads
from ..sources.registry import registry_schemas
from .ingest import append_checked, run_all

REJECTS = "_rejects"
ROUTE = "_route"


@dataclass(frozen=True)
class Target:
    """Where routed tables live: one view per registry name, one store per schema, files below ``root``."""

    root: str
    registry: DataFrame
    prefix: str = ""

    def table(self, name: str) -> str:
        """The catalog name: a registry name may hold characters an identifier may not."""
        return self.prefix + re.sub(r"\W", "_", name)

    def store(self, schema: T.StructType) -> str:
        return f"{self.prefix}store_{hashlib.md5(schema.simpleString().encode()).hexdigest()[:16]}"

    def path(self, table: str) -> str:
        return f"{self.root}/t_{table}"

    def create(self, spark: SparkSession, schemas: dict[str, T.StructType]) -> None:
        """The stores and views of some tables, where they are missing."""
        known = {r["viewName"].lower() for r in spark.sql(f"SHOW VIEWS LIKE {literal(self.prefix + '*')}").collect()}
        missing = {name: schema for name, schema in schemas.items() if self.table(name).lower() not in known}
        for store, schema in {self.store(schema): schema for schema in missing.values()}.items():
            create_loads(spark, store, schema, self.path(store), ROUTE)
            create_days(spark, store, schema, self.path(store), ROUTE)
        for name, schema in missing.items():
            store = self.store(schema)
            columns, own = ", ".join(f"s.{quoted(c)}" for c in schema.names), f"s.{quoted(ROUTE)} = {literal(name)}"
            spark.sql(f"CREATE VIEW IF NOT EXISTS {self.table(name)} AS SELECT {columns} FROM {store} s LEFT ANTI JOIN {days_table(store)} d "
                      f"ON d.{FOLDED} = s.{LOAD_ID} AND d.{LOAD_DAY} = s.{LOAD_DAY} WHERE {own} "
                      f"UNION ALL SELECT {columns} FROM {days_table(store)} s WHERE {own} AND s.{FOLDED} IS NULL")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A routed table, or the rejects."""
        if name == REJECTS:
            return read_loads(spark, self.table(REJECTS))
        spark.catalog.refreshTable(self.table(name))
        return spark.table(self.table(name))

    def fold(self, spark: SparkSession, schema: T.StructType, before) -> list[str]:
        """``fold_days`` for all tables of a schema."""
        return fold_days(spark, self.store(schema), before, self.path(self.store(schema)))

    def check(self, names: list[str]) -> None:
        tables = [self.table(name).lower() for name in [*names, REJECTS]]
        if len(set(tables)) < len(tables):
            raise ValueError("two registry names stand for the same table")


def tag_route(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """``value``, its parsed object and its ``route``: the table named there, or ``_rejects`` for an unknown one."""
    named = parse_object(messages).withColumn("route", table_name())
    known = registry.select(F.col("tablename").alias("_known")).distinct()
    found = named.join(known, F.col("route") == F.col("_known"), "left")
    return found.select("value", OBJECT, F.coalesce("_known", F.lit(REJECTS)).alias("route"))


def route_counts(messages: DataFrame, registry: DataFrame) -> DataFrame:
    return tag_route(messages, registry).groupBy("route").agg(F.count("*").alias("n_messages"))


def route_messages(
    messages: DataFrame,
    target: Target,
    load_id: str,
    stage: str,
    mode: str = "strict",
    parallel: int = 8,
    repeated: bool = True,
) -> list[str]:
    """Append messages to the tables they name; returns the tables written.

    A message is parsed once, into a map; its table name and its values come from that map.
    The maps are written to a folder of the load below ``stage``, gathered by table, a table that holds most
    of them in many files. Then the tables of each schema are written by one job, so the number of jobs
    depends on the schemas present and not on the tables. The folder goes when all is written; repeating a load replaces what it wrote.

    ``strict`` fails before any table is written if a table name is unknown or a message doesn't fit its table.
    ``permissive`` appends such messages to the rejects.
    """
    spark, folder = messages.sparkSession, f"{stage}/{load_id}"
    split = tag_route(messages, target.registry).hint("rebalance", F.col("route"))
    split.write.mode("overwrite").partitionBy("route").parquet(folder)
    staged = spark.read.schema(f"value string, {quoted(OBJECT)} map<string, string>, route string").parquet(folder)
    # At most one row per table the load has messages for, plus the rejects.
    routes = staged.select(F.col("route").alias("tablename")).distinct().collect()
    present = spark.createDataFrame(routes, "tablename string")
    schemas = registry_schemas(target.registry, present)
    target.check(list(schemas))
    unnamed = staged.where(F.col("route") == REJECTS)
    some_unnamed = any(r["tablename"] == REJECTS for r in routes)
    if mode == "strict" and some_unnamed:
        raise ValueError("messages without a known table name; see " + folder)
    stores: dict[str, list[str]] = {}
    for name, schema in sorted(schemas.items()):
        stores.setdefault(target.store(schema), []).append(name)

    def tagged(store: str) -> DataFrame:
        names = stores[store]
        rows = staged.where(F.col("route").isin(names)).withColumnRenamed("route", ROUTE)
        return tag_object(rows, schemas[names[0]], keep=[ROUTE])

    if mode == "strict" and stores:
        wrong = reduce(DataFrame.unionAll, [bad_rows(tagged(store)) for store in stores]).take(1)
        if wrong:
            raise ValueError(f"rejected row: {wrong[0]['reject_reason']}; see {folder}")
    target.create(spark, schemas)
    rejected: dict[str, int] = {}

    def load(store: str) -> None:
        schema = schemas[stores[store][0]]

        def append(rows: DataFrame) -> bool:
            return append_load(rows, store, load_id, schema, target.path(store), repeated, ROUTE)

        # Rejects of all tables go to one table, so they are written together below.
        if mode == "strict":
            append(good_rows(tagged(store)))
            rejected[store] = 0
        else:
            rejected[store] = append_checked(tagged(store), append, lambda rows: None, mode)

    run_all(spark, load, list(stores), parallel)
    parts = [bad_rows(tagged(store)) for store in stores if rejected[store]]
    if some_unnamed:
        unknown = F.concat(F.lit("unknown table "), F.coalesce(table_name(), F.lit("(none)")))
        reason = F.when(F.is_valid_utf8("value"), unknown).otherwise("not UTF-8")
        parts.append(unnamed.select("value", reason.alias("reject_reason")))
    if parts:
        rejects = target.table(REJECTS)
        append_load(reduce(DataFrame.unionAll, parts), rejects, load_id, REJECT_SCHEMA, target.path(rejects), repeated)
    remove_path(spark, folder)
    return sorted(schemas)
