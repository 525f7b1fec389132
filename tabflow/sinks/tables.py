"""Table appends: columns by name, a declared schema, created when absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.coerce import conform, quoted


def create_if_needed(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None, partitions: tuple[str, ...] = ()) -> None:
    """An empty Parquet table with the declared columns, unless the table exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(map(quoted, partitions))})"
    if path:
        ddl += " LOCATION '" + path.replace("'", "\\'") + "'"
    spark.sql(ddl)


def append_table(df: DataFrame, table: str, schema: T.StructType, path: str | None = None) -> None:
    """Append to a table, created if needed. Matching is by name, never by position."""
    create_if_needed(df.sparkSession, table, schema, path)
    conform(df, schema).write.mode("append").saveAsTable(table)
