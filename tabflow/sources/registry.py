"""Schema registries, job configurations and schema files.

What reaches the driver is one configuration, or the schemas of the tables a load has rows for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import schema_from_fields, schema_from_text

REGISTRY_DDL = (
    "tablename string, "
    "schema struct<fields: array<struct<name: string, type: string, mode: string>>>"
)
CONFIG_DDL = "tablelist array<struct<sourcefile: string, targettable: string, schemauri: string>>"

@dataclass(frozen=True)
class LoadEntry:
    source: str
    target: str
    schema_uri: str


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line: a table name and its field list."""
    return spark.read.schema(REGISTRY_DDL).json(path, mode="FAILFAST")


def registry_schemas(registry: DataFrame, names: DataFrame | None = None) -> dict[str, T.StructType]:
    """``{table name: schema}`` of all tables, or of those in ``names`` (column tablename); each may be listed once."""
    wanted = registry if names is None else registry.join(names.select("tablename").distinct(), "tablename", "left_semi")
    rows = wanted.collect()
    schemas = {row["tablename"]: schema_from_fields(row["schema"]["fields"]) for row in rows}
    if len(schemas) < len(rows):
        raise ValueError("the registry lists a table twice")
    return schemas


def read_small_file(spark: SparkSession, path: str) -> str:
    """The text of one file, from any file system Spark can read."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content").limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"expected one non-empty file at {path}")
    return bytes(files[0]["content"]).decode("utf-8")


def read_schema_file(spark: SparkSession, path: str) -> T.StructType:
    """A file whose whole content is the ``name:TYPE`` text."""
    return schema_from_text(read_small_file(spark, path).strip())


def read_load_config(spark: SparkSession, path: str) -> list[LoadEntry]:
    """The ``tablelist`` of a load configuration, in order."""
    entries = (
        spark.read.schema(CONFIG_DDL)
        .json(path, multiLine=True, mode="FAILFAST")
        .select(F.explode("tablelist").alias("entry"))
        .select("entry.*")
        .collect()
    )
    return [LoadEntry(e["sourcefile"], e["targettable"], e["schemauri"]) for e in entries]
