"""Line-oriented scans. Paths are files, folders or globs; .gz, .bz2 and .zst decode by suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parse import tag_csv, tag_json


def read_lines(spark: SparkSession, path: str | list[str], checked: bool = True) -> DataFrame:
    """One row per line, column ``value``; a line that is not UTF-8 fails the job if ``checked``.

    Pass ``checked=False`` to a parser that shall reject such lines by itself.
    Only LF and CRLF end a line: Spark's default would also split at a lone CR.
    With a fixed separator large files still split into many tasks.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    without_cr = F.substring(value, F.lit(1), F.length(value) - 1)
    line = F.when(value.endswith("\r"), without_cr).otherwise(value)
    return lines.select((F.validate_utf8(line) if checked else line).alias("value"))


def read_csv_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines cut at every comma, fields taken by position; see ``tag_csv``."""
    return tag_csv(read_lines(spark, path, checked=False), schema)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """One JSON object per line, typed by the target schema; see ``tag_json``."""
    return tag_json(read_lines(spark, path, checked=False), schema, **options)
