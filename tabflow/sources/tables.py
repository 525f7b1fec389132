"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole catalog table; Catalyst drops the columns nobody selects."""
    return spark.table(name)


def table_folder(spark: SparkSession, table: str) -> str:
    """Where a table's files are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
