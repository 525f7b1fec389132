"""Summary of a query history per query code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import elapsed_ms
from ..functions.text import query_code

JOB_LOG_DDL = (
    "job_id string, creation_time timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz, "
    "total_bytes_processed bigint, total_bytes_billed bigint, job_type string, project_id string"
)


def _whole_mb(bytes_column: str) -> Column:
    return F.ceil(F.avg(bytes_column) / 1024 / 1024).cast("double")


def job_runs(jobs: DataFrame, start: datetime, end: datetime, project: str,
             prefix: str) -> DataFrame:
    """Query jobs of one project created and ended between ``start`` and ``end``, both included."""
    return jobs.where(
        F.col("creation_time").between(F.lit(start), F.lit(end))
        & F.col("end_time").between(F.lit(start), F.lit(end))
        & (F.col("job_type") == "QUERY")
        & F.col("job_id").startswith(prefix)
        & (F.col("project_id") == project)
    ).select(
        query_code(F.col("job_id"), prefix).alias("job_group"),
        "total_bytes_processed",
        "total_bytes_billed",
        elapsed_ms(F.col("start_time"), F.col("end_time")).alias("elapsed_millisecond"),
    )


def job_history_summary(jobs: DataFrame, start: datetime, end: datetime, project: str,
                        prefix: str) -> DataFrame:
    """Runs, mean MB processed and billed and mean milliseconds per code, rounded up."""
    return (
        job_runs(jobs, start, end, project, prefix)
        .groupBy("job_group")
        .agg(
            F.count("*").alias("num_exec"),
            _whole_mb("total_bytes_processed").alias("avg_mb_processed_per_run"),
            _whole_mb("total_bytes_billed").alias("avg_mb_billed_per_run"),
            F.ceil(F.avg("elapsed_millisecond")).cast("double").alias("avg_millisecond_per_run"),
        )
        .orderBy("job_group")
    )
