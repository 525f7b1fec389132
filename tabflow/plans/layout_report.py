"""Run the nine lookups on the three layouts and compare what each one reads."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import Hasher, bucket_of, draw, stable_hash
from ..functions.text import query_code
from ..operators.sample import first_values
from ..session import fresh_path
from .job_history import JOB_LOG_DDL, job_history_summary
from .layouts import BUCKET, DATE, Layouts, lookup_many, run_lookup, write_parameters
from .scan_metrics import scan_reads

PROJECT, PREFIX = "layouts", "lookup"
RUN_DDL = JOB_LOG_DDL + ", rows_matched bigint, files_read bigint, rows_read bigint"
PARAMETER_DDL = "case_code string, customer string, day date"
Parameter = tuple[str, str | None, date | None]


def parameters(
    spark: SparkSession, layouts: Layouts, runs: int = 10, hasher: Hasher = stable_hash
) -> list[Parameter]:
    """(case, customer, day) of every run: the first ``runs`` customers, the first days, and ``runs`` pairs of
    both, drawn with replacement."""
    base = spark.table(layouts.date_clustered.table)
    customers = [r[0] for r in first_values(base, F.col("cust_identifier"), "cust_identifier", runs).collect()]
    days = [r[0] for r in first_values(base, F.col(DATE), "day", runs).collect()]
    if not customers or not days:
        return []
    run = F.col("id")
    pairs = spark.range(runs).select(draw(run, "customer", len(customers), hasher), draw(run, "day", len(days), hasher)).collect()
    return [*(("c1", c, None) for c in customers), *(("c2", None, d) for d in days),
            *(("c3", customers[i], days[j]) for i, j in pairs)]


def _parts(layouts: Layouts):
    return zip(("q1", "q2", "q3"), (layouts.date_clustered, layouts.bucketed, layouts.date_plain))


def lookup_matches(
    spark: SparkSession, layouts: Layouts, runs: int = 10, hasher: Hasher = stable_hash
) -> DataFrame:
    """Rows the lookups of a report find, per query code: each layout is joined with the parameters, once per case."""
    drawn = spark.createDataFrame(parameters(spark, layouts, runs, hasher), PARAMETER_DDL)
    wanted = write_parameters(drawn, fresh_path(spark, "lookup-parameters"))
    counts = None
    for part, layout in _parts(layouts):
        for case in ("c1", "c2", "c3"):
            found = lookup_many(spark, layout, wanted, case).select(F.lit(case + part).alias("job_group"), F.lit(1).alias("found"))
            counts = found if counts is None else counts.unionAll(found)
    matched = counts.groupBy("job_group").agg(F.sum("found").alias("rows_matched"))
    parts = F.explode(F.array(*[F.lit(p) for p in ("q1", "q2", "q3")]))
    runs_of = wanted.groupBy("case_code").agg(F.count("*").alias("num_exec")).select(
        F.col("case_code"), parts.alias("part"), "num_exec").select(F.concat("case_code", "part").alias("job_group"), "num_exec")
    return runs_of.join(matched, "job_group", "left").select("job_group", "num_exec", F.coalesce("rows_matched", F.lit(0)).alias("rows_matched"))


def rows_at_most(spark: SparkSession, layouts: Layouts, drawn: list[Parameter]) -> DataFrame:
    """The rows of the partitions that the lookups of a code name, summed over its runs: more than that no run reads."""
    wanted = spark.createDataFrame(drawn, PARAMETER_DDL)
    bounds = None
    for part, layout in _parts(layouts):
        rows = spark.table(layout.table)
        sizes = rows.groupBy(F.col(DATE if layout.by_date else BUCKET).alias("_partition")).agg(F.count("*").alias("n"))
        customer = F.col("customer")
        own = F.col("day") if layout.by_date else F.when(customer.isNotNull(), bucket_of(customer, layout.buckets, layout.hasher))
        some = wanted.withColumn("_own", own).join(sizes, F.col("_own") == F.col("_partition"), "left")
        # A lookup that doesn't name the partition column may read all.
        own_rows = F.when(F.col("_own").isNull(), F.lit(rows.count())).otherwise(F.coalesce("n", F.lit(0)))
        bound = some.groupBy(F.concat("case_code", F.lit(part)).alias("job_group")).agg(F.sum(own_rows).alias("rows_at_most"))
        bounds = bound if bounds is None else bounds.unionAll(bound)
    return bounds


def _measure(spark: SparkSession, layouts: Layouts, code: str, customer, day) -> tuple:
    """One run as a job-log row. The aggregate reads every output column, but returns one row."""
    total = run_lookup(spark, layouts, code, customer, day).selectExpr("count(*) AS n", "bit_xor(xxhash64(*)) AS checksum")
    job_id = f"{PREFIX}_{code}_{uuid.uuid4().hex}"
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    matched = total.collect()[0]["n"]
    end = datetime.now(timezone.utc).replace(tzinfo=None)
    read = scan_reads(total)
    return job_id, start, start, end, read.bytes, read.bytes, "QUERY", PROJECT, matched, read.files, read.rows


def run_lookups(
    spark: SparkSession, layouts: Layouts, runs: int = 10, hasher: Hasher = stable_hash, drawn: list[Parameter] | None = None
) -> DataFrame:
    """The nine lookups with ``runs`` parameters each: a job log with the rows found, and the files, bytes and rows read."""
    chosen = drawn if drawn is not None else parameters(spark, layouts, runs, hasher)
    log = [_measure(spark, layouts, case + part, customer, day) for case, customer, day in chosen for part in ("q1", "q2", "q3")]
    return spark.createDataFrame(log, RUN_DDL)


def layout_report(spark: SparkSession, layouts: Layouts, runs: int = 10, hasher: Hasher = stable_hash) -> DataFrame:
    """The job-history summary of the runs, with rows and files per code and the most rows that may be read."""
    drawn = parameters(spark, layouts, runs, hasher)
    log = run_lookups(spark, layouts, runs, hasher, drawn)
    reads = log.groupBy(query_code(F.col("job_id"), PREFIX).alias("job_group")).agg(
        F.sum("rows_matched").alias("rows_matched"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("files_read").alias("files_read"),
    )
    summary = job_history_summary(log, datetime(1970, 1, 1), datetime(9999, 1, 1), PROJECT, PREFIX)
    return summary.join(reads, "job_group").join(rows_at_most(spark, layouts, drawn), "job_group").orderBy("job_group")
