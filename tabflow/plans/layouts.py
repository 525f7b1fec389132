"""One table in three physical layouts, and nine lookups over them.

Layouts are sorted by range, not by hash: a date, customer or bucket holding a
large share of the rows becomes many files of neighbouring ranges rather than the
work of one task, and a file's min/max lets a lookup skip it. The input partition
number is the last range column, so that even copies of one row spread out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_of
from ..functions.hashing import Hasher, bucket_of, stable_hash
from ..functions.ranges import Number, partitions_of, range_partition
from ..sources.tables import table_folder

DATE = "tstamp_date"
BUCKET = "cust_identifier_bucket"
_SPREAD = "_spread"
PAGE_ROWS = 20_000  # the Parquet writer's own default


def _save(df: DataFrame, table: str, path: str | None, partition: str, page_rows: int = PAGE_ROWS) -> None:
    """Write a layout whose lookups by customer skip row groups and pages.

    A row group has a bloom filter of its customers, of the least size that serves (one that holds a dictionary
    of all its customers needs none). Pages hold at most ``page_rows`` rows: where rows are sorted by customer, the page index leads to the few
    pages that hold one. Small pages read less and store a little more.
    """
    options = {"parquet.bloom.filter.enabled#cust_identifier": "true", "parquet.bloom.filter.adaptive.enabled": "true",
               "parquet.page.row.count.limit": str(page_rows)}
    writer = df.write.format("parquet").mode("errorifexists").options(**options).partitionBy(partition)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def cluster_by_range(df: DataFrame, partition: str, cluster: str, tasks: int | None = None) -> DataFrame:
    """Tasks of neighbouring (partition, cluster) ranges, sorted within.

    The range bounds come from a sample, at the price of one more pass over the
    input: store an input that is costly to compute before. ``tasks`` defaults to the
    shuffle setting, merged by AQE where small.
    """
    keys = [partition, cluster, _SPREAD]
    spread = df.withColumn(_SPREAD, F.spark_partition_id())
    ranged = spread.repartitionByRange(tasks, *keys) if tasks else spread.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(partition, cluster).drop(_SPREAD)


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, date_of(F.col("tstamp")))


def with_bucket(df: DataFrame, buckets: int, hasher: Hasher = stable_hash) -> DataFrame:
    """The customer's bucket in front of all columns."""
    return df.select(bucket_of(F.col("cust_identifier"), buckets, hasher).alias(BUCKET), "*")


def write_date_clustered(df: DataFrame, table: str, path: str | None = None,
                         tasks: int | None = None, page_rows: int = PAGE_ROWS) -> None:
    """Date partitions, clustered by customer."""
    _save(cluster_by_range(with_date(df), DATE, "cust_identifier", tasks), table, path, DATE, page_rows)


def write_bucketed(df: DataFrame, table: str, path: str | None = None, buckets: int = 4000,
                   tasks: int | None = None, hasher: Hasher = stable_hash, page_rows: int = PAGE_ROWS) -> None:
    """Customer-bucket partitions, clustered by time.

    4000 buckets suit a large table; choose fewer where a bucket would fall below a file.
    """
    _save(cluster_by_range(with_bucket(df, buckets, hasher), BUCKET, "tstamp", tasks), table, path, BUCKET, page_rows)


def range_column(column: str) -> str:
    return f"{column}_range"


def write_ranges(df: DataFrame, table: str, column: str, boundaries: Sequence[Number], path: str | None = None,
                 cluster: str = "tstamp", tasks: int | None = None, page_rows: int = PAGE_ROWS) -> None:
    """Partitions between the boundaries of a column, clustered by another; what lies outside, and NULL, is one more partition."""
    ranged = df.withColumn(range_column(column), range_partition(F.col(column), boundaries))
    _save(cluster_by_range(ranged, range_column(column), cluster, tasks), table, path, range_column(column), page_rows)


def lookup_range(spark: SparkSession, table: str, column: str, boundaries: Sequence[Number],
                 low: Number | None = None, high: Number | None = None) -> DataFrame:
    """Rows with a value from ``low`` to ``high``, both included, of a table by ``write_ranges``, from the partitions that can hold them."""
    rows = spark.table(table).where(F.col(range_column(column)).isin(partitions_of(boundaries, low, high)))
    rows = rows if low is None else rows.where(F.col(column) >= low)
    return rows if high is None else rows.where(F.col(column) <= high)


def write_bucket_by(df: DataFrame, table: str, path: str | None = None, buckets: int = 4000,
                    tasks: int | None = None) -> None:
    """Customer buckets as Spark's own bucketed table, sorted by time.

    Lookups by customer prune buckets without a predicate on a bucket column. Rows are brought
    together by the hash Spark buckets with, so a task writes few files and a hot bucket has
    several. A read as a bucketed table is one task per bucket, a hot one too: for whole-table work
    such as counts by customer read it with ``split_scan``.
    """
    bucket = F.pmod(F.hash("cust_identifier"), F.lit(buckets))
    ranged = cluster_by_range(df.withColumn(BUCKET, bucket), BUCKET, "tstamp", tasks).drop(BUCKET)
    writer = ranged.write.format("parquet").mode("errorifexists")
    writer = writer.bucketBy(buckets, "cust_identifier").sortBy("tstamp")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def split_scan(spark: SparkSession, table: str) -> DataFrame:
    """A bucketed table's files as plain Parquet: large ones are split, whatever bucket they are in."""
    return spark.read.schema(spark.table(table).schema).parquet(table_folder(spark, table))


def count_by_customer(spark: SparkSession, table: str) -> DataFrame:
    """Rows per customer: partial counts over a split scan, then a shuffle of one row per customer and task."""
    return split_scan(spark, table).groupBy("cust_identifier").agg(F.count("*").alias("n_rows"))


def write_date_plain(df: DataFrame, table: str, path: str | None = None, page_rows: int = PAGE_ROWS) -> None:
    """Date partitions without clustering; AQE cuts a large date into several files."""
    _save(with_date(df).hint("rebalance", F.col(DATE)), table, path, DATE, page_rows)


@dataclass(frozen=True)
class Layout:
    """A stored layout and the partition predicate its lookups imply."""

    table: str
    by_date: bool = False
    buckets: int | None = None
    hasher: Hasher = stable_hash

    def pruned(self, spark: SparkSession, customer: str | None, day: date | None) -> DataFrame:
        """The table cut to the partitions that can hold the wanted rows."""
        df = spark.table(self.table)
        if self.by_date and day is not None:
            df = df.where(F.col(DATE) == F.lit(day))
        if self.buckets and customer is not None:
            df = df.where(F.col(BUCKET) == bucket_of(F.lit(customer), self.buckets, self.hasher))
        return df

    def latest_date(self, spark: SparkSession) -> date | None:
        """The latest date with a row, from the partition list; one row of a partition is read to see that it has any."""
        if not self.by_date:
            raise ValueError("the table must be partitioned by date")
        spark.catalog.refreshTable(self.table)
        listed = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        days = sorted((date.fromisoformat(d) for d in listed if d != "__HIVE_DEFAULT_PARTITION__"), reverse=True)
        return next((day for day in days if not self.pruned(spark, None, day).isEmpty()), None)


@dataclass(frozen=True)
class Layouts:
    date_clustered: Layout
    bucketed: Layout
    date_plain: Layout


def some_random_calc() -> Column:
    """NULL if any attribute is; an overflow fails under ANSI."""
    return (F.col("attr1") + F.col("attr2") - F.col("attr3")).alias("some_random_calc")


def computed(df: DataFrame) -> DataFrame:
    return df.select("cust_identifier", "tstamp", some_random_calc())


def lookup(spark: SparkSession, layout: Layout, customer: str | None = None,
           day: date | None = None) -> DataFrame:
    """Rows of one customer, one date, or both, with named query parameters."""
    terms, args = [], {}
    if day is not None:
        terms.append("to_date(tstamp) = :dt")
        args["dt"] = day
    if customer is not None:
        terms.append("cust_identifier = :cust")
        args["cust"] = customer
    if not terms:
        raise ValueError("a lookup needs a customer, a day or both")
    return spark.sql(
        "SELECT cust_identifier, tstamp, attr1 + attr2 - attr3 AS some_random_calc "
        "FROM {source} WHERE " + " AND ".join(terms),
        args=args,
        source=layout.pruned(spark, customer, day),
    )


def write_parameters(parameters: DataFrame, path: str) -> DataFrame:
    """A stored list of lookups: case_code (c1, c2 or c3), customer, day.

    Stored, so that Spark filters it by case at run time and prunes the partitions of a table it is joined with by what is left.
    """
    parameters.select("case_code", "customer", "day").coalesce(1).write.parquet(path)
    return parameters.sparkSession.read.parquet(path)


def lookup_many(spark: SparkSession, layout: Layout, parameters: DataFrame, case: str) -> DataFrame:
    """All lookups of a case in one job: their customer and day, and the rows found, once for each lookup that finds them.

    The lookups' dates and buckets prune the partitions (dynamic partition pruning), as one lookup's do.
    """
    rows = spark.table(layout.table)
    wanted = parameters.where(F.col("case_code") == case)
    terms = []
    if case in ("c1", "c3"):
        terms.append(F.col("cust_identifier") == F.col("customer"))
        if layout.buckets:
            wanted = wanted.withColumn("_bucket", bucket_of(F.col("customer"), layout.buckets, layout.hasher))
            terms.append(F.col(BUCKET) == F.col("_bucket"))
    if case in ("c2", "c3"):
        terms.append((F.col(DATE) if layout.by_date else date_of(F.col("tstamp"))) == F.col("day"))
    if not terms:
        raise ValueError(f"case must be c1, c2 or c3, not {case!r}")
    return rows.join(wanted, terms).select("customer", "day", "cust_identifier", "tstamp", some_random_calc())


def run_lookup(spark: SparkSession, layouts: Layouts, code: str, customer: str | None = None,
               day: date | None = None) -> DataFrame:
    """One of the nine lookups by its code: case 1 customer, 2 date, 3 both."""
    case, query = code[:2], code[2:]
    layout = {"q1": layouts.date_clustered, "q2": layouts.bucketed, "q3": layouts.date_plain}[query]
    return lookup(
        spark,
        layout,
        customer=customer if case in ("c1", "c3") else None,
        day=day if case in ("c2", "c3") else None,
    )


LOOKUP_CODES = ("c1q1", "c1q2", "c1q3", "c2q1", "c2q2", "c2q3", "c3q1", "c3q2", "c3q3")
