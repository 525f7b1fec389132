import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabflow.operators.counts import count_lines, count_per_country, count_per_window, latest_date
from tabflow.plans.job_history import JOB_LOG_DDL, job_history_summary
from tabflow.plans.layout_report import PARAMETER_DDL, layout_report, lookup_matches, parameters, run_lookups
from tabflow.plans.layouts import (
    LOOKUP_CODES,
    Layout,
    Layouts,
    computed,
    count_by_customer,
    lookup,
    lookup_many,
    lookup_range,
    run_lookup,
    split_scan,
    write_bucket_by,
    write_bucketed,
    write_date_clustered,
    write_date_plain,
    write_parameters,
    write_ranges,
)
from tabflow.plans.scan_metrics import scan_reads
from tabflow.functions.ranges import partitions_of, range_bucket, range_partition
from tabflow.functions.text import query_code

DAY = datetime.date(2024, 1, 2)


@pytest.fixture(scope="module")
def base(spark):
    """Half of the rows belong to customer "hot" on one day, a third are copies of one row."""
    i = F.col("id")
    hot = i % 2 == 0
    copy = i % 3 == 0
    day = F.when(hot | copy, 1).otherwise(i % 5).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    second = F.when(copy, 7).otherwise(i % 80000).cast("int")
    return spark.range(0, 40_000, 1, 8).select(
        F.when(hot | copy, F.lit("hot")).otherwise((i % 100).cast("string")).alias("cust_identifier"),
        F.timestamp_add("SECOND", second, F.timestamp_add("DAY", day, start)).alias("tstamp"),
        F.lit("BE").alias("country_code"),
        F.when(copy, 0).otherwise(i).cast("bigint").alias("attr1"),
        F.lit(2).cast("bigint").alias("attr2"),
        F.when(i % 11 != 0, 1).cast("bigint").alias("attr3"),
        *[F.lit(None).cast("bigint").alias(f"attr{n}") for n in range(4, 11)],
    )


@pytest.fixture(scope="module")
def layouts(spark, base, tmp_path_factory):
    root = tmp_path_factory.mktemp("layouts")
    result = Layouts(Layout("l_date", by_date=True), Layout("l_bucket", buckets=8), Layout("l_plain", by_date=True))
    write_date_clustered(base, "l_date", str(root / "date"), tasks=8)
    write_bucketed(base, "l_bucket", str(root / "bucket"), buckets=8, tasks=8)
    write_date_plain(base, "l_plain", str(root / "plain"))
    write_bucket_by(base, "l_bucket_by", str(root / "by"), buckets=8, tasks=8)
    return result


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("code", LOOKUP_CODES)
@pytest.mark.parametrize("customer", ["17", "hot", "nobody"])
def test_lookups(spark, base, layouts, code, customer):
    expected = base
    if code[:2] != "c2":
        expected = expected.where(F.col("cust_identifier") == customer)
    if code[:2] != "c1":
        expected = expected.where(F.to_date("tstamp") == F.lit(DAY))
    assert as_rows(run_lookup(spark, layouts, code, customer, DAY)) == as_rows(computed(expected))


@pytest.mark.parametrize("customer", ["17", "hot", "nobody"])
def test_lookups_in_a_bucketed_table(spark, base, layouts, customer):
    expected = base.where(F.col("cust_identifier") == customer)
    layout = Layout("l_bucket_by")
    assert as_rows(lookup(spark, layout, customer)) == as_rows(computed(expected))
    expected = expected.where(F.to_date("tstamp") == F.lit(DAY))
    assert as_rows(lookup(spark, layout, customer, DAY)) == as_rows(computed(expected))


def reads(df):
    df.collect()
    return scan_reads(df)


def test_a_bucketed_table_prunes_and_splits_a_hot_customer(spark, base, layouts):
    assert reads(lookup(spark, Layout("l_bucket_by"), "17").groupBy().count()).rows < 40_000 / 4
    counts = count_by_customer(spark, "l_bucket_by")
    assert as_rows(counts) == as_rows(base.groupBy("cust_identifier").count())
    # Most rows are one customer's, so of one bucket; they are read by more tasks than there are buckets.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert split_scan(spark, "l_bucket_by").rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lookup_needs_a_filter(spark, layouts):
    with pytest.raises(ValueError):
        lookup(spark, layouts.date_plain)


def test_layouts_keep_every_row(spark, base, layouts):
    wanted = as_rows(base)
    for table in ("l_date", "l_bucket", "l_plain", "l_bucket_by"):
        assert as_rows(spark.table(table).select(*base.columns)) == wanted


def test_a_hot_key_is_spread_over_tasks(spark, layouts):
    """No task may write more than about its share, hot day, customer or copies or not."""
    for table in ("l_date", "l_bucket", "l_bucket_by"):
        per_file = spark.table(table).groupBy("_metadata.file_name").count().collect()
        # All files of one task share the part number at the start of the name.
        per_task = {}
        for r in per_file:
            task = r["file_name"].split("-")[1]
            per_task[task] = per_task.get(task, 0) + r["count"]
        assert len(per_task) == 8 and max(per_task.values()) < 2 * 40_000 / 8


def test_clustering_narrows_files(spark, layouts):
    """Within a day, files hold neighbouring customers: a lookup by a rare one opens few rows."""
    files = (
        spark.table(layouts.date_clustered.table).where(F.to_date("tstamp") == F.lit(DAY))
        .groupBy("_metadata.file_name").agg(F.min("cust_identifier").alias("a"), F.max("cust_identifier").alias("b"))
    )
    spans = sorted((r["a"], r["b"]) for r in files.collect())
    assert all(left[1] <= right[0] for left, right in zip(spans, spans[1:]))


def test_report(spark, base, layouts):
    log = run_lookups(spark, layouts, runs=2).cache()
    assert log.count() == 18
    code = query_code(F.col("job_id"), "lookup").alias("code")
    matched = {r["code"]: r["n"] for r in log.groupBy(code).agg(F.sum("rows_matched").alias("n")).collect()}
    for case in ("c1", "c2", "c3"):
        assert len({matched[case + part] for part in ("q1", "q2", "q3")}) == 1
    assert {r["job_group"]: (r["num_exec"], r["rows_matched"]) for r in lookup_matches(spark, layouts, runs=2).collect()} == {
        c: (2, n) for c, n in matched.items()}
    report = {r["job_group"]: r for r in layout_report(spark, layouts, runs=2).collect()}
    assert sorted(report) == list(LOOKUP_CODES)
    assert all(r["num_exec"] == 2 for r in report.values())
    # Each layout reads less for the filter it is partitioned by, and never more than its partitions hold.
    assert [c for c, r in report.items() if not r["rows_matched"] <= r["rows_read"] <= r["rows_at_most"]] == []
    assert report["c1q2"]["rows_read"] < report["c1q3"]["rows_read"]
    assert report["c2q1"]["files_read"] < report["c2q2"]["files_read"]
    assert all(r["avg_mb_processed_per_run"] >= 1 for r in report.values())


def test_pairs_are_drawn_with_replacement(spark, layouts):
    drawn = parameters(spark, layouts, runs=40)
    days = {d for case, _, d in drawn if case == "c2"}
    assert len(days) < 40 and sum(case == "c3" for case, _, _ in drawn) == 40


def test_overflow_fails(spark):
    big = spark.createDataFrame([("a", None, 2**63 - 1, 1, 0)],
                                "cust_identifier string, tstamp timestamp, attr1 long, attr2 long, attr3 long")
    with pytest.raises(PySparkException):
        computed(big).collect()


def test_job_history_edges(spark):
    at = datetime.datetime
    start, end = at(2024, 1, 1, 10), at(2024, 1, 1, 11)
    one = at(2024, 1, 1, 10, 30)
    mb = 1024 * 1024

    def job(job_id, created=one, begun=one, ended=one, processed=mb, billed=mb, kind="QUERY", project="p"):
        return (job_id, created, begun, ended, processed, billed, kind, project)

    jobs = spark.createDataFrame([
        job("report_c1q1_a", created=start, ended=end, begun=end - datetime.timedelta(microseconds=1999)),
        job("report_c1q1_b", processed=None, billed=None),
        job("report_c1q1_c", processed=2 * mb + 1, billed=None),
        job("report_c1q1_d", ended=None),
        job("report_c1q1_e", kind="LOAD"),
        job("report_c1q1_f", project="other"),
        job("report_c1q1_g", created=start - datetime.timedelta(microseconds=1)),
        job("report_c1q1_h", ended=end + datetime.timedelta(microseconds=1)),
        job("Xpperf_c1q1_i"),
        job("report_c2q1_j"),
    ], JOB_LOG_DDL)
    rows = [tuple(r) for r in job_history_summary(jobs, start, end, "p", "report").collect()]
    assert rows == [("c1q1", 3, 2.0, 1.0, 1.0), ("c2q1", 1, 1.0, 1.0, 0.0)]


def test_the_query_code_follows_the_prefix(spark):
    ids = spark.createDataFrame([("report_c1q1_a", "look_c2q3_b")], "a string, b string")
    assert tuple(ids.select(query_code(F.col("a"), "report"), query_code(F.col("b"), "look")).collect()[0]) == ("c1q1", "c2q3")


def test_counts(spark):
    rows = spark.createDataFrame([("BE",), ("BE",), ("FR",), (None,)], "country_code string")
    counts = count_per_country(rows)
    assert {tuple(r) for r in counts.collect()} == {("BE", 2), ("FR", 1), (None, 1)}
    assert "BE: 2" in {r["value"] for r in count_lines(counts).collect()}


def test_windows_and_latest(spark):
    rows = spark.createDataFrame(
        [("BE", datetime.datetime(2024, 1, 1, 0, 0, s)) for s in (0, 59)]
        + [("BE", datetime.datetime(2024, 1, 1, 0, 1)), ("FR", datetime.datetime(2024, 1, 1, 0, 0, 30))],
        "country_code string, ts timestamp_ntz",
    )
    got = {(r["window_start"].minute, r["country_name"], r["num_cc_card"]) for r in count_per_window(rows, "ts").collect()}
    assert got == {(0, "BE", 2), (0, "FR", 1), (1, "BE", 1)}
    assert latest_date(rows, F.col("ts")).collect()[0][0] == datetime.date(2024, 1, 1)


@pytest.mark.parametrize("case", ["c1", "c2", "c3"])
def test_many_lookups_in_one_pruned_job(spark, base, layouts, case, tmp_path):
    """The same rows as one lookup after the other, and only the partitions that the parameters name."""
    drawn = [("c1", "17", None), ("c1", "nobody", None), ("c1", "33", None), ("c2", None, DAY), ("c2", None, datetime.date(1999, 1, 1)),
             ("c3", "17", DAY), ("c3", "hot", DAY), ("c3", "hot", DAY), ("c3", "33", datetime.date(2024, 1, 4))]
    wanted = write_parameters(spark.createDataFrame(drawn, PARAMETER_DDL), str(tmp_path / "wanted"))
    for layout in (layouts.date_clustered, layouts.bucketed, layouts.date_plain):
        found = lookup_many(spark, layout, wanted, case)
        one_by_one = [r for c, customer, day in drawn if c == case for r in lookup(spark, layout, customer, day).collect()]
        assert as_rows(found.select("cust_identifier", "tstamp", "some_random_calc")) == sorted(map(tuple, one_by_one), key=repr)
        names_partition = case != "c2" if layout.buckets else case != "c1"
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("dynamicpruning" in plan) == names_partition
        if names_partition:
            assert reads(found).rows < 40_000
    with pytest.raises(ValueError):
        lookup_many(spark, layouts.date_plain, wanted, "c4")


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    """Two days of 60,000 customers each, sorted by customer, with pages of 500 rows; one customer on one day only."""
    i = F.col("id")
    rows = spark.range(0, 120_000, 1, 4).select(
        F.when(i == 77_777, F.lit("rare")).otherwise(F.concat(F.lit("c"), F.lpad((i % 60_000).cast("string"), 6, "0"))).alias("cust_identifier"),
        F.timestamp_add("DAY", F.floor(i / 60_000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("tstamp"),
        *[i.alias(f"attr{n}") for n in range(1, 4)])
    write_date_clustered(rows, "l_pages", str(tmp_path_factory.mktemp("pages")), tasks=4, page_rows=500)
    return Layout("l_pages", by_date=True)


def test_a_customer_of_a_date_layout_is_found_in_few_pages(spark, pages):
    assert reads(lookup(spark, pages, "c000123")).rows <= 4 * 500
    assert reads(lookup(spark, pages, "rare")).rows <= 2 * 500
    # Absent, but between the customers that are there: no row group's statistics rule it out.
    assert reads(lookup(spark, pages, "c000123x")).rows == 0
    assert reads(lookup(spark, pages, "zz")).rows == 0


def test_latest_date_of_a_layout(spark, layouts, pages, tmp_path):
    assert layouts.date_clustered.latest_date(spark) == spark.table("l_date").agg(F.max("tstamp_date")).first()[0]
    assert pages.latest_date(spark) == datetime.date(2024, 1, 2)
    empty = spark.table("l_pages").where("false").drop("tstamp_date")
    write_date_clustered(empty, "l_empty", str(tmp_path / "empty"), tasks=1)
    assert Layout("l_empty", by_date=True).latest_date(spark) is None
    spark.sql("ALTER TABLE l_empty ADD PARTITION (tstamp_date = '2024-05-05')")  # listed, without a row
    assert Layout("l_empty", by_date=True).latest_date(spark) is None
    with pytest.raises(ValueError):
        layouts.bucketed.latest_date(spark)


@pytest.mark.parametrize("bounds", [[5, 10, 20, 35, 45], [1, 2, 3, 4], [0, 10], [-3.5, 0.0, 2.25], list(range(1, 4001))])
def test_range_buckets(spark, bounds):
    values = [None, -100, -4, -3, 0, 1, 2, 3, 4, 5, 7, 9, 10, 19, 20, 34, 35, 44, 45, 46, 3999, 4000, 5000]
    kind = "double" if isinstance(bounds[0], float) else "bigint"
    df = spark.createDataFrame([(None if v is None else float(v) if kind == "double" else v,) for v in values], f"v {kind}")
    rows = df.select("v", range_bucket(F.col("v"), bounds).alias("bucket"), range_partition(F.col("v"), bounds).alias("part")).collect()
    for r in rows:
        bucket = None if r["v"] is None else sum(b <= r["v"] for b in bounds)
        part = 0 if bucket in (None, 0, len(bounds)) else bucket
        assert (r["bucket"], r["part"]) == (bucket, part)
        if r["v"] is not None:
            assert partitions_of(bounds, r["v"], r["v"]) == [part]
    every = {r["v"]: r["part"] for r in rows if r["v"] is not None}
    for low in every:
        for high in every:
            touched = partitions_of(bounds, low, high)
            assert all(part in touched for v, part in every.items() if low <= v <= high)
    assert partitions_of(bounds, None, None) == list(range(len(bounds)))


@pytest.mark.parametrize("bounds", [[], [1], [1, 1], [2, 1]])
def test_boundaries_ascend(bounds):
    with pytest.raises(ValueError):
        range_bucket(F.lit(1), bounds) if bounds else partitions_of(bounds, 1, 1)


def test_a_range_lookup_opens_its_partition(spark, tmp_path):
    bounds = [10, 20, 30]
    i = F.col("id")
    rows = spark.range(0, 40).select(i.alias("v"), F.timestamp_seconds(i).alias("tstamp"), i.cast("string").alias("cust_identifier"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, "none")], "v bigint, tstamp timestamp, cust_identifier string"))
    write_ranges(rows, "l_ranges", "v", bounds, str(tmp_path / "ranges"))
    assert spark.table("l_ranges").count() == 41
    for low, high, parts in ((5, 5, 1), (10, 10, 1), (19, 19, 1), (30, 30, 1), (12, 25, 2), (None, 12, 2), (25, None, 2), (None, None, 3)):
        found = lookup_range(spark, "l_ranges", "v", bounds, low, high)
        want = [v for v in range(40) if (low is None or v >= low) and (high is None or v <= high)]
        assert sorted(r["v"] for r in found.collect() if r["v"] is not None) == want
        assert len({f.split("v_range=")[1].split("/")[0] for f in found.inputFiles()}) == parts
