"""The registered queries: ``(spark, sf_dir) -> DataFrame``, by key."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import credit
from ..functions.dates import date_of, elapsed_ms
from ..functions.hashing import portable_hash
from ..functions.schema import (
    ACCOUNT_SCHEMA,
    COUNT_SCHEMA,
    schema_from_fields,
    schema_from_text,
)
from ..functions.text import decode_utf8, encode_utf8, query_code, to_json_line
from ..operators.accounts import account_columns
from ..operators.counts import count_lines, count_per_country, count_per_window, latest_date
from ..operators.parse import accept_all, parse_object, tag_json
from ..operators.registry_join import table_name, unknown_messages, with_registry
from ..operators.replicate import shift_replicate
from ..operators.sample import first_values, pick_values, sample_rows
from ..plans.ingest import append_parsed, count_accounts_job, load_csv_job, load_tables_job
from ..plans.job_history import job_history_summary
from ..plans.layout_report import PARAMETER_DDL, layout_report, lookup_matches, parameters
from ..plans.layouts import (
    LOOKUP_CODES,
    Layout,
    computed,
    count_by_customer,
    lookup,
    lookup_many,
    lookup_range,
    run_lookup,
    with_bucket,
    write_bucket_by,
    write_bucketed,
    write_date_clustered,
    write_date_plain,
    write_parameters,
    write_ranges,
)
from ..plans.routing import REJECTS, Target, route_counts
from ..plans.synthetic import replicate_day_job
from ..session import fresh_path, own_session
from ..sinks.files import publish_messages, write_lines, write_ndjson
from ..sinks.loads import fold_days, read_loads
from ..sinks.tables import append_table
from ..sources.lines import read_csv_positional, read_lines, read_ndjson
from ..sources.messages import message_stream
from ..sources.registry import read_registry
from ..sources.tables import read_table
from ..streaming.ingest import append_stream, ingest_accounts, ingest_and_count, parse_accounts, tap_keys
from ..streaming.router import route_stream
from ..streaming.windows import (
    count_accounts_stream,
    count_windows_stream,
    final_windows,
    final_windows_stream,
    fold_windows,
    late_counts,
    window_counts,
)
from . import relations as rel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; the oracles use the same.
CUSTOMER, DAY = "7", date(2024, 1, 15)
REPLICATE_DAY, ITERATIONS, RATE = date(1997, 10, 31), 5, 0.4
SAMPLE_RATE = 0.3
HISTORY_START, HISTORY_END = datetime(2024, 1, 3), datetime(2024, 1, 27, 12, 30)
TODAY = date(2024, 1, 15)
BOUNDARIES = (5, 10, 20, 35, 45)  # of a quantity from 1 to 50
RANGES = ((3, 3), (10, 10), (36, 44), (45, 45), (19, 20), (50, 50))  # below, on, between and above the boundaries


def query(key: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        # A query needs settings that the caller's session shall not get.
        QUERIES[key] = lambda spark, sf_dir: function(own_session(spark), sf_dir)
        return function

    return register


def _zoneless(df: DataFrame, column: str = "tstamp") -> DataFrame:
    """An instant as the UTC wall time, the form the given tables hold."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def _fresh_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """An unused table name and its folder."""
    path = fresh_path(spark, name)
    return path.rpartition("/")[2].replace("-", "_"), path


def _part_of(value) -> Column:
    """A message of the table the registry does not list, as that table's columns."""
    return F.from_json(value, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """All columns of all parts; a part has NULL in the others' columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Scans

@query("scan_table")
def scan_table(spark, sf_dir):
    name = rel.once(spark, sf_dir, "orders table", lambda: _fresh_table(spark, "orders")[0])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{sf_dir}/orders.parquet'")
    return read_table(spark, name)


@query("scan_text")
def scan_text(spark, sf_dir):
    return read_lines(spark, rel.document_lines(spark, sf_dir))


@query("scan_csv_positional")
def scan_csv_positional(spark, sf_dir):
    table, path = _fresh_table(spark, "scenario")
    load_csv_job(spark, rel.scenario_lines(spark, sf_dir), table, "run-1", path)
    return read_loads(spark, table)


@query("typed_literals")
def typed_literals(spark, sf_dir):
    """Lines with literals that a cast would change: rejects, each with its reason, beside the good rows."""
    table, path = _fresh_table(spark, "literals")
    tagged = read_csv_positional(spark, rel.literal_lines(spark, sf_dir), rel.LITERAL_SCHEMA)
    append_parsed(tagged, table, rel.LITERAL_SCHEMA, path, "permissive", "run-1")
    key = F.split("value", ",")[0].cast("bigint")
    rejects = read_loads(spark, f"{table}_rejects").select(key.alias("key"), "reject_reason")
    return _side_by_side([_zoneless(read_loads(spark, table), "seen"), rejects])


@query("scan_ndjson")
def scan_ndjson(spark, sf_dir):
    schema = schema_from_text(rel.ROUTED["shop:sales.orders"].split(", ", 1)[1])

    def make():
        path = fresh_path(spark, "orders-ndjson")
        write_ndjson(rel.table(spark, sf_dir, "orders"), path)
        return path

    path = rel.once(spark, sf_dir, "orders ndjson", make)
    return accept_all(read_ndjson(spark, path, schema))


@query("stream_source")
def stream_source(spark, sf_dir):
    table, path = _fresh_table(spark, "stream_source")
    stream = message_stream(spark, rel.event_messages(spark, sf_dir), maxFilesPerTrigger="1")
    fields = schema_from_text("event_id:INT64, ts:DATETIME, user_id:INT64, event_type:STRING, value:FLOAT64, props:STRING")
    append_stream(accept_all(tag_json(stream, fields)), table, path, path + "-checkpoint", drain=True).awaitTermination()
    return read_loads(spark, table)


@query("registry_lookup")
def registry_lookup(spark, sf_dir):
    messages = parse_object(read_lines(spark, rel.routed_messages(spark, sf_dir)))
    registry = read_registry(spark, rel.registry_path(spark, sf_dir))
    joined = with_registry(messages.select(table_name().alias("tablename"), "value"), registry)
    return joined.groupBy("tablename").agg(
        F.count("*").alias("n_messages"), F.coalesce(F.max(F.array_size("schema.fields")), F.lit(0)).alias("n_fields")
    )


@query("unknown_table_rejects")
def unknown_table_rejects(spark, sf_dir):
    messages = parse_object(read_lines(spark, rel.routed_messages(spark, sf_dir)))
    registry = read_registry(spark, rel.registry_path(spark, sf_dir))
    unknown = unknown_messages(messages.select(table_name().alias("tablename"), "value"), registry)
    return unknown.select("tablename", _part_of(F.col("value")).alias("p")).select("tablename", "p.*")


# Table sinks and routed loads

@query("append_table")
def append_table_by_name(spark, sf_dir):
    table, path = _fresh_table(spark, "appended")
    schema = schema_from_text("c_custkey:INT64, c_name:STRING, c_acctbal:FLOAT64, note:STRING")
    customer = rel.table(spark, sf_dir, "customer")
    append_table(customer.select("c_name", "c_acctbal", "c_custkey"), table, schema, path)
    append_table(
        customer.select(F.lit("again").alias("note"), F.col("c_custkey").cast("string"), "c_name"),
        table, schema, path,
    )
    return spark.table(table)


@query("multi_table_load")
def multi_table_load(spark, sf_dir):
    root = fresh_path(spark, "loaded")
    config = rel.load_config(spark, sf_dir)
    for _ in range(2):  # a rerun of the same run adds nothing
        entries = load_tables_job(spark, config, "run-1", table_path=root)
    parts = [read_loads(spark, e.target).withColumn("target", F.lit(e.target.rpartition("_")[2])) for e in entries]
    return _side_by_side(parts)


@query("route_by_table")
def route_by_table(spark, sf_dir):
    root = fresh_path(spark, "routed")
    registry = read_registry(spark, rel.registry_path(spark, sf_dir))
    target = Target(root, registry, prefix=root[-12:].join(("t_", "_")))
    messages = message_stream(spark, rel.routed_messages(spark, sf_dir))
    route_stream(messages, target, f"{root}/checkpoint", f"{root}/stage",
                 mode="permissive", drain=True).awaitTermination()
    rejects = target.read(spark, REJECTS).select("reject_reason", _part_of(F.col("value")).alias("p"))
    return _side_by_side([target.read(spark, name) for name in rel.ROUTED] + [rejects.select("reject_reason", "p.*")])


@query("route_counts")
def route_counts_by_table(spark, sf_dir):
    registry = read_registry(spark, rel.registry_path(spark, sf_dir))
    return route_counts(read_lines(spark, rel.routed_messages(spark, sf_dir)), registry)


@query("damaged_messages")
def damaged_messages(spark, sf_dir):
    """Messages of which every fifth isn't UTF-8: good rows and rejects of a permissive stream."""
    table, path = _fresh_table(spark, "damaged")
    messages = message_stream(spark, rel.damaged_messages(spark, sf_dir), maxFilesPerTrigger="1")
    ingest_accounts(messages, table, path, path + "-checkpoint", "permissive", drain=True).awaitTermination()
    emp_id = F.regexp_extract("value", r'"emp_id":"(\w+)"', 1)
    rejects = read_loads(spark, f"{table}_rejects").select(emp_id.alias("emp_id"), "reject_reason")
    return _side_by_side([read_loads(spark, table), rejects])


# File and topic sinks

@query("sink_text")
def sink_text(spark, sf_dir):
    path = fresh_path(spark, "sink-text")
    counts = count_per_country(rel.accounts(spark, sf_dir))
    write_lines(count_lines(counts), F.col("value"), path)
    return read_lines(spark, path)


@query("sink_ndjson")
def sink_ndjson(spark, sf_dir):
    path = fresh_path(spark, "sink-ndjson")
    write_ndjson(rel.table(spark, sf_dir, "customer"), path)
    return spark.read.schema(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ).json(path)


@query("sink_messages")
def sink_messages(spark, sf_dir):
    path = fresh_path(spark, "sink-messages")
    publish_messages(rel.accounts(spark, sf_dir), path, fmt="text")
    return parse_accounts(read_lines(spark, path))


# Row parsing and scalar functions

@query("parse_account_json")
def parse_account_json(spark, sf_dir):
    return parse_accounts(read_lines(spark, rel.account_messages(spark, sf_dir)))


@query("parse_json_registry")
def parse_json_registry(spark, sf_dir):
    fields = [{"name": "k", "type": "INT64", "mode": "NULLABLE"}]
    messages = rel.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return accept_all(tag_json(messages, schema_from_fields(fields), keep=["event_id"]))


@query("utf8_roundtrip")
def utf8_roundtrip(spark, sf_dir):
    payload = rel.table(spark, sf_dir, "documents").select("doc_id", encode_utf8(F.col("text")).alias("payload"))
    return payload.select("doc_id", decode_utf8(F.col("payload")).alias("text"),
                          F.octet_length("payload").cast("bigint").alias("n_bytes"))


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    events = rel.table(spark, sf_dir, "events")
    lines = events.select(to_json_line("event_id", "ts", "user_id", "event_type", "value", "props").alias("value"))
    return accept_all(tag_json(lines, events.schema))


@query("computed_column")
def computed_column(spark, sf_dir):
    return computed(rel.demo_lineitem(spark, sf_dir))


@query("bucket_column")
def bucket_column(spark, sf_dir):
    return with_bucket(rel.demo_lineitem(spark, sf_dir), 4000, portable_hash)


@query("extract_date")
def extract_date(spark, sf_dir):
    return rel.demo_lineitem(spark, sf_dir).select("attr4", "attr2", date_of(F.col("tstamp")).alias("day"))


@query("elapsed_ms")
def elapsed_milliseconds(spark, sf_dir):
    return rel.job_log(spark, sf_dir).select(
        "job_id", elapsed_ms(F.col("start_time"), F.col("end_time")).alias("elapsed_millisecond")
    )


@query("job_group")
def job_group(spark, sf_dir):
    return rel.job_log(spark, sf_dir).select("job_id", query_code(F.col("job_id"), rel.JOB_PREFIX).alias("job_group"))


# Counts

@query("count_per_country")
def accounts_per_country(spark, sf_dir):
    return count_per_country(rel.accounts(spark, sf_dir))


@query("count_per_country_table")
def count_per_country_table(spark, sf_dir):
    source, source_path = _fresh_table(spark, "accounts")
    target, target_path = _fresh_table(spark, "counts")
    append_table(rel.accounts(spark, sf_dir), source, ACCOUNT_SCHEMA, source_path)
    count_accounts_job(spark, source, target, "run-1", target_path)
    return read_loads(spark, target)


@query("format_count")
def format_count(spark, sf_dir):
    events = rel.table(spark, sf_dir, "events")
    return count_lines(count_per_country(events, key="event_type"))


@query("window_count_batch")
def window_count_batch(spark, sf_dir):
    return count_per_window(rel.table(spark, sf_dir, "events"), "ts", key="event_type")


@query("latest_date")
def latest_partition_date(spark, sf_dir):
    return latest_date(rel.demo_lineitem(spark, sf_dir), F.col("tstamp"))


@query("latest_partition")
def latest_partition(spark, sf_dir):
    """From the partitions of a stored layout: nothing but one row of the latest is read."""
    day = rel.layouts(spark, sf_dir).date_clustered.latest_date(spark)
    return spark.createDataFrame([(day,)], "latest_date date")


@query("job_history_summary")
def job_history_by_code(spark, sf_dir):
    return job_history_summary(rel.job_log(spark, sf_dir), HISTORY_START, HISTORY_END, "shop", rel.JOB_PREFIX)


# Layouts and lookups

@query("layout_date_cust")
def layout_date_cust(spark, sf_dir):
    table, path = _fresh_table(spark, "layout_date")
    write_date_clustered(rel.demo_events(spark, sf_dir), table, path)
    return _zoneless(spark.table(table))


@query("layout_bucket_ts")
def layout_bucket_ts(spark, sf_dir):
    table, path = _fresh_table(spark, "layout_bucket")
    write_bucketed(rel.demo_events(spark, sf_dir), table, path, rel.BUCKETS, hasher=portable_hash)
    return _zoneless(spark.table(table))


@query("layout_bucket_by")
def layout_bucket_by(spark, sf_dir):
    table, path = _fresh_table(spark, "layout_bucket_by")
    write_bucket_by(rel.demo_events(spark, sf_dir), table, path, rel.BUCKETS)
    return _zoneless(spark.table(table))


@query("count_by_customer")
def customer_counts(spark, sf_dir):
    return count_by_customer(spark, rel.bucketed_table(spark, sf_dir))


@query("layout_date_plain")
def layout_date_plain(spark, sf_dir):
    table, path = _fresh_table(spark, "layout_plain")
    write_date_plain(rel.demo_events(spark, sf_dir), table, path)
    return _zoneless(spark.table(table))


def _lookup(code: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(run_lookup(spark, rel.layouts(spark, sf_dir), code, CUSTOMER, DAY))


for _code in LOOKUP_CODES:
    query(f"lookup_{_code}")(partial(_lookup, _code))


@query("lookup_bucket_by")
def lookup_bucket_by(spark, sf_dir):
    layout = Layout(rel.bucketed_table(spark, sf_dir))
    return _zoneless(lookup(spark, layout, CUSTOMER, DAY))


def _lookup_many(case: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lookups of a case on every layout, one pruned job for each."""
    layouts = rel.layouts(spark, sf_dir)

    def make() -> str:
        path = fresh_path(spark, "lookup-parameters")
        write_parameters(spark.createDataFrame(parameters(spark, layouts, hasher=portable_hash), PARAMETER_DDL), path)
        return path

    wanted = spark.read.parquet(rel.once(spark, sf_dir, "lookup parameters", make))
    parts = (("q1", layouts.date_clustered), ("q2", layouts.bucketed), ("q3", layouts.date_plain))
    found = [lookup_many(spark, layout, wanted, case).select(F.lit(case + part).alias("job_group"), "*") for part, layout in parts]
    return _zoneless(reduce(DataFrame.unionByName, found))


for _case in ("c1", "c2", "c3"):
    query(f"lookup_many_{_case}")(partial(_lookup_many, _case))


def _ranges_table(spark: SparkSession, sf_dir: str) -> str:
    table, path = _fresh_table(spark, "ranges")
    write_ranges(rel.demo_lineitem(spark, sf_dir), table, "attr1", BOUNDARIES, path)
    return table


@query("layout_ranges")
def layout_ranges(spark, sf_dir):
    return spark.table(_ranges_table(spark, sf_dir))


@query("lookup_ranges")
def lookup_ranges(spark, sf_dir):
    table = rel.once(spark, sf_dir, "ranges", lambda: _ranges_table(spark, sf_dir))
    found = [lookup_range(spark, table, "attr1", BOUNDARIES, low, high).select(
        F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high"), "attr4", "attr2", "attr1", "attr1_range")
        for low, high in RANGES]
    return reduce(DataFrame.unionByName, found)


@query("layout_report")
def layout_comparison(spark, sf_dir):
    """The columns of the report that don't depend on the machine, and whether the measured ones lie where they must."""
    report = layout_report(spark, rel.layouts(spark, sf_dir), hasher=portable_hash)
    within = F.col("rows_read").between(F.col("rows_matched"), F.col("rows_at_most")) & (F.col("avg_mb_processed_per_run") >= 1)
    timed = (F.col("avg_millisecond_per_run") > 0) & (F.col("files_read") > 0)
    return report.select("job_group", "num_exec", "rows_matched", "rows_at_most", (within & timed).alias("within"))


@query("layout_matches")
def layout_matches(spark, sf_dir):
    """Rows found by the lookups of a report, which must not depend on the layout."""
    return lookup_matches(spark, rel.layouts(spark, sf_dir), hasher=portable_hash)


@query("param_keys")
def param_keys(spark, sf_dir):
    return first_values(rel.demo_lineitem(spark, sf_dir), F.col("cust_identifier"), "cust_identifier")


@query("param_dates")
def param_dates(spark, sf_dir):
    return first_values(rel.demo_lineitem(spark, sf_dir), date_of(F.col("tstamp")), "dates")


@query("param_pick")
def param_pick(spark, sf_dir):
    keys = rel.demo_lineitem(spark, sf_dir).select("cust_identifier").distinct()
    return pick_values(keys, "cust_identifier", 10, "pick", portable_hash)


# Samples, replicas and synthetic rows

@query("sample_rows")
def sample_rows_by_hash(spark, sf_dir):
    rows = rel.demo_lineitem(spark, sf_dir)
    key = [F.col("cust_identifier"), F.col("attr4"), F.col("attr2")]
    return sample_rows(rows, SAMPLE_RATE, key, seed=1, hasher=portable_hash)


@query("sample_rows_rand")
def sample_rows_rand(spark, sf_dir):
    """Random rows differ between machines: their share is within six standard deviations, and all are of the table."""
    rows = rel.demo_lineitem(spark, sf_dir)
    key = ["cust_identifier", "tstamp", "attr4", "attr2"]
    marked = rows.select(*key, F.lit(0).alias("kept")).unionAll(
        sample_rows(rows, SAMPLE_RATE, seed=1).select(*key, F.lit(1).alias("kept")))
    per_row = marked.groupBy(*key).agg(F.sum("kept").alias("kept"), F.count_if(F.col("kept") == 0).alias("n"))
    total = per_row.agg(F.sum("kept").alias("kept"), F.sum("n").alias("n"), F.count_if(F.col("kept") > F.col("n")).alias("strange"))
    off = F.abs(F.col("kept") - F.col("n") * SAMPLE_RATE) <= 6 * F.sqrt(F.col("n") * SAMPLE_RATE * (1 - SAMPLE_RATE))
    return total.select(off.alias("share_as_asked"), (F.col("strange") == 0).alias("all_from_table"), F.col("n").alias("n_rows"))


@query("shift_replicate")
def shift_replicate_day(spark, sf_dir):
    rows = rel.demo_lineitem(spark, sf_dir)
    key = [F.col("cust_identifier"), F.col("attr4"), F.col("attr2")]
    return shift_replicate(rows, REPLICATE_DAY, ITERATIONS, RATE, key=key, hasher=portable_hash)


@query("replicate_into_table")
def replicate_into_table(spark, sf_dir):
    table, path = _fresh_table(spark, "grown")
    write_date_clustered(rel.demo_events(spark, sf_dir), table, path)
    layout = Layout(table, by_date=True)
    replicate_day_job(spark, layout, DAY, ITERATIONS, RATE, key=[F.col("attr1")], hasher=portable_hash)
    return _zoneless(spark.table(table))


@query("generate_accounts")
def generate_accounts(spark, sf_dir):
    customer = rel.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", *account_columns(F.col("c_custkey"), F.lit(TODAY), portable_hash))


def _credit(function, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One random type and one fixed type per customer."""
    key = F.col("c_custkey")
    return rel.table(spark, sf_dir, "customer").select(
        key,
        function(key, hasher=portable_hash).alias("any_type"),
        function(key, "fico5", hasher=portable_hash).alias("fico5"),
    )


for _function in (credit.credit_score, credit.credit_score_name, credit.credit_score_provider,
                  credit.credit_score_full):
    query(_function.__name__)(partial(_credit, _function))


# Streams

@query("stream_append")
def stream_append(spark, sf_dir):
    table, path = _fresh_table(spark, "stream_append")
    source = rel.in_files(spark, sf_dir, "lineitem")
    stream = spark.readStream.schema(rel.table(spark, sf_dir, "lineitem").schema).option("maxFilesPerTrigger", 2).parquet(source)
    append_stream(stream, table, path, path + "-checkpoint", drain=True).awaitTermination()
    fold_days(spark, table, date(9999, 1, 1), path)
    return read_loads(spark, table)


@query("stream_parse_append")
def stream_parse_append(spark, sf_dir):
    table, path = _fresh_table(spark, "stream_accounts")
    messages = message_stream(spark, rel.account_messages(spark, sf_dir), maxFilesPerTrigger="1")
    ingest_accounts(messages, table, path, path + "-checkpoint", drain=True).awaitTermination()
    return read_loads(spark, table)


@query("console_tap")
def console_tap(spark, sf_dir):
    table, path = _fresh_table(spark, "tap")
    messages = message_stream(spark, rel.account_messages(spark, sf_dir), maxFilesPerTrigger="1")
    tap_keys(parse_accounts(messages), table, path, path + "-checkpoint", drain=True).awaitTermination()
    return read_loads(spark, table).groupBy("country_code", "ones").agg(F.sum("n").alias("n"))


@query("window_count_stream")
def window_count_stream(spark, sf_dir):
    """Events in no order, one file per micro-batch; then the batches' counts are folded."""
    table, path = _fresh_table(spark, "window_counts")
    stream = spark.readStream.schema(rel.table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1).parquet(
        rel.in_files(spark, sf_dir, "events"))
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    count_windows_stream(rows, table, path, path + "-checkpoint", "ts", "event_type", drain=True).awaitTermination()
    fold_windows(spark, table, date(9999, 1, 1), path)
    return _zoneless(window_counts(spark, table), "window_start")


@query("window_count_final")
def window_count_final(spark, sf_dir):
    """Events in no order, over five micro-batches or, of a large table, more, and two restarts: windows that are emitted once, and what came late for them."""
    table, path = _fresh_table(spark, "final_windows")
    schema = rel.table(spark, sf_dir, "events").schema
    for part in rel.halves_of_events(spark, sf_dir):
        part.write.mode("append").parquet(path + "-in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path + "-in")
        rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        final_windows_stream(rows, table, path, path + "-checkpoint", "ts", "event_type", delay="5 days", drain=True).awaitTermination()
    both = final_windows(spark, table).withColumn("final", F.lit(1)).unionByName(late_counts(spark, table).withColumn("final", F.lit(0)))
    counts = both.groupBy("window_start", "country_name").agg(F.sum("num_cc_card").alias("num_cc_card"), (F.sum("final") <= 1).alias("at_most_once"))
    return _zoneless(counts, "window_start")


def _published(messages: DataFrame) -> DataFrame:
    """The record's time stands in for the publish time."""
    return messages.withColumn("timestamp", F.get_json_object("value", "$.date_record_created").cast("timestamp"))


@query("window_count_accounts")
def window_count_accounts(spark, sf_dir):
    """The whole way from message to counts, in no order of time, one file per micro-batch."""
    messages = message_stream(spark, rel.account_messages(spark, sf_dir), maxFilesPerTrigger="1")
    table, path = _fresh_table(spark, "window_accounts")
    count_accounts_stream(_published(messages), table, path, path + "-checkpoint", drain=True).awaitTermination()
    return _zoneless(window_counts(spark, table), "window_start")


@query("stream_two_outputs")
def stream_two_outputs(spark, sf_dir):
    """One parse, two outputs: the account rows, and the text lines of their window counts, added up."""
    messages = message_stream(spark, rel.account_messages(spark, sf_dir), maxFilesPerTrigger="1")
    table, path = _fresh_table(spark, "two_outputs")
    ingest_and_count(_published(messages), table, path, path + "-lines", path + "-checkpoint", drain=True).awaitTermination()
    line = F.regexp_extract
    text = r"^(.{19}) (.*): (\d+)$"
    lines = read_lines(spark, path + "-lines/*").select(
        line("value", text, 1).cast("timestamp_ntz").alias("window_start"), line("value", text, 2).alias("country_name"),
        line("value", text, 3).cast("bigint").alias("n"))
    counts = lines.groupBy("window_start", "country_name").agg(F.sum("n").alias("num_cc_card"))
    return _side_by_side([read_loads(spark, table).drop("timestamp"), counts])
