"""Inputs of the registered queries, all derived by Spark from the given tables.

Message folders, line files and layouts are written once per session and data
folder; the queries that test a sink or a layout write their own copy.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import portable_hash
from ..functions.schema import schema_from_text, schema_to_text
from ..functions.text import to_json_line
from ..plans.layouts import (
    Layout,
    Layouts,
    write_bucket_by,
    write_bucketed,
    write_date_clustered,
    write_date_plain,
)
from ..session import fresh_path
from ..sinks.files import publish_messages, write_lines, write_ndjson

BUCKETS = 16
FILES = 4  # of a table that is cut into files, at least
FILE_ROWS = 2_000_000  # a larger table gets more files: about so many rows each
PAGE_ROWS = 200  # a day of the test tables is a few thousand rows
JOB_PREFIX = "report"
ACCOUNT_COLUMNS = [
    "name", "address", "country_code", "city", "bank_iban", "company", "credit_card",
    "credit_card_provider", "credit_card_expires", "date_record_created", "employement", "emp_id",
    "name_prefix", "phone_number",
]

# The routed tables under the names a registry would use, with their declared columns.
ROUTED = {
    "shop:sales.region": "tablename:STRING, r_regionkey:INT64, r_name:STRING",
    "shop:sales.nation": "tablename:STRING, n_nationkey:INT64, n_name:STRING, n_regionkey:INT64",
    "shop:sales.supplier":
        "tablename:STRING, s_suppkey:INT64, s_name:STRING, s_nationkey:INT64, s_acctbal:FLOAT64",
    "shop:sales.customer":
        "tablename:STRING, c_custkey:INT64, c_name:STRING, c_nationkey:INT64, c_acctbal:FLOAT64, "
        "c_mktsegment:STRING",
    "shop:sales.orders":
        "tablename:STRING, o_orderkey:INT64, o_custkey:INT64, o_orderstatus:STRING, "
        "o_totalprice:FLOAT64, o_orderdate:DATETIME, o_orderpriority:STRING",
}
UNLISTED = "shop:sales.part"

_made: dict[tuple[str, str, str], object] = {}
_lock = threading.RLock()


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _made:
            _made[key] = make()
        return _made[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_parts(rows: DataFrame, least: int = FILES) -> DataFrame:
    """The rows in no order, in ``least`` partitions or, if they are many, one for every ``FILE_ROWS``: what one task gets doesn't grow with the table."""
    return rows.repartition(max(least, -(-rows.count() // FILE_ROWS)))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card accounts, one per customer; values as they appear in a message (all text)."""
    key = F.col("c_custkey")
    created = F.timestamp_add("SECOND", key.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    columns: dict[str, Column] = {
        "name": F.col("c_name"),
        "address": F.concat(key, F.lit(" Mill Lane\n"), F.col("n_name")),
        "country_code": F.col("n_name"),
        "city": F.concat(F.lit("City "), F.col("c_nationkey")),
        "bank_iban": F.concat(F.lit("GB"), F.lpad(key.cast("string"), 20, "0")),
        "company": F.col("c_mktsegment"),
        "credit_card": (F.lit(4_000_000_000_000_000) + key).cast("string"),
        "credit_card_provider": F.when(key % 7 != 0, F.lit("VISA 16 digit")),
        "credit_card_expires": F.lit("01/30"),
        "date_record_created": F.date_format(created, "yyyy-MM-dd HH:mm:ss"),
        "employement": F.lit("Nurse"),
        "emp_id": F.md5(key.cast("string")),
        "name_prefix": F.when(key % 2 == 0, F.lit("Dr.")).otherwise(F.lit("Mx.")),
        "phone_number": F.concat(F.lit("555-"), key),
    }
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(*[columns[name].alias(name) for name in ACCOUNT_COLUMNS])


def demo_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup table from ``lineitem``: about 2,500 days."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("cust_identifier"),
        F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")).alias("tstamp"),
        F.col("l_returnflag").alias("country_code"),
        F.col("l_quantity").cast("bigint").alias("attr1"),
        F.col("l_linenumber").cast("bigint").alias("attr2"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("attr3"),
        F.col("l_orderkey").alias("attr4"),
        F.col("l_suppkey").alias("attr5"),
        F.col("l_partkey").alias("attr6"),
        F.floor("l_extendedprice").cast("bigint").alias("attr7"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("attr8"),
        (F.col("l_orderkey") % 10).alias("attr9"),
        (F.col("l_partkey") % 10).alias("attr10"),
    )


def demo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup table from ``events``: 30 days."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("cust_identifier"),
        F.col("ts").cast("timestamp").alias("tstamp"),
        F.col("event_type").alias("country_code"),
        F.col("event_id").alias("attr1"),
        F.floor("value").cast("bigint").alias("attr2"),
        F.get_json_object("props", "$.k").cast("bigint").alias("attr3"),
        F.col("user_id").alias("attr4"),
        *[(F.col("event_id") % i).alias(f"attr{i}") for i in range(5, 11)],
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query history from ``events``: some loads, another project, NULL billed bytes and ends."""
    n = F.col("event_id")
    micros = F.floor(F.col("value") * 1000).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(JOB_PREFIX + "_"), F.col("event_type"), F.lit("_"), n).alias("job_id"),
        F.col("ts").alias("creation_time"),
        F.col("ts").alias("start_time"),
        F.when(n % 13 != 0, F.timestamp_add("MICROSECOND", micros, F.col("ts"))).alias("end_time"),
        (n * 1000).alias("total_bytes_processed"),
        F.when(n % 7 != 0, n * 1024).alias("total_bytes_billed"),
        F.when(n % 10 == 0, F.lit("LOAD")).otherwise(F.lit("QUERY")).alias("job_type"),
        F.when(n % 11 == 0, F.lit("other")).otherwise(F.lit("shop")).alias("project_id"),
    )


def account_messages(spark: SparkSession, sf_dir: str) -> str:
    """A folder of account messages, one JSON object per line, in files of no order."""
    def make() -> str:
        path = fresh_path(spark, "account-messages")
        publish_messages(in_parts(accounts(spark, sf_dir)), path, fmt="text")
        return path

    return once(spark, sf_dir, "account messages", make)


def damaged_messages(spark: SparkSession, sf_dir: str) -> str:
    """Account messages; every fifth has a further key whose text is not UTF-8."""
    def make() -> str:
        path = fresh_path(spark, "damaged-messages")
        rows = accounts(spark, sf_dir)
        line = to_json_line(*ACCOUNT_COLUMNS).alias("line")
        lines = rows.select(line, F.expr("int(substring(phone_number, 5)) % 5 = 0").alias("fifth"))
        damaged = F.concat(F.lit('{"note":"'), F.lit(bytearray(b"\xff")).cast("string"), F.lit('",'), F.expr("substring(line, 2)"))
        value = F.when(F.col("fifth"), damaged).otherwise(F.col("line"))
        write_lines(in_parts(lines), value, path)
        return path

    return once(spark, sf_dir, "damaged messages", make)


def in_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A given table in several files whose rows are in no order."""
    def make() -> str:
        path = fresh_path(spark, f"{name}-files")
        in_parts(table(spark, sf_dir, name)).write.parquet(path)
        return path

    return once(spark, sf_dir, f"{name} in files", make)


def halves_of_events(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in two halves of no order, and one event of the far future, which closes their windows."""
    events = table(spark, sf_dir, "events")
    odd = F.xxhash64("event_id") % 2 != 0
    last = events.limit(1).withColumn("ts", F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
    return [in_parts(events.where(~odd), FILES // 2), in_parts(events.where(odd), FILES // 2), last]


def bucketed_table(spark: SparkSession, sf_dir: str) -> str:
    """The ``events`` lookup table in Spark's own buckets."""
    def make() -> str:
        path = fresh_path(spark, "demo-bucket-by")
        name = path.rpartition("/")[2].replace("-", "_")
        write_bucket_by(demo_events(spark, sf_dir), name, path, BUCKETS)
        return name

    return once(spark, sf_dir, "bucketed events", make)


def event_messages(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        path = fresh_path(spark, "event-messages")
        publish_messages(in_parts(table(spark, sf_dir, "events")), path, fmt="text")
        return path

    return once(spark, sf_dir, "event messages", make)


def _routed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the listed tables, and of one table the registry does not list."""
    lines = None
    for name in [*ROUTED, UNLISTED]:
        df = table(spark, sf_dir, name.rpartition(".")[2])
        columns = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kind.startswith("timestamp") else F.col(c)
                   for c, kind in df.dtypes]
        part = df.select(to_json_line(F.lit(name).alias("tablename"), *columns).alias("value"))
        lines = part if lines is None else lines.unionAll(part)
    return lines


def routed_messages(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        path = fresh_path(spark, "routed-messages")
        write_lines(_routed_lines(spark, sf_dir), F.col("value"), path)
        return path

    return once(spark, sf_dir, "routed messages", make)


def registry_path(spark: SparkSession, sf_dir: str) -> str:
    """The registry file of the routed tables."""
    def make() -> str:
        path = fresh_path(spark, "registry")
        rows = [
            (name, ([(f.strip().split(":")[0], f.strip().split(":")[1], "NULLABLE") for f in text.split(",")],))
            for name, text in ROUTED.items()
        ]
        ddl = "tablename string, schema struct<fields: array<struct<name: string, type: string, mode: string>>>"
        spark.createDataFrame(rows, ddl).coalesce(1).write.json(path)
        return path

    return once(spark, sf_dir, "registry", make)


LOADED = ("customer", "supplier", "orders")


def load_config(spark: SparkSession, sf_dir: str) -> str:
    """A new load configuration: NDJSON files of three tables, and targets nobody has used."""
    def make() -> str:
        root = fresh_path(spark, "load")
        for name in LOADED:
            schema = schema_from_text(ROUTED[f"shop:sales.{name}"].split(", ", 1)[1])
            write_ndjson(table(spark, sf_dir, name), f"{root}/data/{name}")
            text = schema_to_text(schema)
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/schema/{name}")
        return root

    root = once(spark, sf_dir, "load files", make)
    path = fresh_path(spark, "load-config")
    entries = [(f"{root}/data/{n}", f"load_{path[-12:]}_{n}", f"{root}/schema/{n}") for n in LOADED]
    ddl = "tablelist array<struct<sourcefile: string, targettable: string, schemauri: string>>"
    spark.createDataFrame([(entries,)], ddl).coalesce(1).write.json(path)
    return path


def scenario_lines(spark: SparkSession, sf_dir: str) -> str:
    """CSV lines from ``lineitem``."""
    def make() -> str:
        path = fresh_path(spark, "scenarios")
        line = F.concat_ws(",", F.concat(F.lit("J"), "l_orderkey"), "l_linenumber", "l_tax", "l_discount")
        write_lines(table(spark, sf_dir, "lineitem"), line, path)
        return path

    return once(spark, sf_dir, "scenarios", make)


LITERAL_SCHEMA = schema_from_text("key:INT64, amount:FLOAT64, ordered:DATETIME, seen:TIMESTAMP, day:DATE")


def literal_lines(spark: SparkSession, sf_dir: str) -> str:
    """CSV lines from ``orders``; of every twenty, some have a literal that would change by a cast, some an unusual good one."""
    def make() -> str:
        path = fresh_path(spark, "literals")
        key = F.col("o_orderkey")
        at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        fields = {"key": key.cast("string"), "amount": F.col("o_totalprice").cast("string"), "ordered": at, "seen": at,
                  "day": F.date_format("o_orderdate", "yyyy-MM-dd")}
        others = {
            1: ("amount", F.lit("9007199254740993")), 2: ("amount", F.lit("1e400")), 3: ("amount", F.lit("1d")),
            4: ("amount", F.lit("0x1p3")), 5: ("ordered", F.concat(at, F.lit("+05:00"))), 6: ("ordered", F.concat(at, F.lit(".1234567"))),
            7: ("ordered", F.date_format("o_orderdate", "yyyy")), 8: ("seen", F.lit("12:30")), 9: ("day", F.date_format("o_orderdate", "yyyy-MM")),
            10: ("amount", F.lit("9007199254740992")), 11: ("seen", F.concat(at, F.lit("Z"))), 12: ("ordered", F.concat(at, F.lit(".123456000"))),
            13: ("seen", F.concat(at, F.lit("+02:00"))), 14: ("amount", F.lit("1e3")), 15: ("day", F.date_format("o_orderdate", "yyyy-M-d")),
            16: ("amount", F.lit("1.23456789012345678901")), 17: ("day", F.concat_ws(" ", fields["day"], F.lit("10:00:00"))),
        }
        for k, (name, text) in others.items():
            fields[name] = F.when(key % 20 == k, text).otherwise(fields[name])
        write_lines(table(spark, sf_dir, "orders"), F.concat_ws(",", *fields.values()), path)
        return path

    return once(spark, sf_dir, "literals", make)


def document_lines(spark: SparkSession, sf_dir: str) -> str:
    """The whole texts of ``documents`` as line files."""
    def make() -> str:
        path = fresh_path(spark, "documents")
        write_lines(table(spark, sf_dir, "documents").where("text IS NOT NULL"), F.col("text"), path)
        return path

    return once(spark, sf_dir, "documents", make)


def layouts(spark: SparkSession, sf_dir: str) -> Layouts:
    """The three layouts of the ``events`` lookup table."""
    def make() -> Layouts:
        root = fresh_path(spark, "layouts")
        tag = root[-12:]
        base = demo_events(spark, sf_dir)
        result = Layouts(
            Layout(f"demo_date_{tag}", by_date=True),
            Layout(f"demo_bucket_{tag}", buckets=BUCKETS, hasher=portable_hash),
            Layout(f"demo_plain_{tag}", by_date=True),
        )
        write_date_clustered(base, result.date_clustered.table, f"{root}/date", page_rows=PAGE_ROWS)
        write_bucketed(base, result.bucketed.table, f"{root}/bucket", BUCKETS, hasher=portable_hash, page_rows=PAGE_ROWS)
        write_date_plain(base, result.date_plain.table, f"{root}/plain", page_rows=PAGE_ROWS)
        return result

    return once(spark, sf_dir, "layouts", make)
