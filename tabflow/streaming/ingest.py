"""Message streams to tables, the key tap, and one stream to two outputs.

Every job writes a micro-batch as one load of a table (``append_load``): a batch that is repeated after a
failure replaces its own rows, and ``fold_days`` gathers the batches of finished days. Strict and permissive
jobs write tables of the same form.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.schema import ACCOUNT_SCHEMA, schema_from_text
from ..operators.counts import count_per_window
from ..operators.parse import REJECT_SCHEMA, accept_all, tag_json
from ..plans.ingest import append_checked
from ..sinks.files import write_load_lines
from ..sinks.loads import append_load, read_loads

log = logging.getLogger("tabflow.tap")
QUERY_ID = "sql.streaming.queryId"  # set by Spark in the threads of a streaming query
TAP_SCHEMA = schema_from_text("country_code:STRING, ones:INT64, n:INT64")


@dataclass(frozen=True)
class Load:
    """The load of a micro-batch: an id that is the same for a repeated batch, and whether it may be one."""

    id: str
    repeated: bool

    def append(self, rows: DataFrame, table: str, schema: T.StructType, path: str | None, within: str | None = None) -> bool:
        return append_load(rows, table, self.id, schema, path, self.repeated, within)


def batch_load_id(batch: DataFrame, batch_id: int) -> str:
    """The same for a repeated batch; differs between queries with different checkpoints."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if not query_id:
        raise RuntimeError("not inside a streaming query: its id is missing")
    return f"{query_id}-{batch_id}"


def run_batches(
    rows: DataFrame, work: Callable[[DataFrame, Load], None], checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Call ``work`` with every micro-batch and its load; ``drain`` stops when the present input is used up.

    A batch is only ever repeated as the first one after a start: what failed stops the query.
    """
    begun = []

    def call(batch: DataFrame, number: int) -> None:
        first, begun[:] = not begun, [number]
        work(batch, Load(batch_load_id(batch, number), first))

    writer = rows.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def append_stream(rows: DataFrame, table: str, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Append a stream to a table; read it with ``read_loads``."""
    schema = rows.schema
    return run_batches(rows, lambda batch, load: load.append(batch, table, schema, path), checkpoint, drain)


def tag_accounts(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Account rows from JSON payloads: all 14 keys needed, further keys dropped.

    ``keep`` names message columns to carry along, such as the publish time.
    """
    return tag_json(messages, ACCOUNT_SCHEMA, require_keys=True, allow_extra_keys=True, keep=keep)


def parse_accounts(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return accept_all(tag_accounts(messages, keep))


def ingest_accounts(
    messages: DataFrame, table: str, path: str, checkpoint: str, mode: str = "strict", drain: bool = False
) -> StreamingQuery:
    """Append account messages to a table.

    ``strict`` stops the query at a bad message, ``permissive`` appends those to ``<table>_rejects``.
    """
    def write(batch: DataFrame, load: Load) -> None:
        append_checked(
            tag_accounts(batch),
            lambda rows: load.append(rows, table, ACCOUNT_SCHEMA, path),
            lambda rows: load.append(rows, f"{table}_rejects", REJECT_SCHEMA, f"{path}_rejects"),
            mode,
        )

    return run_batches(messages, write, checkpoint, drain)


def ingest_and_count(
    messages: DataFrame, table: str, path: str, lines_path: str, checkpoint: str, ts: str = "timestamp",
    drain: bool = False,
) -> StreamingQuery:
    """One stream, two outputs: the account rows as a table, and their counts per window and country as text lines.

    A batch is parsed once; its counts are taken from the rows just written, or from the batch
    if those are folded already. A line is
    ``window country: count`` and counts the batch's rows, so the lines of one window add up.
    """
    schema = T.StructType([*ACCOUNT_SCHEMA.fields, messages.schema[ts]])

    def write(batch: DataFrame, load: Load) -> None:
        rows = parse_accounts(batch, keep=[ts])
        written = load.append(rows, table, schema, path)
        counts = count_per_window(read_loads(batch.sparkSession, table, load.id) if written else rows, ts)
        start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
        line = F.format_string("%s %s: %d", start, "country_name", "num_cc_card")
        write_load_lines(counts, line, lines_path, load.id)

    return run_batches(messages, write, checkpoint, drain)


def tap_keys(accounts: DataFrame, table: str, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Record the (country, 1) pairs of each micro-batch with their numbers, and log one line a batch.

    Every element counts; equal pairs of a batch are one row of ``table``.
    """
    def record(batch: DataFrame, load: Load) -> None:
        pairs = batch.select("country_code", F.lit(1).cast("bigint").alias("ones"))
        numbers = pairs.groupBy("country_code", "ones").agg(F.count("*").alias("n"))
        written = load.append(numbers, table, TAP_SCHEMA, path)
        seen = (read_loads(batch.sparkSession, table, load.id) if written else numbers).agg(F.count("*").alias("keys"), F.sum("n").alias("n")).first()
        log.info("load %s: %d elements of %d pairs", load.id, seen["n"] or 0, seen["keys"])

    return run_batches(accounts, record, checkpoint, drain)
