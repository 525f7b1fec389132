"""Tumbling-window counts of a stream, in two forms.

``count_windows_stream``, the default, appends the counts of each micro-batch, and readers add them up. There is no watermark: no row is ever
late, whatever the order in which it comes, and the stream keeps no state. ``fold_windows``
adds up the counts of finished days for good.

``final_windows_stream`` emits each window once, when the watermark has passed its end. Rows that come for a window that is closed
are counted beside the windows and not lost. The open windows are the state, one number per window and key.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.schema import schema_from_text
from ..operators.counts import count_per_window
from ..sinks.loads import create_loads, fold_days, read_loads
from .ingest import Load, parse_accounts, run_batches

WINDOW_SCHEMA = schema_from_text("window_start:TIMESTAMP, country_name:STRING, num_cc_card:INT64")
SPAN = 60  # windows whose counts are one value of the state
LATE = "late"  # partition column of a table of final windows: "true" for counts of late rows


def count_windows_stream(
    rows: DataFrame, table: str, path: str, checkpoint: str, ts: str, key: str = "country_code",
    width: str = "60 seconds", drain: bool = False,
) -> StreamingQuery:
    """Append the counts per key and window of every micro-batch to a table; read it with ``window_counts``."""
    def count(batch: DataFrame, load: Load) -> None:
        load.append(count_per_window(batch, ts, key, width), table, WINDOW_SCHEMA, path)

    return run_batches(rows, count, checkpoint, drain)


def count_accounts_stream(
    messages: DataFrame, table: str, path: str, checkpoint: str, ts: str = "timestamp", drain: bool = False
) -> StreamingQuery:
    """Account messages counted per country and minute of their publish time."""
    return count_windows_stream(parse_accounts(messages, keep=[ts]), table, path, checkpoint, ts, drain=drain)


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("window_start", "country_name").agg(F.sum("num_cc_card").alias("num_cc_card"))


def window_counts(spark: SparkSession, table: str) -> DataFrame:
    """The counts of all batches so far, one row per window and key."""
    return _added_up(read_loads(spark, table))


def fold_windows(spark: SparkSession, table: str, before: date, path: str | None = None) -> list[str]:
    """Add up the counts written before a day; see ``fold_days``."""
    return fold_days(spark, table, before, path, _added_up)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per window and key of some rows, so that a hot window isn't shuffled row by row."""
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(["span", "key", "start"]).aggregate([([], "count_all")])
        yield from counts.rename_columns(["span", "key", "start", "n"]).to_batches()


class WindowCounter(StatefulProcessor):
    """The windows of one key and span of time: counts until the watermark reaches a window's end; then the window, and what comes after it.

    Windows are kept by spans, as each look at the state is a call out of the Python worker.
    """

    OUTPUT = "window_start timestamp, country_name string, num_cc_card bigint, late string"

    def __init__(self, width: int) -> None:
        self.width = width * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "starts array<bigint>, counts array<bigint>, timer bigint")

    def _end(self, start: int) -> int:
        return (start + self.width) // 1000

    def _told(self, key: tuple, counts: dict[int, int], late: bool) -> Iterator[pd.DataFrame]:
        if counts:
            starts = pd.to_datetime(pd.Series(list(counts), dtype="int64"), unit="us")
            yield pd.DataFrame({"window_start": starts, "country_name": key[1], "num_cc_card": list(counts.values()), "late": str(late).lower()})

    def _keep(self, counts: dict[int, int], timer: int) -> None:
        """Store the open windows, with a timer at the first end."""
        if not counts:
            self.open.clear()
            return
        first = min(map(self._end, counts))
        if first != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        self.open.update((list(counts), list(counts.values()), first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        new: dict[int, int] = {}
        for part in rows:
            for start, n in zip(part["start"].tolist(), part["n"].tolist()):
                new[start] = new.get(start, 0) + n
        held = self.open.get() if self.open.exists() else ([], [], 0)
        counts, passed = dict(zip(held[0], held[1])), timerValues.getCurrentWatermarkInMs()
        # A window whose timer is due takes the rows of its batch; one that is closed, or was never open, doesn't.
        late = {start: n for start, n in new.items() if start not in counts and self._end(start) <= passed}
        for start, n in new.items():
            if start not in late:
                counts[start] = counts.get(start, 0) + n
        if len(late) < len(new):
            self._keep(counts, held[2])
        yield from self._told(key, late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        if not self.open.exists():
            return
        held = self.open.get()
        counts, passed = dict(zip(held[0], held[1])), max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        closed = {start: n for start, n in counts.items() if self._end(start) <= passed}
        self._keep({start: n for start, n in counts.items() if start not in closed}, 0)
        yield from self._told(key, closed, False)

    def close(self) -> None:
        pass


def final_windows_stream(
    rows: DataFrame, table: str, path: str, checkpoint: str, ts: str, key: str = "country_code",
    width: int = 60, delay: str = "0 seconds", drain: bool = False,
) -> StreamingQuery:
    """Append every window of ``width`` seconds once, when event time has passed its end by ``delay``.

    Read the windows with ``final_windows`` and the rows that came too late with ``late_counts``; together they are all rows,
    but those of windows still open. Needs the RocksDB state store (``session.RUNTIME_SETTINGS``).
    """
    micros = F.unix_micros(ts)
    # Times are numbers, so that Spark doesn't drop late rows before they are counted.
    down_to = lambda seconds: micros - F.pmod(micros, F.lit(seconds * 1_000_000))
    timed = rows.withWatermark(ts, delay).where(F.col(ts).isNotNull()).select(
        down_to(width * SPAN).alias("span"), F.col(key).cast("string").alias("key"), down_to(width).alias("start"))
    partial = timed.mapInArrow(_partial_counts, "span bigint, key string, start bigint, n bigint")
    counted = partial.groupBy("span", "key").transformWithStateInPandas(
        statefulProcessor=WindowCounter(width), outputStructType=WindowCounter.OUTPUT, outputMode="Append", timeMode="EventTime")

    def write(batch: DataFrame, load: Load) -> None:
        load.append(batch, table, WINDOW_SCHEMA, path, LATE)

    create_loads(rows.sparkSession, table, WINDOW_SCHEMA, path, LATE)
    return run_batches(counted, write, checkpoint, drain)


def final_windows(spark: SparkSession, table: str) -> DataFrame:
    """The windows that are closed, one row per window and key."""
    return read_loads(spark, table).where(F.col(LATE) == "false").drop(LATE)


def late_counts(spark: SparkSession, table: str) -> DataFrame:
    """The rows that came for closed windows, one row per window and key."""
    return _added_up(read_loads(spark, table).where(F.col(LATE) == "true"))
