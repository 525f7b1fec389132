"""File and topic sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions.text import encode_utf8, to_json_line


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """One text line per row."""
    df.select(line.alias("value")).write.mode("append").option("lineSep", "\n").text(path)


def write_load_lines(df: DataFrame, line: Column, path: str, load_id: str) -> None:
    """The text lines of one load in a folder of its own, which a repeat overwrites; read them with ``<path>/*``."""
    df.select(line.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(f"{path}/load_id={load_id}")


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per line, every column as a key."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def publish_messages(df: DataFrame, location: str, fmt: str = "kafka", **options: str) -> None:
    """Rows as UTF-8 JSON payloads to a topic, or to a folder of lines with ``fmt="text"``.

    The write returns when the broker has acknowledged every message.
    """
    payload = to_json_line("*")
    if fmt == "kafka":
        messages = df.select(encode_utf8(payload).alias("value"))
        messages.write.format("kafka").option("topic", location).options(**options).save()
    else:
        write_lines(df, payload, location)
