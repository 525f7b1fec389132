"""Text and message codecs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_utf8(payload: Column) -> Column:
    """Bytes to text; malformed bytes fail (a plain cast would pass them on)."""
    return F.decode(payload, "UTF-8")


def encode_utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def unchecked_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """A message frame with ``value`` as text, whatever the transport delivers.

    The bytes stay as they came; the parsers reject a row that is not UTF-8.
    """
    if isinstance(df.schema[value].dataType, T.BinaryType):
        return df.withColumn(value, F.col(value).cast("string"))
    return df


def to_json_line(*columns: Column | str) -> Column:
    """One JSON object per row. NULL columns stay as keys, a strict reader asks for them."""
    micros = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    options = {"ignoreNullFields": "false", "timestampNTZFormat": micros, "timestampFormat": micros + "XXX"}
    return F.to_json(F.struct(*columns), options)


def key_count_line(key: Column, count: Column) -> Column:
    return F.format_string("%s: %d", key, count)


def query_code(job_id: Column, prefix: str, size: int = 4) -> Column:
    """The query code: the ``size`` characters behind ``prefix`` and its separator."""
    return F.substring(job_id, len(prefix) + 2, size)
