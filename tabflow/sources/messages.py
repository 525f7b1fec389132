"""Message stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import unchecked_payload


def message_stream(spark: SparkSession, location: str, fmt: str = "text", **options: str) -> DataFrame:
    """Payloads of a topic as text, column ``value``; Kafka adds ``timestamp``.

    Bytes are passed on as they are, so that the parsers can reject damaged ones.

    ``fmt="kafka"`` subscribes to the topic ``location`` and needs the connector
    on the class path. Pass ``minPartitions`` there: it cuts a topic partition that
    holds most of the messages into several tasks. ``fmt="text"`` watches a folder
    with one message per line. ``maxOffsetsPerTrigger`` and ``maxFilesPerTrigger``
    bound a micro-batch.
    """
    reader = spark.readStream.options(**options)
    if fmt == "kafka":
        topic = reader.format("kafka").option("subscribe", location).load()
        return unchecked_payload(topic.select("value", "timestamp"))
    return reader.format("text").schema("value string").option("lineSep", "\n").load(location)
