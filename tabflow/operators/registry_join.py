"""Match messages with the registry by table name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parse import OBJECT


def table_name(key: str = "tablename") -> Column:
    """The table name of a parsed message (``parse_object``); NULL if there is none."""
    return F.try_element_at(F.col(OBJECT), F.lit(key))


def with_registry(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Every message with the ``schema`` of its table, NULL for an unknown table.

    No hint: Spark broadcasts the registry while it is below the broadcast
    threshold, else it joins by shuffle and AQE splits a table name that holds
    a large share of the messages.
    """
    return messages.join(registry, "tablename", "left")


def unknown_messages(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages without a registry entry, those without a table name included."""
    return messages.join(registry, "tablename", "left_anti")
