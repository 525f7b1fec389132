"""One stream to many tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.routing import Target, route_messages
from .ingest import Load, run_batches


def route_stream(
    messages: DataFrame, target: Target, checkpoint: str, stage: str,
    mode: str = "strict", drain: bool = False,
) -> StreamingQuery:
    """Route every micro-batch to the tables its messages name.

    ``foreachBatch`` may repeat a batch after a failure. The load id is the query's
    id (kept in the checkpoint) and the batch number, so a repeat overwrites its
    own rows, and a query with a new checkpoint never touches older loads.
    """
    def route(batch: DataFrame, load: Load) -> None:
        route_messages(batch, target, load.id, stage, mode, repeated=load.repeated)

    return run_batches(messages, route, checkpoint, drain)
