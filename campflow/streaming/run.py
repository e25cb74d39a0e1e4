"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

Sink = str | Callable[[DataFrame, int], None]


def start(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a streaming query.

    ``sink`` is a folder (append mode) or a function of micro-batch and batch id. ``trigger`` is an interval such
    as ``"1 second"`` for a continuous run; without it, the query works off what is there in several bounded
    micro-batches and stops.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format(fmt).start(sink)


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()
