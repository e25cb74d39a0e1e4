"""A continuously updated keyed replica of a streaming result: a keyed merge into a partitioned table.

Each micro-batch merges the rows it changed into the partitions they lie in, by :mod:`campflow.streaming.store`: days for
results that have one, a hash of the key otherwise. The last value wins; a batch that is delivered again changes nothing,
and a query that lost its checkpoint writes over the rows of the run before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from campflow.functions import measures as M
from campflow.plans import gold
from campflow.streaming.run import start
from campflow.streaming.store import VERSION, Batch, Store, Table, run_of

DAY = "event_date"


def replica_table(schema: T.StructType, keys: Sequence[str], buckets: int = 1) -> Table:
    """A replica is stored by day if its key has one, and in ``buckets`` of its keys otherwise."""
    return Table("rows", schema, tuple(keys), DAY if DAY in keys and len(keys) > 1 else None, buckets)


def stream_upsert(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    trigger: str | None = None,
    buckets: int = 1,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    feed: bool = False,
) -> StreamingQuery:
    """Keep the replica at ``path`` up to date with an update-mode stream of changed rows.

    ``enrich`` completes each micro-batch, for instance from tables that are read afresh. A micro-batch that holds two
    rows for one key fails the query. Each batch writes the days or buckets that it touches anew, so triggers of a
    minute and more suit it; ``buckets`` keep that small for large results without a day. With ``feed`` the images of
    the changed rows are kept too (:func:`read_feed`).
    """
    write = batch_writer(path, keys, buckets, feed)
    sink = write if enrich is None else lambda batch, batch_id: write(enrich(batch), batch_id)
    return start(changes, sink, checkpoint, mode="update", trigger=trigger)


def batch_writer(path: str, keys: Sequence[str], buckets: int = 1, feed: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of :func:`stream_upsert`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = replica_table(batch.schema, keys, buckets)

        def prepare(own: Batch) -> None:
            own.merge(table, own.keep("changes", batch), feed=feed)

        Store(batch.sparkSession, path).apply(run_of(batch) or "", batch_id, prepare)

    return write


def read_replica(
    spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, buckets: int = 1, with_version: bool = False
) -> DataFrame:
    """The current rows of a replica; ``with_version`` adds the batch that wrote each, counted over all runs."""
    return Store(spark, path).read(replica_table(schema, keys, buckets), with_version)


def read_feed(
    spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, streaming: bool = False
) -> DataFrame:
    """The change feed of a replica that keeps one: images of the changed rows with ``_change_type`` and ``version``, as a stream too."""
    return Store(spark, path).feed(replica_table(schema, keys), streaming)


def read_gold(spark: SparkSession, path: str, name: str, schema: T.StructType, buckets: int = 1) -> DataFrame:
    """The current rows of a gold table's replica, one per primary key.

    The replica is keyed by what the table is grouped by. Where that is finer than the primary key (the hourly and
    minute tables hold the campaign's name), the counts of all groups of a key are added, and the key takes the name
    that changed last: a renamed campaign keeps all its counts.
    """
    table = gold.TABLES[name]
    if set(table.group) == set(table.primary_key):
        return read_replica(spark, path, table.group, schema, buckets)
    rows = read_replica(spark, path, table.group, schema, buckets, with_version=True)
    named = [c for c in table.group if c not in table.primary_key]
    newest = F.struct(VERSION, "total_events", *named)
    counts = [c for c in table.outputs if c != "ctr"]
    folded = rows.groupBy(*table.primary_key).agg(
        *[F.max_by(c, newest).alias(c) for c in named], *[F.sum(c).alias(c) for c in counts]
    )
    return folded.withColumn("ctr", F.expr(M.percent("clicks", "impressions"))).select(*schema.names)
