"""Bounded deduplication that loses nothing: rows that come too late, or have no time, are kept apart.

A stream that forgets ids after a while must not take a late row for a new one, and Spark's own form drops it without
a trace, also if its id was never seen. Here every input row ends in exactly one place: it is kept, it is a copy of a
kept row, or it goes to the ``late`` output with its reason. Copies of a row are dropped per micro-batch first, each
task keeping one per id, so an id with a large share of the rows is no single task's work; what is left is compared
with the ids kept since the horizon.

The ids are a ledger of their own, stored by day, so that a batch reads the days inside its horizon, and
only the ids. Days that lie before the horizon are deleted from it. Kept and late rows are stored by day too: a batch
writes the days it touches anew, and the number of folders follows the days, not the batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campflow.operators.dedup import dedup
from campflow.streaming.store import Batch, Store, Table, columns, run_of

REASON = "reason"
_DAY, _COPIES = "_day", "_copies"


def _kept(schema: T.StructType, keys: Sequence[str]) -> Table:
    return Table("kept", T.StructType([*schema.fields, T.StructField(_DAY, T.DateType())]), tuple(keys), _DAY)


def _late(schema: T.StructType) -> Table:
    """Late rows have no key: equal ones are one stored row with a number."""
    fields = [*schema.fields, T.StructField(REASON, T.StringType()), T.StructField(_DAY, T.DateType())]
    return Table("late", T.StructType([*fields, T.StructField(_COPIES, T.LongType())]), (*schema.names, REASON), _DAY)


def _ledger(schema: T.StructType, keys: Sequence[str]) -> Table:
    fields = [schema[k] for k in keys]
    return Table("ledger", T.StructType([*fields, T.StructField("kept", T.BooleanType()), T.StructField(_DAY, T.DateType())]), tuple(keys), _DAY)


_MARKS = Table("marks", columns(name="string", newest="timestamp"), ("name",))


def bounded_dedup(path: str, keys: Sequence[str], event_time: str, delay: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes below ``path``: ``kept``, and ``late`` with a ``reason``.

    The horizon of a batch lies ``delay`` before the newest event time of all earlier batches, as a watermark does.
    Rows older than that are ``late``, rows without a time ``untimed``. A batch that is delivered again changes
    nothing. The columns of the late rows must have an order (no maps).
    """
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        store = Store(spark, path)

        def prepare(own: Batch) -> None:
            seen = store.read(_MARKS).agg(F.max("newest").alias("newest")).first().newest
            time = F.col(event_time)
            horizon = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
            reason = F.when(time.isNull(), "untimed").when(time < horizon, "late")
            tagged = own.keep("rows", batch.withColumn(REASON, reason).withColumn(_DAY, F.to_date(time)))

            late = tagged.filter(F.col(REASON).isNotNull())
            counts = late.groupBy(*schema.names, REASON, _DAY).agg(F.count(F.lit(1)).alias(_COPIES))
            sums = F.coalesce("old." + _COPIES, F.lit(0)) + F.col("change." + _COPIES)
            own.merge(_late(schema), counts, combine={_COPIES: sums}, feed=False)

            fresh = dedup(tagged.filter(F.col(REASON).isNull()).drop(REASON), keys, [event_time])
            ledger, oldest = store.read(_ledger(schema, keys)), None
            if seen is not None:
                oldest = spark.range(1).select(F.to_date(horizon).alias("d")).first().d
                ledger = ledger.filter(F.col(_DAY) >= F.lit(oldest))  # the days that can hold a copy of a row in time
            fresh = own.keep("fresh", fresh.join(ledger.select(*keys), keys, "left_anti").select(*schema.names, _DAY))
            own.merge(_kept(schema, keys), fresh, feed=False)
            own.merge(_ledger(schema, keys), fresh.select(*keys, F.lit(True).alias("kept"), _DAY), feed=False)
            if oldest is not None:
                days = [name for name in store.files.names(f"{path}/tables/ledger") if name.startswith(f"{_DAY}=")]
                own.drop_partitions(_ledger(schema, keys), [name for name in days if _before(name, oldest)])
            newest = tagged.agg(F.greatest(F.max(time), F.lit(seen).cast("timestamp")).alias("newest"))
            own.merge(_MARKS, newest.select(F.lit("newest").alias("name"), "newest"), feed=False)

        store.apply(run_of(batch) or "", batch_id, prepare)

    return write


def _before(folder: str, day: dt.date) -> bool:
    """Whether a day's folder lies before ``day``; rows without a day are never in the ledger."""
    value = folder.partition("=")[2]
    return value[:4].isdigit() and dt.date.fromisoformat(value) < day


def read_kept(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key."""
    return Store(spark, path).read(_kept(schema, keys)).drop(_DAY)


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late or have no time, each with its ``reason``."""
    rows = Store(spark, path).read(_late(schema)).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(_COPIES).cast("int"))))
    return rows.select(*schema.names, REASON)
