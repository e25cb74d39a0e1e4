"""One row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Groups per key in which a stream first drops copies.
SPREAD = 8


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), spread: int = SPREAD) -> DataFrame:
    """Keep one row per key.

    ``order_by`` (batch only) names the columns whose smallest values tell the copy to keep; remaining ties are
    settled by the other columns, so that recomputing a lost task gives the same row again. Without it any copy may
    be kept, and columns that nobody uses later are pruned.

    The batch form ranks the copies: as only the first is wanted, Spark already drops all others of a task before
    the shuffle, so a key with very many copies is cheap. (dropDuplicates has that too, but aggregates each column
    on its own, which takes half as long again.)

    A stream keeps the first copy to arrive and has no such step. As single keys may make up much of a stream, it
    drops copies in ``spread`` groups per key first, by input task, so that no task gets more than a fraction of them;
    the price is a second shuffle and keeping every key twice, and 1 saves it where keys are known to be spread.
    """
    if df.isStreaming:
        if order_by:
            raise ValueError("a stream keeps the first copy to arrive")
        return _spread_out(df, keys, spread, lambda part, by: part.dropDuplicates(by))
    rest = [c for c in df.columns if c not in order_by and c not in keys] if order_by else []
    window = Window.partitionBy(*keys).orderBy(*(order_by or keys), *rest)
    return df.withColumn("_copy", F.row_number().over(window)).filter("_copy = 1").drop("_copy")


def dedup_within(
    df: DataFrame, keys: Sequence[str], event_time: str, delay: str, spread: int = SPREAD
) -> DataFrame:
    """Streaming form with bounded state: a key is forgotten ``delay`` after its event time.

    Spark drops rows that are older than that on arrival, whether their key was seen or not. Where none may be lost,
    :func:`campflow.streaming.late.bounded_dedup` keeps them apart.
    """
    timed = df.withWatermark(event_time, delay)
    return _spread_out(timed, keys, spread, lambda part, by: part.dropDuplicatesWithinWatermark(by))


def _spread_out(
    df: DataFrame, keys: Sequence[str], spread: int, drop: Callable[[DataFrame, list[str]], DataFrame]
) -> DataFrame:
    if spread > 1:
        grouped = df.withColumn("_group", F.expr(f"spark_partition_id() % {spread}"))
        df = drop(grouped, [*keys, "_group"]).drop("_group")
    return drop(df, list(keys))
