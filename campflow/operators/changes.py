"""Keyed tables: change feed between two states, and last-value-wins updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"


def _same_key(keys: Sequence[str]) -> Column:
    """Key equality under which NULL equals NULL; still a hash or merge join."""
    return reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two states of a table with one row per key.

    ``_change_type`` is insert, delete, update_preimage or update_postimage; unchanged rows are left out.
    """
    columns = after.columns
    old = before.select(F.struct(*columns).alias("old"), *keys).alias("b")
    new = after.select(F.struct(*columns).alias("new"), *keys).alias("a")
    pairs = old.join(new, _same_key(keys), "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))

    def entry(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    entries = (
        F.when(F.col("old").isNull(), F.array(entry("insert", "new")))
        .when(F.col("new").isNull(), F.array(entry("delete", "old")))
        .otherwise(F.array(entry("update_preimage", "old"), entry("update_postimage", "new")))
    )
    return pairs.select(F.explode(entries).alias("e")).select("e.row.*", F.col("e.kind").alias(CHANGE_TYPE))


def _row(columns: Sequence[str], keys: Sequence[str]) -> Column:
    return F.struct(*([c for c in columns if c not in keys] or keys))


def _unpack(keyed: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return keyed.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in columns])


def _refuse(keyed: DataFrame, ambiguous: Column, keys: Sequence[str]) -> DataFrame:
    """Fail the job on the first key for which ``ambiguous`` holds."""
    message = F.concat(F.lit("more than one row for key "), F.to_json(F.struct(*keys)))
    return keyed.filter(F.when(ambiguous, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, failing when a key occurs twice."""
    keyed = df.groupBy(*keys).agg(F.first(_row(df.columns, keys)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    return _unpack(_refuse(keyed, F.col("_copies") > 1, keys), df.columns, keys)


def latest(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The newest row of every key in a log that holds a key at most once per version.

    Aggregates instead of sorting windows: each task sends at most one row per key through the only shuffle.
    NULL keys form a key.
    """
    columns = [c for c in log.columns if c != version]
    keyed = log.groupBy(*keys).agg(F.max_by(_row(columns, keys), version).alias("_row"))
    return _unpack(keyed, columns, keys)


def _overlay(older: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both, those of ``newer`` winning. A key that is twice in either of them is an error."""
    both = older.withColumn("_newer", F.lit(False)).unionByName(newer.withColumn("_newer", F.lit(True)))
    keyed = both.groupBy(*keys).agg(
        F.max_by(_row(older.columns, keys), "_newer").alias("_row"),
        F.count_if(~F.col("_newer")).alias("_older_rows"),
        F.count_if("_newer").alias("_newer_rows"),
    )
    twice = (F.col("_older_rows") > 1) | (F.col("_newer_rows") > 1)
    return _unpack(_refuse(keyed, twice, keys), older.columns, keys)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every row of ``changes`` inserted, or put in place of the row with the same key."""
    return _overlay(target, changes.select(*target.columns), keys)


def apply_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a change feed: ``apply_feed(a, change_feed(a, b, keys), keys)`` has the rows of ``b``."""
    moves = feed.filter(F.col(CHANGE_TYPE) != "update_preimage").withColumn("_gone", F.col(CHANGE_TYPE) == "delete")
    merged = _overlay(before.withColumn("_gone", F.lit(False)), moves.drop(CHANGE_TYPE), keys)
    return merged.filter(~F.col("_gone")).select(*before.columns)
