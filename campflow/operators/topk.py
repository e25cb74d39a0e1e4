"""Ordered results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_columns(order: Sequence[str], tie_break: Sequence[str] = ()) -> list[Column]:
    """Sort columns from names, a leading ``-`` meaning descending.

    NULL sorts as the largest value (last ascending, first descending), as in the row store that answers the
    dashboard today.
    """
    out = []
    for name in [*order, *tie_break]:
        out.append(F.col(name[1:]).desc_nulls_first() if name.startswith("-") else F.col(name).asc_nulls_last())
    return out


def top_k(df: DataFrame, order: Sequence[str], n: int | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows, each task keeping only its own first ``n``; all rows, sorted, without ``n``."""
    ordered = df.orderBy(*order_columns(order, tie_break))
    return ordered if n is None else ordered.limit(n)


def with_rank(df: DataFrame, order: Sequence[str], n: int | None, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows with their place, 1 being the first. The window only ever sees ``n`` rows.

    Without ``n`` all rows are ranked, in one task: for lists that already have a limit.
    """
    window = Window.partitionBy(F.lit(1)).orderBy(*order_columns(order, tie_break))
    return (df if n is None else top_k(df, order, n, tie_break)).withColumn("rank", F.row_number().over(window))


def top_k_per(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows of every group in one pass, cut to ``n`` per group in each task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order_columns(order, tie_break))
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n).drop("_place")
