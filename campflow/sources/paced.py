"""A paced stream of generated interactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from campflow.sources.synth import clicks_of


def paced_clicks(
    spark: SparkSession, rows_per_second: int = 100, seed: int = 0, base: dt.datetime | None = None, **shape: int
) -> DataFrame:
    """Raw interactions arriving at a steady rate, for a demonstration or a soak test."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return clicks_of(ticks.select("value"), "value", seed=seed, base=base, **shape)
