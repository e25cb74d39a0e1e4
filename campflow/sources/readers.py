"""Scans of the raw tables, as a batch or as a stream, always with the declared schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from campflow.sources.schemas import BRONZE_CAMPAIGNS, BRONZE_CLICKS, BRONZE_SESSIONS


def _read(
    spark: SparkSession, location: str, schema: T.StructType, streaming: bool, fmt: str, options: dict[str, str]
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    if fmt == "table":
        return reader.options(**options).table(location)
    return reader.format(fmt).schema(schema).options(**options).load(location)


def read_clicks(
    spark: SparkSession, location: str, streaming: bool = False, fmt: str = "parquet",
    schema: T.StructType = BRONZE_CLICKS, **options: str,
) -> DataFrame:
    """Raw interactions. ``fmt="table"`` takes a table name; pass ``schema`` for files of an older shape."""
    return _read(spark, location, schema, streaming, fmt, options)


def read_campaigns(spark: SparkSession, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Campaign metadata: always a snapshot, also as the static side of a stream."""
    return _read(spark, location, BRONZE_CAMPAIGNS, False, fmt, options)


def read_sessions(
    spark: SparkSession, location: str, streaming: bool = False, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Raw app sessions."""
    return _read(spark, location, BRONZE_SESSIONS, streaming, fmt, options)
