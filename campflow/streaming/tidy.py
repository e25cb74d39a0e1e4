"""Small files of raw tables that are appended to: rewritten when their day is over."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campflow.sources.sinks import compact
from campflow.streaming.store import Files

#: A file is small below this; a day with at most so many files is left alone.
SMALL_BYTES, FEW_FILES = 128 << 20, 4


def crowded_days(spark: SparkSession, path: str, by: str, before: dt.date | str) -> DataFrame:
    """``day, files, bytes`` of the closed days (before ``before``) whose files are too many for their size.

    The reader lists names and sizes; no file is opened.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    day = F.regexp_extract("path", f"/{by}=([0-9-]+)/", 1)
    sizes = found.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    enough = F.greatest(F.lit(FEW_FILES), F.ceil(F.col("bytes") / SMALL_BYTES))
    return sizes.filter((F.col("day") != "") & (F.col("day") < str(before)) & (F.col("files") > enough))


def compact_closed(spark: SparkSession, path: str, schema: T.StructType, by: str, before: dt.date | str) -> list[str]:
    """Rewrite the crowded closed days of the Parquet table at ``path``, stored by the date ``by``; returns the days.

    Days from ``before`` on and days with few or large files are neither read nor written. The rows are written to a
    folder beside the table first and then put in the place of the old files, day by day. If that breaks off, the next
    call finishes it from there. Nothing may be appended to a closed day meanwhile; rows without a day stay as they are.
    The table must not be the output of a file stream, which keeps a list of its files.
    """
    files, copy = Files(spark, path), f"{path.rstrip('/')}.compacting"
    days: list[str] = []
    if not files.exists(f"{copy}/_SUCCESS"):
        files.delete(copy)
        days = sorted(row.day for row in crowded_days(spark, path, by, before).collect())
        if not days:
            return days
        rows = spark.read.schema(schema).parquet(path).filter(F.col(by).isin([dt.date.fromisoformat(day) for day in days]))
        compact(rows, [by]).write.partitionBy(by).parquet(copy)
    whole = spark.read.schema(schema).parquet(copy)
    days = days or sorted(name.partition("=")[2] for name in files.names(copy) if name.startswith(f"{by}="))
    compact(whole, [by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    files.delete(copy)
    return days
