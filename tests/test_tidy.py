from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_streaming import same

from campflow.session import work_dir
from campflow.streaming import tidy
from campflow.streaming.store import Files

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def table(spark):
    """Ten files a day for the first and the last day, one for the second, and some rows without a day."""
    path = work_dir(spark, "raw")
    rows = spark.range(600).select("id", F.element_at(F.array(*map(F.lit, DAYS)), (F.col("id") % 3 + 1).cast("int")).alias("day"))
    rows.filter(F.col("day") != DAYS[1]).repartition(10, "id").write.partitionBy("day").parquet(path)
    more = rows.filter(F.col("day") == DAYS[1]).unionByName(spark.range(5).select("id", F.lit(None).cast("date").alias("day")))
    more.coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    return path, "id long, day date"


def read(spark, table):
    return spark.read.schema(table[1]).parquet(table[0])


def counts(spark, table):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table[0])
    return {r.d: r["count"] for r in found.groupBy(F.regexp_extract("path", "day=([^/]+)/", 1).alias("d")).count().collect()}


def test_crowded_closed_days_are_rewritten(spark, table):
    before, files = read(spark, table).collect(), counts(spark, table)
    schema = read(spark, table).schema
    assert files["2024-01-01"] == 10 == files["2024-01-03"]
    assert tidy.compact_closed(spark, table[0], schema, "day", DAYS[2]) == ["2024-01-01"]
    after = counts(spark, table)
    assert after == files | {"2024-01-01": 1}
    assert sorted(map(repr, read(spark, table).collect())) == sorted(map(repr, before))
    assert tidy.compact_closed(spark, table[0], schema, "day", DAYS[2]) == []


def test_a_call_that_broke_off_is_finished(spark, table):
    """The copy is whole, and half of the day is gone from the table."""
    rows, schema = read(spark, table).collect(), read(spark, table).schema
    read(spark, table).filter(F.col("day") == DAYS[0]).write.partitionBy("day").parquet(f"{table[0]}.compacting")
    Files(spark, table[0]).delete(f"{table[0]}/day=2024-01-01")
    assert tidy.compact_closed(spark, table[0], schema, "day", DAYS[2]) == ["2024-01-01"]
    assert sorted(map(repr, read(spark, table).collect())) == sorted(map(repr, rows))


def test_a_copy_that_is_not_whole_is_not_used(spark, table):
    rows, schema = read(spark, table).collect(), read(spark, table).schema
    half = f"{table[0]}.compacting"
    read(spark, table).filter(F.col("day") == DAYS[0]).limit(3).write.partitionBy("day").parquet(half)
    Files(spark, half).delete(f"{half}/_SUCCESS")
    tidy.compact_closed(spark, table[0], schema, "day", DAYS[2])
    assert sorted(map(repr, read(spark, table).collect())) == sorted(map(repr, rows))
