"""The shape of physical plans: what must not grow with the data, and what must stay distributed."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from campflow.operators.dedup import dedup
from campflow.operators.topk import top_k
from campflow.plans import gold, silver
from campflow.session import configure, input_bytes, shuffle_plan, sized_shuffles, work_dir
from campflow.sources import testdata


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# those that only read what they have written, and those of the training-text operators, are left out
RUN = ("stream_", "stored_", "full_refresh", "materialized_", "bounded_", "silver_clicks_from_files", "pipeline", "live_",
       "refreshed_", "replica_", "catalog_", "compacted_")
LAZY = [n for n in contract.queries() if not n.startswith(RUN) and not (contract.llm and n in contract.llm.QUERIES)]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "BatchEval"):
        assert bad not in text


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(dedup(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert text.index(", Final") < text.index("Exchange hashpartitioning") < text.index(", Partial")


def test_unused_columns_are_not_read(spark, sf_dir):
    folder = work_dir(spark, "pruned")
    testdata.bronze_clicks(spark, sf_dir).write.parquet(folder)
    raw = spark.read.parquet(folder)
    text = plan(gold.channel_performance(silver.silver_clicks(raw)))
    scan = text[text.index("FileScan"):]
    read = {c.split("#")[0] for c in scan[scan.index("[") + 1:scan.index("]")].split(",")}
    assert read == {"event_id", "campaign_id", "campaign_channel", "action_type", "response_time_ms"}
    assert "IsNotNull(event_id)" in text and "IsNotNull(campaign_id)" in text


def test_events_are_summed_before_the_campaign_join(spark, sf_dir):
    clicks = silver.silver_clicks(testdata.bronze_clicks(spark, sf_dir))
    campaigns = silver.silver_campaigns(testdata.bronze_campaigns(spark, sf_dir), "2024-02-15")
    for build in (gold.campaign_performance, gold.segment_analysis):
        text = plan(build(clicks, campaigns))
        assert text.index("LeftOuter") < text.index("partial_count")


def test_cells_cost_one_scan_and_two_shuffles(spark, sf_dir):
    folder = work_dir(spark, "cells")
    testdata.bronze_clicks(spark, sf_dir).write.parquet(folder)
    text = plan(gold.activity_cells(silver.silver_clicks(spark.read.parquet(folder))))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


def test_top_k_is_not_a_full_sort(spark):
    text = plan(top_k(spark.range(100), ["-id"], 5))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_one_campaign_is_found_by_the_scan(spark, sf_dir):
    folder = work_dir(spark, "stored")
    gold.campaign_hourly_metrics(silver.silver_clicks(testdata.bronze_clicks(spark, sf_dir))).write.parquet(folder)
    from campflow.plans import serving

    text = plan(serving.hourly(spark.read.parquet(folder), contract.CAMPAIGN))
    assert f"EqualTo(campaign_id,{contract.CAMPAIGN})" in text


def test_shuffles_are_sized_by_the_input(spark, sf_dir):
    def sized(size):
        return [int(v) for v in shuffle_plan(size, 8).values()]

    gb, tb = 1024**3, 1024**4
    assert sized(1) == [8, gb // 8]
    assert sized(100 * gb) == [800, gb // 8]
    reducers, split = sized(100 * tb)
    # no more than a billion blocks
    assert reducers == 20_000 and 100 * tb / split <= 32_000 and split <= 4 * gb
    events = testdata.read_events(spark, sf_dir)
    assert input_bytes(events) == Path(f"{sf_dir}/events.parquet").stat().st_size
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with sized_shuffles(events):
        assert spark.conf.get(key) == "8"
    assert spark.conf.get(key, None) == before


def test_a_trend_reads_the_newest_days_only(spark, sf_dir):
    from campflow.plans import serving

    clicks = silver.silver_clicks(testdata.bronze_clicks(spark, sf_dir))
    folder = work_dir(spark, "by_day")
    gold.campaign_hourly_metrics(clicks).write.partitionBy("event_date").parquet(folder)
    stored = spark.read.parquet(folder)
    few = serving.hourly(stored, n=30, by_day=True)
    assert few.collect() == serving.hourly(stored, n=30).collect()
    text = few._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters"):].split("]")[0]
    assert "event_date" in filters and "subquery" in filters.lower()


class _Session:
    """A stand-in with the two things that tell where to work."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)


def test_work_dir_follows_the_session():
    assert work_dir(_Session("yarn", "/shared/folder/"), "x").startswith("/shared/folder/x-")
    assert work_dir(_Session("local[2]", "/shared/folder"), "x").startswith("/shared/folder/x-")
    with pytest.raises(ValueError):
        work_dir(_Session("yarn"), "x")
    first, second = (work_dir(_Session("local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.mark.parametrize("name", ["hour_detail_channels", "channel_share"])
def test_an_hours_channels_read_the_events_once(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    # a share needs the whole twice; Spark reuses the exchange when it runs
    assert text.count("events.parquet") <= (1 if name == "hour_detail_channels" else 2)


def test_a_task_reads_few_files_of_rows(spark):
    """Stored interactions are many times larger as rows, so a task gets less of them than Spark would give it."""
    key, least = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key)
    folder = work_dir(spark, "many")
    spark.range(0, 100, 1, 100).write.parquet(folder)
    try:
        spark.conf.set(least, "1")
        spark.conf.set(key, "128m")
        configure(spark)
        assert spark.read.parquet(folder).rdd.getNumPartitions() >= 100 * 4 // 32
        spark.conf.set(key, "16m")
        assert configure(spark).conf.get(key) == "16m"
    finally:
        spark.conf.unset(least)
        spark.conf.set(key, before)
