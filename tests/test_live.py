"""All tables from one stream, and from batches by date, against the batch results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_silver import click
from test_streaming import same

from campflow.plans import gold, serving, silver
from campflow.session import work_dir
from campflow.sources import schemas, testdata
from campflow.streaming import live
from campflow.streaming.run import finish
from campflow.streaming.store import Store


@pytest.fixture(scope="module")
def campaigns(spark, sf_dir):
    return silver.silver_campaigns(testdata.bronze_campaigns(spark, sf_dir), "2024-02-15")


@pytest.fixture(scope="module")
def clicks(spark, sf_dir):
    folder = work_dir(spark, "clean")
    silver.silver_clicks(testdata.bronze_clicks(spark, sf_dir)).write.parquet(folder)
    return spark.read.parquet(folder)


def cleaned(spark, rows):
    return silver.silver_clicks(spark.createDataFrame(rows, schemas.BRONZE_CLICKS))


def stream(spark, folder, parts):
    """One micro-batch for each part; the last query's progress."""
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/silver")
        query = live.start_live(spark.readStream.schema(part.schema).parquet(f"{folder}/silver"), f"{folder}/live", f"{folder}/checkpoint")
        finish(query)
    return query.lastProgress


@pytest.fixture(scope="module")
def deployed(spark, clicks):
    folder = work_dir(spark, "live")
    progress = stream(spark, folder, [clicks.filter(f"crc32(event_id) % 3 = {n}") for n in range(3)])
    assert len(progress.stateOperators) == 1
    return f"{folder}/live"


@pytest.mark.parametrize("name", gold.TABLES)
def test_every_table_equals_the_batch(spark, deployed, clicks, campaigns, name):
    assert same(live.live_table(spark, deployed, name, campaigns), gold.build(name, clicks, campaigns))


@pytest.mark.parametrize("name", [n for n in gold.TABLES if n not in gold.WITH_CAMPAIGNS])
def test_the_feeds_give_the_tables(spark, deployed, clicks, name):
    feed = live.live_feed(spark, deployed, name)
    latest = feed.filter("_change_type IN ('insert', 'update_postimage')")
    keys = gold.PRIMARY_KEYS[name]
    last = latest.groupBy(*keys).agg(F.max("version").alias("version"))
    same_key = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    rows = latest.alias("l").join(last.alias("r"), [*same_key, F.col("l.version") == F.col("r.version")], "left_semi")
    assert same(rows.drop("_change_type", "version"), gold.build(name, clicks))
    with pytest.raises(ValueError):
        live.live_feed(spark, deployed, "gold_segment_analysis")


def test_a_replay_of_everything_changes_nothing(spark, clicks, campaigns):
    folder = work_dir(spark, "replay")
    parts = [clicks.filter(f"crc32(event_id) % 2 = {n}") for n in range(2)]
    stream(spark, folder, parts)
    before = {name: live.live_table(spark, f"{folder}/live", name, campaigns).collect() for name in gold.TABLES}
    source = spark.readStream.schema(clicks.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/silver")
    finish(live.start_live(source, f"{folder}/live", f"{folder}/another"))
    for name, rows in before.items():
        assert sorted(map(repr, live.live_table(spark, f"{folder}/live", name, campaigns).collect())) == sorted(map(repr, rows)), name


def test_a_renamed_campaign_keeps_its_counts_and_takes_the_last_name(spark):
    folder = work_dir(spark, "renamed")
    batches = [[click(event_id="1", campaign_name="b"), click(event_id="2", campaign_name="b"), click(event_id="3", campaign_name="a")],
               [click(event_id="4", campaign_name="c")]]
    stream(spark, folder, [cleaned(spark, rows) for rows in batches])
    for name in ("gold_campaign_hourly_metrics", "gold_campaign_minute_metrics"):
        (row,) = live.live_table(spark, f"{folder}/live", name).collect()
        assert (row.campaign_name, row.total_events) == ("c", 4)


def test_sums_of_nothing_stay_null(spark):
    """No event has a latency or a value, then one has; no event without a time is lost."""
    folder = work_dir(spark, "nulls")
    empty = {"response_time_ms": None, "conversion_value": None}
    stream(spark, folder, [cleaned(spark, [click(event_id="1", **empty), click(event_id="2", event_timestamp=None, **empty)])])
    days = {r.event_date: r for r in live.live_table(spark, f"{folder}/live", "gold_daily_kpis").collect()}
    assert len(days) == 2 and None in days and all(r.sum_response_time_ms is None for r in days.values())
    more = [click(event_id="3", response_time_ms=0, conversion_value=None, action_type="conversion")]
    stream(spark, folder, [cleaned(spark, more)])
    both = cleaned(spark, [click(event_id="1", **empty), click(event_id="2", event_timestamp=None, **empty), *more])
    assert same(live.live_table(spark, f"{folder}/live", "gold_daily_kpis"), gold.daily_kpis(both))


def test_trends_over_live_tables_read_the_newest_days_only(spark, deployed, clicks):
    for name in ("gold_campaign_hourly_metrics", "gold_campaign_minute_metrics"):
        table = live.live_table(spark, deployed, name)
        answer = serving.newest_days(table, 2)
        assert {r.event_date for r in answer.select("event_date").distinct().collect()} == {
            r.event_date for r in clicks.select("event_date").distinct().orderBy(F.desc("event_date")).limit(2).collect()}
        plan = answer._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [((event_date" in plan and "subquery" in plan.lower()


def test_kpi_changes_of_each_batch(spark, deployed, clicks):
    changes = {(r.at, r.metric): (r.previous, r.current) for r in live.kpi_changes(spark, deployed).collect()}
    so_far = [serving.kpis_summary(gold.daily_kpis(clicks.filter(f"crc32(event_id) % 3 < {n}"))).first() for n in range(4)]
    for at in (2, 3):
        assert changes[at, "total_clicks"] == (so_far[at - 1].total_clicks, so_far[at].total_clicks)
    assert not any(at == 1 for at, _ in changes)  # nothing changes from zero


@pytest.fixture(scope="module")
def dated(spark, sf_dir):
    raw = testdata.bronze_clicks(spark, sf_dir)
    folder = work_dir(spark, "raw")
    raw.write.parquet(folder)
    return spark.read.parquet(folder)


def test_dates_are_refreshed_one_by_one(spark, dated, clicks, campaigns):
    """The last day comes on its own, after the others: nothing but that day is read or written."""
    root, day = work_dir(spark, "dates"), clicks.agg(F.max("event_date")).first()[0]
    assert len(live.refresh_dates(dated.filter(F.col("event_timestamp") < str(day)), root)) > 5
    store, table = Store(spark, root), live.silver_table(clicks)
    written = {name: _files(store, name) for name in ("silver_clicks", "cells", "hours", "minutes")}
    assert live.refresh_dates(dated.filter(F.col("event_timestamp") >= str(day)), root) == [day]
    for name, before in written.items():
        after = _files(store, name)
        assert before <= after and all(f"event_date={day}/" in path for path in after - before), name
    plan = store.read(table).filter(live.within("event_date", [day]))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(event_date" in plan and str(day) in plan
    for name in gold.TABLES:
        assert same(live.live_table(spark, root, name, campaigns), gold.build(name, clicks, campaigns)), name


def _files(store, name):
    return {f.path for f in store.spark.read.format("binaryFile").load(f"{store.root}/tables/{name}").select("path").collect()}


def test_arrivals_that_repeat_change_nothing(spark, dated, clicks, campaigns):
    root = work_dir(spark, "again")
    live.refresh_dates(dated, root, "first")
    live.refresh_dates(dated, root, "first")  # the same call again
    live.refresh_dates(dated.filter("crc32(event_id) % 5 = 0"), root, "second")
    assert same(live.live_table(spark, root, "gold_daily_kpis"), gold.daily_kpis(clicks))
    assert same(live.live_table(spark, root, "gold_campaign_performance", campaigns), gold.campaign_performance(clicks, campaigns))


def test_a_smaller_copy_takes_the_place_of_a_stored_one(spark):
    """What differs between copies of an event follows the smallest, also across calls: sums are taken back."""
    root, when = work_dir(spark, "copies"), "2024-01-01T10:30:00"
    live.refresh_dates(spark.createDataFrame([click(event_id="1", event_timestamp=when, geo_city="B", action_type="click")], schemas.BRONZE_CLICKS), root)
    live.refresh_dates(spark.createDataFrame([click(event_id="1", event_timestamp="2024-01-01T10:20:00", geo_city="A", action_type="dismiss")], schemas.BRONZE_CLICKS), root)
    (place,) = live.live_table(spark, root, "gold_geo_performance").collect()
    assert (place.geo_city, place.total_events, place.total_clicks) == ("A", 1, 0)
    (minute,) = live.live_table(spark, root, "gold_campaign_minute_metrics").collect()
    assert minute.minute_of_hour == 20


def test_arrivals_of_new_dates_are_deduplicated_once(spark, dated, clicks, monkeypatch):
    """Nothing is stored for their dates, so their rows are not brought together with any: no second and third shuffle."""
    def never(*_):
        raise AssertionError("no stored rows to compare with")

    plans, kept = [], live.Batch.merge

    def merge(batch, table, changes, **how):
        images = kept(batch, table, changes, **how)
        plans.append((table.name, how.get("unique", False)))
        return images

    monkeypatch.setattr(live, "dedup", never)
    monkeypatch.setattr(live.Batch, "merge", merge)
    root = work_dir(spark, "new")
    live.refresh_dates(dated, root)
    assert ("silver_clicks", True) in plans
    assert same(live.live_table(spark, root, "gold_daily_kpis"), gold.daily_kpis(clicks))
    stored = Store(spark, root).read(live.silver_table(clicks))
    assert stored.count() == clicks.count() == stored.select("event_id").distinct().count()


def test_the_dashboard_over_live_tables(spark, deployed, clicks, campaigns):
    answers = live.live_tables(spark, deployed, lambda: campaigns)
    assert answers.kpis_summary().collect() == serving.kpis_summary(gold.daily_kpis(clicks)).collect()
    assert answers.campaigns_trend("minute").count() == 60
