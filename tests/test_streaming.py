from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from campflow.plans import gold, silver
from campflow.plans.answers import Dashboard
from campflow.session import work_dir
from campflow.sources import paced, schemas, synth, testdata
from campflow.streaming.pipeline import (
    Layout, gold_stream, gold_table, hourly_windows, live_dashboard, refresh, start_gold, start_silver, start_sums,
)
from campflow.streaming.late import bounded_dedup, read_kept, read_late
from campflow.streaming.replica import batch_writer, read_feed, read_gold, read_replica, stream_upsert
from campflow.streaming.run import finish, start
from test_silver import click


@pytest.fixture(scope="module")
def arrivals(spark, sf_dir):
    """The events in four files, out of order: every file reaches over the whole period."""
    folder = work_dir(spark, "arrivals")
    events = testdata.read_events(spark, sf_dir)
    events.repartition(4, F.col("event_id") % 7).write.parquet(folder)
    return folder


@pytest.fixture(scope="module")
def bronze(spark, sf_dir, arrivals):
    return testdata.bronze_clicks(spark, sf_dir, testdata.stream_events(spark, arrivals, files_per_batch=1))


@pytest.fixture(scope="module")
def campaigns(spark, sf_dir):
    return silver.silver_campaigns(testdata.bronze_campaigns(spark, sf_dir), "2024-02-15")


@pytest.fixture(scope="module")
def batch_clicks(spark, sf_dir):
    return silver.silver_clicks(testdata.bronze_clicks(spark, sf_dir))


def same(a, b):
    return a.dtypes == b.dtypes and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_full_refresh_of_the_stream_equals_the_batch(spark, bronze, campaigns, batch_clicks):
    root = work_dir(spark, "deployment")
    layout, tables = refresh(spark, bronze, campaigns, root)
    answers = live_dashboard(spark, batch_clicks, lambda: campaigns, layout)
    assert answers.kpis_summary().collect() == Dashboard({"gold_daily_kpis": gold.daily_kpis(batch_clicks)}).kpis_summary().collect()
    for name in gold.TABLES:
        assert same(tables[name], gold.build(name, batch_clicks, campaigns)), name
    again = Layout.new(root)
    assert again.run != layout.run  # nothing of the earlier run is reused


def test_new_arrivals_update_the_replica(spark, sf_dir, campaigns, batch_clicks):
    """Two halves arriving one after the other, with a restart of both queries in between."""
    folder, layout = work_dir(spark, "halves"), Layout.new(work_dir(spark, "deployment"))
    events = testdata.read_events(spark, sf_dir)
    name = "gold_channel_performance"
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(folder)
        bronze = testdata.bronze_clicks(spark, sf_dir, testdata.stream_events(spark, folder))
        query = start_silver(bronze, layout)
        finish(query)
        seen = [p.observedMetrics["silver_clicks"] for p in query.recentProgress if "silver_clicks" in p.observedMetrics]
        assert sum(m["rows"] for m in seen) > 0 and sum(m["valid_campaign_id"] for m in seen) > 0
        finish(start_gold(spark, name, batch_clicks, layout))
    assert same(gold_table(spark, name, batch_clicks, campaigns, layout), gold.build(name, batch_clicks, campaigns))


def test_chained_update_mode(spark, bronze, campaigns, batch_clicks):
    """Deduplication and aggregation in one query, over several micro-batches."""
    folder = work_dir(spark, "chained")
    for name in ("gold_campaign_performance", "gold_segment_analysis"):
        changed = gold_stream(name, silver.silver_clicks(bronze), campaigns)
        keys, path = gold.PRIMARY_KEYS[name], f"{folder}/{name}"
        query = stream_upsert(changed, path, keys, f"{folder}/checkpoint-{name}")
        finish(query)
        assert sum(p.numInputRows > 0 for p in query.recentProgress) >= 3
        assert same(read_replica(spark, path, keys, changed.schema), gold.build(name, batch_clicks, campaigns))


def test_complete_mode_can_sort(spark, bronze, campaigns, batch_clicks):
    days = gold_stream("gold_daily_kpis", silver.silver_clicks(bronze), campaigns).orderBy("event_date")
    seen = []
    finish(start(days, lambda df, i: seen.append(df.collect()), work_dir(spark, "complete"), mode="complete"))
    assert seen[-1] == gold.daily_kpis(batch_clicks).collect()


def test_bounded_state(spark, sf_dir, bronze, batch_clicks):
    folder = work_dir(spark, "bounded")
    clean = silver.silver_clicks(bronze, forget_after="40 days")  # the period is shorter, so nothing is lost
    finish(start(clean, f"{folder}/data", f"{folder}/checkpoint"))
    assert same(spark.read.schema(clean.schema).parquet(f"{folder}/data"), batch_clicks)


@pytest.mark.parametrize("options", [{}, {"forget_after": "40 days"}])
def test_hot_ids_are_spread(spark, sf_dir, batch_clicks, options):
    """A third of the rows are copies of one event."""
    folder = work_dir(spark, "hot")
    events = testdata.read_events(spark, sf_dir)
    copies = events.filter("event_id = 77").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    events.unionAll(copies).repartition(8).write.parquet(f"{folder}/raw")
    raw = testdata.bronze_clicks(spark, sf_dir, testdata.stream_events(spark, f"{folder}/raw", files_per_batch=4))
    clean = silver.silver_clicks(raw, spread=4, **options)
    finish(start(clean, f"{folder}/data", f"{folder}/checkpoint"))
    assert same(spark.read.schema(clean.schema).parquet(f"{folder}/data"), batch_clicks)
    if not options:
        changed = gold_stream("gold_daily_kpis", silver.silver_clicks(raw, spread=4), None)
        finish(stream_upsert(changed, f"{folder}/days", ["event_date"], f"{folder}/days-checkpoint"))
        assert same(
            read_replica(spark, f"{folder}/days", ["event_date"], changed.schema), gold.daily_kpis(batch_clicks)
        )


def test_windows_close_once(spark, bronze, batch_clicks):
    folder = work_dir(spark, "windows")
    hours = hourly_windows(silver.silver_clicks(bronze), "30 days")
    assert hours.dtypes == gold.campaign_hourly_metrics(batch_clicks).dtypes
    finish(start(hours, f"{folder}/data", f"{folder}/checkpoint"))
    got = spark.read.schema(hours.schema).parquet(f"{folder}/data")
    assert got.exceptAll(gold.campaign_hourly_metrics(batch_clicks)).count() == 0


def test_sessions_stream(spark, sf_dir):
    folder = work_dir(spark, "sessions")
    raw = testdata.bronze_sessions(spark, sf_dir)
    raw.repartition(2).write.parquet(f"{folder}/raw")
    raw.limit(10).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/raw")
    clean = silver.silver_sessions(stream)
    finish(start(clean, f"{folder}/data", f"{folder}/checkpoint"))
    assert same(spark.read.schema(clean.schema).parquet(f"{folder}/data"), silver.silver_sessions(raw))


def test_a_repeated_batch_replaces_itself(spark):
    path = work_dir(spark, "replica")
    schema = spark.createDataFrame([], "k string, v int").schema
    write = batch_writer(path, ["k"])
    write(spark.createDataFrame([("a", 1), (None, 1)], schema), 0)
    for _ in range(2):
        write(spark.createDataFrame([("a", 2), ("b", 2)], schema), 1)
    write(spark.createDataFrame([("b", 3)], schema), 10)

    def rows(folder):
        return {r.k: r.v for r in read_replica(spark, folder, ["k"], schema).collect()}

    assert rows(path) == {"a": 2, "b": 3, None: 1}


def test_the_feed_of_a_replica(spark):
    path, schema = work_dir(spark, "fed"), spark.createDataFrame([], "k string, v int").schema
    write = batch_writer(path, ["k"], feed=True)
    for batch_id, rows in enumerate([[("a", 1)], [("a", 2), ("b", 1)], [("b", 1)]]):
        write(spark.createDataFrame(rows, schema), batch_id)
    images = sorted((r.version, r.k, r.v, r._change_type) for r in read_feed(spark, path, ["k"], schema).collect())
    assert images == [(1, "a", 1, "insert"), (2, "a", 1, "update_preimage"), (2, "a", 2, "update_postimage"), (2, "b", 1, "insert")]


def test_fifty_batches_keep_the_number_of_folders(spark):
    path, day = work_dir(spark, "days"), dt.date(2024, 1, 1)
    schema = spark.createDataFrame([], "k string, event_date date, v int").schema
    write, expected = batch_writer(path, ["k", "event_date"]), {}
    for batch_id in range(50):
        days = [day + dt.timedelta(batch_id % 5), None]
        rows = [(f"k{batch_id % 7}", days[0], batch_id), (f"once{batch_id}", days[1], batch_id)]
        for _ in range(2 if batch_id % 9 == 0 else 1):  # some are delivered again
            write(spark.createDataFrame(rows, schema), batch_id)
        expected |= {(k, d): v for k, d, v in rows}
    rows = read_replica(spark, path, ["k", "event_date"], schema).collect()
    assert {(r.k, r.event_date): r.v for r in rows} == expected and len(rows) == len(expected)
    assert len(list(Path(path, "tables").rglob("event_date=*"))) == 6
    assert all(len(list(folder.glob("*.parquet"))) == 1 for folder in Path(path, "tables").rglob("event_date=*"))
    assert [p.name for p in Path(path, "pending").iterdir()] == ["50"]


def test_a_renamed_campaign_keeps_its_counts(spark, campaigns):
    """Both names in one micro-batch, and a third one in the next."""
    folder, name = work_dir(spark, "renamed"), "gold_campaign_hourly_metrics"
    batches = [[click(event_id="1", campaign_name="b"), click(event_id="2", campaign_name="b"),
                click(event_id="3", campaign_name="a")], [click(event_id="4", campaign_name="c")]]
    for rows in batches:
        spark.createDataFrame(rows, schemas.BRONZE_CLICKS).write.mode("append").parquet(f"{folder}/raw")
        stream = silver.silver_clicks(spark.readStream.schema(schemas.BRONZE_CLICKS).parquet(f"{folder}/raw"))
        finish(start_sums(name, stream, f"{folder}/data", f"{folder}/checkpoint"))
    schema = gold.build(name, stream).schema
    (row,) = read_gold(spark, f"{folder}/data", name, schema).collect()
    assert (row.campaign_name, row.total_events) == ("c", 4)


def test_two_rows_for_a_key_fail(spark):
    write = batch_writer(work_dir(spark, "twice"), ["k"])
    with pytest.raises(Exception, match="more than one row for key"):
        write(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), 0)


def test_late_rows_are_kept_apart(spark):
    path = work_dir(spark, "late")
    write = bounded_dedup(path, ["k"], "t", "1 day")
    day = lambda d: dt.datetime(2024, 1, d)
    schema = spark.createDataFrame([], "k string, t timestamp").schema
    write(spark.createDataFrame([("a", day(10)), ("a", day(10)), ("b", day(9)), ("n", None)], schema), 0)
    for _ in range(2):
        write(spark.createDataFrame([("a", day(10)), ("new", day(1)), ("c", day(9))], schema), 1)
    assert sorted(r.k for r in read_kept(spark, path, schema).collect()) == ["a", "b", "c"]
    assert sorted((r.k, r.reason) for r in read_late(spark, path, schema).collect()) == [("n", "untimed"), ("new", "late")]


def test_fifty_batches_keep_the_ledger_small(spark):
    """Five days of ids are within the horizon, however many batches there were."""
    path = work_dir(spark, "ledger")
    schema = spark.createDataFrame([], "k long, t timestamp").schema
    write = bounded_dedup(path, ["k"], "t", "4 days")
    for batch_id in range(50):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=batch_id // 2)
        rows = [(batch_id // 2 * 10 + i, day) for i in range(5)]  # every second batch repeats the one before
        write(spark.createDataFrame(rows, schema), batch_id)
    assert sorted(r.k for r in read_kept(spark, path, schema).collect()) == sorted(d * 10 + i for d in range(25) for i in range(5))
    assert len(list(Path(path, "tables/ledger").glob("_day=*"))) <= 6
    assert len(list(Path(path, "tables/kept").glob("_day=*"))) == 25


def test_metadata_is_read_when_the_table_is(spark, campaigns):
    folder, name = work_dir(spark, "fresh"), "gold_segment_analysis"
    known = campaigns.filter("target_segment IS NOT NULL").select("campaign_id").first().campaign_id
    spark.createDataFrame([click(event_id="1", campaign_id=known)], schemas.BRONZE_CLICKS).write.parquet(f"{folder}/raw")
    clicks = silver.silver_clicks(spark.readStream.schema(schemas.BRONZE_CLICKS).parquet(f"{folder}/raw"))
    layout = Layout.new(folder)
    finish(start_sums(name, clicks, layout.data(name), layout.checkpoint(name)))
    assert [r.target_segment for r in gold_table(spark, name, clicks, campaigns.limit(0), layout).collect()] == [None]
    (row,) = gold_table(spark, name, clicks, lambda: campaigns, layout).collect()
    assert row.target_segment is not None and row.total_events == 1


def test_gold_stream_wants_a_stream(batch_clicks, campaigns):
    with pytest.raises(ValueError):
        gold_stream("gold_daily_kpis", batch_clicks, campaigns)
    with pytest.raises(ValueError):
        silver.dedup(paced.paced_clicks(batch_clicks.sparkSession), ["event_id"], order_by=["event_timestamp"])


def test_paced_source(spark):
    folder = work_dir(spark, "paced")
    stream = paced.paced_clicks(spark, rows_per_second=100, seed=5, base=dt.datetime(2024, 2, 15))
    assert stream.schema.names == schemas.BRONZE_CLICKS.names
    query = start(stream, f"{folder}/data", f"{folder}/checkpoint", trigger="1 second")
    deadline = time.time() + 60
    while time.time() < deadline and not any(p.numInputRows for p in query.recentProgress):
        time.sleep(0.5)
    query.stop()
    got = spark.read.schema(stream.schema).parquet(f"{folder}/data")
    assert got.count() > 0
    batch = synth.synth_clicks(spark, 10_000, seed=5, base=dt.datetime(2024, 2, 15))
    assert got.join(batch, got.columns, "left_anti").filter("action_element IS NOT NULL").count() == 0


def test_files_of_the_daily_query_follow_the_size_of_the_table(spark, sf_dir, monkeypatch):
    """No fixed number of files: Spark's own parts, where it does not join small ones, are more, and none has a large share."""
    import __spark_entry__ as contract

    layout = Layout.new(work_dir(spark, "daily"))
    monkeypatch.setattr(contract.Layout, "new", classmethod(lambda cls, root: layout))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        days = contract.queries()["stream_daily_complete"](spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(layout.data("silver_clicks"))
    rows = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(rows) > 3 and max(rows) < sum(rows) / 3
    assert days.agg(F.sum("total_events")).first()[0] == sum(rows)


def test_fresh_metadata_keeps_each_id_once(spark, sf_dir, monkeypatch):
    """The deduplication of a stream whose ids are spread has one state, and shuffles once."""
    import __spark_entry__ as entry

    seen, start_sums = [], entry.start_sums

    def looked_at(name, clicks, *where):
        seen.append(clicks._jdf.queryExecution().logical().toString().count("Deduplicate"))
        return start_sums(name, clicks, *where)

    monkeypatch.setattr(entry, "start_sums", looked_at)
    rows = entry.queries()["stream_fresh_metadata"](spark, sf_dir)
    assert seen == [1, 1]
    events = entry.queries()["gold_campaign_performance"](spark, sf_dir)
    assert sorted(map(str, rows.collect())) == sorted(map(str, events.collect()))
