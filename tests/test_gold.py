from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campflow.functions.measures import exact_ratio
from campflow.operators.sessions import sessions_from_events
from campflow.plans.answers import Dashboard
from campflow.plans import dashboard, gold, pipeline, serving, silver
from campflow.session import work_dir
from campflow.sources import synth
from test_silver import click

from campflow.sources import schemas

CAMPAIGN_SCHEMA = (
    "campaign_id string, campaign_name string, campaign_category string, campaign_channel string,"
    " target_segment string, budget_brl decimal(15,2), is_active boolean, is_expired boolean"
)


@pytest.fixture(scope="module")
def clicks(spark):
    def event(i, campaign, action, ms=100, value=None, **more):
        return click(
            event_id=f"e{i}", campaign_id=campaign, campaign_name=f"name {campaign}", action_type=action,
            response_time_ms=ms, conversion_value=value, **more,
        )

    rows = [
        event(1, "a", "impression"), event(2, "a", "impression"), event(3, "a", "impression"),
        event(4, "a", "click", None), event(5, "a", "conversion", 50, 10.25), event(6, "a", "conversion", 50, None),
        event(7, "a", "hover"), event(8, "a", None),
        event(9, "b", "conversion", None, 7.0),
        event(10, "zz", "swipe", 10), event(11, "zz", "click", 10), event(12, "zz", "click", 10),
    ]
    return silver.silver_clicks(spark.createDataFrame(rows, schemas.BRONZE_CLICKS))


@pytest.fixture(scope="module")
def campaigns(spark):
    rows = [
        ("a", "A", "seguros", "push", "pj", Decimal("100.00"), True, False),
        ("b", "B", "cartoes", "story", "varejo", Decimal("5.00"), False, True),
        ("idle", "I", "cartoes", "story", "varejo", Decimal("5.00"), False, True),
    ]
    return spark.createDataFrame(rows, CAMPAIGN_SCHEMA)


def test_campaign_performance(clicks, campaigns):
    rows = {r.campaign_id: r for r in gold.campaign_performance(clicks, campaigns).collect()}
    assert set(rows) == {"a", "b", "zz"}  # a campaign without events is absent
    a = rows["a"]
    assert (a.total_impressions, a.total_clicks, a.total_conversions, a.total_events) == (3, 1, 2, 8)
    assert a.ctr == 33.33 and a.conversion_rate == 200.0
    assert a.total_conversion_value == Decimal("10.25") and a.cost_per_click == Decimal("100.00")
    assert a.avg_response_time_ms == round(600 / 8, 2)  # rows without a time are in the divisor
    b = rows["b"]
    assert b.ctr == 0.0 and b.conversion_rate == 0.0 and b.cost_per_click is None
    assert b.avg_response_time_ms is None  # no time at all
    zz = rows["zz"]
    assert zz.campaign_name is None and zz.is_active is None and zz.cost_per_click is None
    assert zz.total_conversion_value is None  # not 0


def test_segments(clicks, campaigns):
    rows = {r.target_segment: r for r in gold.segment_analysis(clicks, campaigns).collect()}
    assert rows[None].total_events == 3 and rows["pj"].total_events == 8 and rows["varejo"].total_events == 1


def test_repeated_metadata_multiplies(clicks, campaigns):
    doubled = campaigns.unionAll(campaigns.filter("campaign_id = 'a'"))
    assert gold.campaign_performance(clicks, doubled).filter("campaign_id = 'a'").count() == 2
    pj = gold.segment_analysis(clicks, doubled).filter("target_segment = 'pj'").first()
    assert pj.total_events == 16
    events = clicks.join(doubled.select("campaign_id", "target_segment"), "campaign_id", "left")
    assert events.filter("target_segment = 'pj'").count() == 16


def test_tables_from_cells_equal_tables_from_events(clicks, campaigns):
    cells = gold.activity_cells(clicks)
    for name in gold.TABLES:
        own = {"gold_geo_performance": "geo", "gold_ab_test_results": "ab_test"}.get(name, "campaign_minute")
        direct, derived = gold.build(name, clicks, campaigns), gold.build(name, cells.filter(F.col("cell_set") == own), campaigns)
        minutes = gold.minute_cells(clicks)
        cascade = gold.build_from_cascade(name, minutes, gold.hour_cells(minutes), gold.side_cells(clicks), campaigns)
        assert cascade.dtypes == direct.dtypes and cascade.exceptAll(direct).count() == 0 == direct.exceptAll(cascade).count()
        assert direct.dtypes == derived.dtypes, name
        assert direct.exceptAll(derived).count() == 0 and derived.exceptAll(direct).count() == 0, name


def test_summary_of_nothing_is_zero(clicks, campaigns):
    row = serving.kpis_summary(gold.daily_kpis(clicks).filter("false")).first()
    assert [int(v) for v in row] == [0] * 6


@pytest.mark.parametrize(
    "part,whole,expected", [(537, 480, "111.88"), (1, 3, "33.33"), (1, 0, "0.00"), (2, 3, "66.67"), (-537, 480, "-111.88")]
)
def test_exact_ratio(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    assert str(df.selectExpr(f"{exact_ratio('p', 'w', 100, 2)} AS r").first().r) == expected


@pytest.fixture(scope="module")
def perf(spark):
    rows = [
        ("c1", "Big 100% off", "seguros", "push", 30), ("c2", "Small_offer", "cartoes", "story", 20),
        ("c3", "smallXoffer", "credito", "in_app_banner", 10), ("c4", None, None, "PUSH", 5),
    ]
    names = "campaign_id campaign_name campaign_category campaign_channel total_clicks".split()
    df = spark.createDataFrame(rows, names)
    zeros = {c: F.lit(1) for c in ("total_impressions", "total_conversions", "total_events")}
    return df.withColumns(zeros).withColumn("ctr", F.lit(1.0)).withColumn("target_segment", F.lit("pj"))


def found(perf, term):
    return [r.campaign_id for r in serving.search_campaigns(perf, term).collect()]


def test_search(perf):
    assert found(perf, "SMALL") == ["c2", "c3"]
    assert found(perf, "push") == ["c1", "c4"]  # other columns being NULL does not hide a match
    assert found(perf, "small_o") == ["c2", "c3"]  # _ stands for any one character
    assert found(perf, "big%off") == ["c1"]
    assert found(perf, "\\%") == ["c1"]  # escaped
    assert found(perf, "") == found(perf, "   ") == []
    assert found(perf, " 100") == ["c1"] and found(perf, "100 ") == []
    assert serving.search_campaigns(perf, "o", n=1).count() == 1


def test_nulls_sort_as_the_largest_value(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(None, 1), (day, None), (day, 2)], "event_date date, hour_of_day int")
    df = df.withColumns({c: F.lit(1) for c in ("impressions", "clicks", "conversions", "total_events")})
    got = [(r.event_date, r.hour_of_day) for r in serving.hourly(df).collect()]
    assert got == [(None, 1), (day, 2), (day, None)]


@pytest.fixture(scope="module")
def hourly(spark):
    def row(campaign, day, hour, clicks):
        return (campaign, f"n{campaign}", dt.date(2024, 1, day), hour, 10, clicks, 1, 12, 1.0)

    rows = [row("a", d, h, d * 100 + h) for d in (1, 2, 3) for h in range(24)]
    rows += [row("b", 3, h, h) for h in range(20, 24)]
    schema = (
        "campaign_id string, campaign_name string, event_date date, hour_of_day int, impressions bigint,"
        " clicks bigint, conversions bigint, total_events bigint, ctr double"
    )
    return spark.createDataFrame(rows, schema)


def test_cut_takes_late_hours_of_the_oldest_day(hourly):
    rows = serving.hourly(hourly, "a", n=30).collect()
    assert [(r.event_date.day, r.hour_of_day) for r in rows] == [(3, h) for h in range(24)] + [(2, h) for h in range(6)]


def test_trend_granularity(hourly):
    minute = hourly.withColumn("minute_of_hour", F.lit(5))
    assert "minute_of_hour" in serving.trend(hourly, minute, "minute").columns
    assert "minute_of_hour" in serving.trend(hourly, minute, "minute", "a").columns
    assert "minute_of_hour" not in serving.trend(hourly, minute, "fortnight").columns
    rows = serving.trend(hourly, minute, "minute").collect()
    assert [(r.event_date.day, r.hour_of_day) for r in rows[:2]] == [(3, 23), (3, 22)] and len(rows) == 60


def test_trend_series_is_the_last_part_in_order(hourly):
    rows = dashboard.trend_series(serving.hourly(hourly)).collect()
    assert len(rows) == 48
    assert (rows[0].label, rows[0].full_label) == ("00:00", "2024-01-02 00:00")
    assert (rows[-1].label, rows[-1].full_label) == ("23:00", "2024-01-03 23:00")


def test_hour_detail_takes_text_or_date(hourly):
    for day in ("2024-01-03", dt.date(2024, 1, 3)):
        assert [r.campaign_id for r in serving.hour_detail_top(hourly, day, 20).collect()] == ["a", "b"]


def test_compare_hours_and_series(hourly):
    rows = serving.compare_hours(hourly, "a", "b").collect()
    assert sorted((r.side for r in rows)) == [1] * 48 + [2] * 4
    series = dashboard.compare_hourly(hourly, "b", "a").collect()
    assert len(series) == 48 and series[-1].label == "2024-01-03 23:00"
    assert (series[-1].clicks1, series[-1].clicks2) == (23, 323)
    assert (series[0].label, series[0].clicks1) == ("2024-01-02 00:00", 0)
    assert len(serving.compare_hours(hourly, "b", "b").collect()) == 8
    assert {r.side for r in serving.compare_hours(hourly, "nobody", "b").collect()} == {2}


def test_compare_metrics(clicks, campaigns):
    perf = gold.campaign_performance(clicks, campaigns)
    rows = {r.metric: r for r in dashboard.compare_metrics(perf, "a", "b").collect()}
    assert len(rows) == 7
    assert rows["total_impressions"].trend == 1.0 and rows["total_clicks"].trend == 1.0
    assert rows["cost_per_click"].value2 is None and rows["cost_per_click"].trend == 1.0
    assert dashboard.compare_metrics(perf, "a", "nobody").count() == 0
    assert all(r.trend == 0 for r in dashboard.compare_metrics(perf, "a", "a").collect())


def test_shares(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1)], "k string, n bigint")
    assert {r.k: r.share for r in dashboard.share_of_total(df, "n").collect()} == {"x": 75.0, "y": 25.0}
    assert {r.k: round(r.share, 2) for r in dashboard.share_of_max(df, "n").collect()} == {"x": 100.0, "y": 33.33}
    none = df.withColumn("n", F.lit(0))
    assert {r.share for r in dashboard.share_of_total(none, "n").collect()} == {0.0}
    assert {r.share for r in dashboard.share_of_max(none, "n").collect()} == {0.0}


def test_cross_filter(perf):
    assert dashboard.cross_filter(perf).count() == 4
    assert dashboard.cross_filter(perf, channel="push").count() == 1
    assert dashboard.cross_filter(perf, segment="pj", channel="story").count() == 1
    assert dashboard.cross_filter_top(perf, n=2).count() == 2


def test_kpi_changes(spark):
    schema = "total_impressions bigint, total_clicks bigint, ctr double, total_conversions bigint"
    before = spark.createDataFrame([(10, 0, 1.0, 4)], schema)
    after = spark.createDataFrame([(12, 5, 1.0, 4)], schema)
    rows = dashboard.kpi_changes(before, after).collect()
    assert [tuple(r) for r in rows] == [("total_impressions", 10.0, 12.0)]  # from 0 is no change to flash


def test_overall_conversion_rate_needs_clicks(spark):
    df = spark.createDataFrame([(0, 5), (4, 1)], "total_clicks bigint, total_conversions bigint")
    rates = [r.overall_conversion_rate for r in dashboard.overall_conversion_rate(df).collect()]
    assert rates == [None, 25.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_table_accounts_for_every_event(spark, seed):
    base = dt.datetime(2024, 2, 15)
    raw = synth.synth_clicks(spark, 3000, partitions=3, seed=seed, base=base, sessions=100)
    clicks = silver.silver_clicks(raw.unionAll(raw.limit(500)))
    campaigns = silver.silver_campaigns(synth.synth_campaigns(spark, 9, seed, base.date()), base.date())
    for name in gold.TABLES:
        table = gold.build(name, clicks, campaigns)
        assert table.agg(F.sum("total_events")).first()[0] == 3000, name
        keys = gold.TABLES[name].primary_key
        assert table.count() == table.select(*keys).distinct().count(), name


def test_run_batch(spark, clicks, campaigns):
    base = dt.datetime(2024, 2, 15)
    raw = synth.synth_clicks(spark, 500, seed=3, base=base, sessions=20)
    bad = raw.limit(5).withColumn("campaign_id", F.lit(None).cast("string"))
    folder = work_dir(spark, "batch")
    result = pipeline.run_batch(
        raw.unionAll(bad), synth.synth_campaigns(spark, 12, 3, base.date()), sessions_from_events(raw), folder,
        base.date(),
    )
    assert set(result.tables) >= set(gold.TABLES)
    assert result.quality["silver_clicks"] == {
        "rows": 505, "valid_event_id": 0, "valid_campaign_id": 5, "valid_action_type": 0,
    }
    assert result.quality["silver_sessions"]["rows"] == 20
    perf = result.tables["gold_campaign_performance"]
    direct = gold.campaign_performance(silver.silver_clicks(raw), result.tables["silver_campaigns"])
    assert perf.exceptAll(direct).count() == 0 and direct.exceptAll(perf).count() == 0

    asked = Dashboard.stored(spark, folder)
    assert asked.kpis_summary().first().total_events == 500
    assert asked.campaigns_performance().count() == 12 and asked.campaigns_search("campaign 1").count() == 3
    assert asked.channels().count() == 4 and asked.ab_test().count() == 3 and asked.geo().count() > 0
    assert asked.segments().agg(F.sum("total_events")).first()[0] == 500
    days = asked.kpis_daily().collect()
    assert days == sorted(days, key=lambda r: r.event_date, reverse=True) and isinstance(days[0].total_clicks, float)
    hour = asked.campaigns_hourly().first()
    detail = asked.hour_detail(hour.event_date, int(hour.hour_of_day))
    assert 0 < detail["top_campaigns"].count() <= 5 and detail["channel_breakdown"].count() > 0
    assert asked.campaigns_trend("minute", "CMP-000003").count() > 0
    both = asked.compare("CMP-000003", "CMP-000004")
    assert both["campaigns"].count() == 2 and {r.side for r in both["hours"].collect()} == {1.0, 2.0}


def test_run_batch_into_the_catalog(spark):
    base = dt.datetime(2024, 2, 15)
    raw = synth.synth_clicks(spark, 100, seed=3, base=base, sessions=5)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS batch LOCATION '{work_dir(spark, 'batch')}'")
    sources = raw, synth.synth_campaigns(spark, 12, 3, base.date()), sessions_from_events(raw)
    pipeline.run_batch(*sources, "batch", base.date(), catalog=True)
    for name, table in gold.TABLES.items():
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED batch.{name}").collect()}
        assert about["Comment"] == table.comment
        assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES batch.{name}").collect()}["quality"] == "gold"
    assert spark.table("batch.gold_daily_kpis").agg(F.sum("total_events")).first()[0] == 100
    spark.sql("DROP DATABASE batch CASCADE")


def test_ranks_of_the_whole_list(spark):
    rows = [(str(i), "n", 1, i, 0, 0.0) for i in range(9)]
    top = spark.createDataFrame(rows, "campaign_id string, campaign_name string, impressions int, clicks int, conversions int, ctr double")
    assert [r.rank for r in dashboard.hour_rank(top).collect()] == list(range(1, 10))


@pytest.mark.parametrize(
    "term, found", [(r"a\\b", 1), (r"5\0\%", 1), (r"50%\x", 0), ("\\", 0), ("  ", 0), (r"50\%\z", 1)]
)
def test_backslashes_in_a_search(clicks, campaigns, term, found):
    perf = gold.campaign_performance(clicks, campaigns)
    named = perf.withColumn("campaign_name", F.when(F.col("campaign_id") == "a", r"a\b").otherwise("50%z"))
    named = named.filter("campaign_id != 'zz'").replace("push", "x").replace("story", "x")
    assert serving.search_campaigns(named, term).count() == found
