from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campflow.sources import schemas, synth

BASE = dt.datetime(2024, 2, 15, 13, 30)
N = 20_000


@pytest.fixture(scope="module")
def clicks(spark):
    return synth.synth_clicks(spark, N, partitions=4, seed=11, base=BASE, campaigns=12, sessions=500).cache()


def shares(df, column):
    return {r[0]: r[1] / N for r in df.groupBy(column).count().collect()}


def test_schema(clicks):
    assert [(f.name, f.dataType) for f in clicks.schema] == [(f.name, f.dataType) for f in schemas.BRONZE_CLICKS]


def test_partitioning_does_not_matter(spark, clicks):
    other = synth.synth_clicks(spark, N, partitions=7, seed=11, base=BASE, campaigns=12, sessions=500)
    assert clicks.exceptAll(other).count() == 0
    reseeded = synth.synth_clicks(spark, N, seed=12, base=BASE, campaigns=12, sessions=500)
    assert reseeded.join(clicks, ["event_id", "campaign_id", "session_id", "action_type"]).count() < N / 50


def test_weights(clicks):
    actions = shares(clicks, "action_type")
    for action, weight in zip(schemas.ACTION_TYPES, synth.ACTION_WEIGHTS):
        assert actions[action] == pytest.approx(weight / 100, abs=0.015)
    hours = shares(clicks, F.substring("event_timestamp", 12, 2))
    for hour, weight in enumerate(synth.HOUR_WEIGHTS):
        assert hours[f"{hour:02d}"] == pytest.approx(weight / sum(synth.HOUR_WEIGHTS), abs=0.015)
    assert shares(clicks, "is_personalized")[True] == pytest.approx(0.65, abs=0.015)
    assert len(shares(clicks, "campaign_id")) == 12
    assert all(v == pytest.approx(1 / 12, abs=0.01) for v in shares(clicks, "campaign_id").values())


def test_ranges(clicks):
    row = clicks.agg(
        F.min("response_time_ms"), F.max("response_time_ms"), F.min("event_timestamp"), F.max("event_timestamp"),
        F.count_distinct("event_id"), F.count_distinct("session_id"),
    ).first()
    assert row[0] == 50 and row[1] == 800
    assert row[2] >= "2024-02-09T00:00:00" and row[3] <= "2024-02-15T23:59:59"
    assert row[4] == N and row[5] == 500


def test_dependent_columns(clicks):
    assert clicks.filter("screen_name = referrer_screen").count() == 0
    assert clicks.select("screen_name", "referrer_screen").distinct().count() == 90
    acted = F.col("action_type").isin("click", "deep_link", "conversion")
    assert clicks.filter(acted != F.col("action_element").isNotNull()).count() == 0
    assert clicks.filter("action_type <> 'conversion' AND (conversion_value <> 0 OR conversion_product <> '')").count() == 0
    converted = clicks.filter("action_type = 'conversion'")
    assert converted.filter("conversion_product = ''").count() == 0
    for category in schemas.CATEGORIES:
        low, high = synth.CONVERSION_RANGE.get(category, (0, 0))
        got = converted.filter(F.col("campaign_category") == category)
        assert got.filter(~F.col("conversion_value").between(low, high)).count() == 0 and got.count() > 0


def test_session_attributes_are_constant(spark, clicks):
    attributes = ["session_id", "customer_id", "device_id", "device_os", "app_version", "geo_region", "geo_city"]
    used = clicks.select(*attributes).distinct()
    assert used.count() == 500
    assert used.exceptAll(synth.synth_sessions(spark, 500, seed=11).select(*attributes)).count() == 0


def test_campaigns(spark, clicks):
    campaigns = synth.synth_campaigns(spark, 200, seed=11, base_date=BASE.date())
    assert [(f.name, f.dataType) for f in campaigns.schema] == [(f.name, f.dataType) for f in schemas.BRONZE_CAMPAIGNS]
    rows = campaigns.collect()
    for r in rows:
        start, end = dt.date.fromisoformat(r.campaign_start_date), dt.date.fromisoformat(r.campaign_end_date)
        assert 10 <= (BASE.date() - start).days <= 60 and 30 <= (end - start).days <= 90
        assert r.is_active == (end >= BASE.date())
    assert {r.target_segment for r in rows} == set(schemas.SEGMENTS) and len({r.is_active for r in rows}) == 2
    same = ["campaign_id", "campaign_name", "campaign_channel", "campaign_category"]
    assert clicks.select(*same).distinct().exceptAll(campaigns.select(*same)).count() == 0
