from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from campflow.functions import columns as C
from campflow.operators.dedup import dedup
from campflow.operators.quality import Rule, expect, expect_or_drop, parse_rule, quality_report, uniqueness_report
from campflow.plans import silver
from campflow.sources import readers, schemas, sinks
from campflow.session import work_dir


def click(**values):
    row = dict.fromkeys(schemas.BRONZE_CLICKS.names)
    row |= {"event_id": "e1", "campaign_id": "c1", "action_type": "click", "event_timestamp": "2024-01-15T10:00:00"}
    return row | values


def clicks(spark, *rows):
    return spark.createDataFrame([click(**r) for r in rows], schemas.BRONZE_CLICKS)


@pytest.mark.parametrize(
    "time,expected",
    [
        ("2024-01-15T08:59:59", False),  # Monday
        ("2024-01-15T09:00:00", True),
        ("2024-01-19T18:59:59.999999", True),  # Friday
        ("2024-01-19T19:00:00", False),
        ("2024-01-20T12:00:00", False),  # Saturday
        ("2024-01-21T12:00:00", False),  # Sunday
    ],
)
def test_business_hours(spark, time, expected):
    row = silver.silver_clicks(clicks(spark, {"event_timestamp": time})).first()
    assert row.is_business_hours is expected
    assert row.hour_of_day == int(time[11:13])
    assert row.event_date == dt.date.fromisoformat(time[:10])


def test_day_of_week_starts_on_sunday(spark):
    assert silver.silver_clicks(clicks(spark, {"event_timestamp": "2024-01-21T12:00:00"})).first().day_of_week == 1


def test_typing_and_bad_values(spark):
    row = silver.silver_clicks(clicks(spark, {"conversion_value": 12.5, "event_timestamp": "yesterday"})).first()
    assert row.conversion_value == Decimal("12.50")
    assert row.event_timestamp is None and row.event_date is None and row.is_business_hours is None


def test_overflowing_money_becomes_null(spark):
    assert silver.silver_clicks(clicks(spark, {"conversion_value": 1e20})).first().conversion_value is None


def test_absent_columns_are_added(spark):
    old = clicks(spark, {}).drop("conversion_value", "conversion_product")
    kinds = dict(silver.silver_clicks(old).dtypes)
    assert kinds["conversion_value"] == "decimal(15,2)" and kinds["conversion_product"] == "string"


def test_null_keys_dropped_and_unknown_action_kept(spark):
    raw = clicks(
        spark,
        {"event_id": None},
        {"event_id": "e2", "campaign_id": None},
        {"event_id": "e3", "action_type": "hover"},
        {"event_id": "e4", "action_type": None},
    )
    assert {r.event_id for r in silver.silver_clicks(raw).collect()} == {"e3", "e4"}


def test_a_bad_copy_never_displaces_a_good_one(spark):
    raw = clicks(spark, {"campaign_id": None}, {"campaign_id": "c9"})
    assert [r.campaign_id for r in silver.silver_clicks(raw).collect()] == ["c9"]


def test_silver_is_idempotent_over_repeats(spark):
    raw = clicks(spark, {}, {"event_id": "e2"})
    once, twice = silver.silver_clicks(raw), silver.silver_clicks(raw.unionAll(raw))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_dedup_order_picks_one_whole_copy(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q")], "k string, t int, v string")
    assert sorted(map(tuple, dedup(df, ["k"], ["t"]).collect())) == [("a", 1, "y"), ("b", None, "q")]
    assert dedup(df, ["k"]).count() == 2


def test_campaigns(spark):
    def campaign(i, end):
        row = dict.fromkeys(schemas.BRONZE_CAMPAIGNS.names)
        return row | {
            "campaign_id": i, "campaign_start_date": "2024-01-01", "campaign_end_date": end, "budget_brl": 10.0,
        }

    raw = spark.createDataFrame(
        [campaign("a", "2024-02-14"), campaign("b", "2024-02-15"), campaign(None, "2024-02-15"), campaign("c", "soon")],
        schemas.BRONZE_CAMPAIGNS,
    )
    rows = {r.campaign_id: r for r in silver.silver_campaigns(raw, "2024-02-15").collect()}
    assert rows["a"].is_expired is True and rows["b"].is_expired is False and rows["c"].is_expired is None
    assert rows["b"].duration_days == 45 and rows["b"].budget_brl == Decimal("10.00")
    assert set(rows) == {"a", "b", "c"}
    assert silver.silver_campaigns(raw).filter("is_expired").count() == 2  # against the current date
    doubled = raw.unionAll(raw)
    assert silver.silver_campaigns(doubled, "2024-02-15").count() == 6
    assert silver.silver_campaigns(doubled, "2024-02-15", unique=True).count() == 3


@pytest.mark.parametrize(
    "clicks_,seconds,level",
    [(5, 600, "high"), (5, 599, "medium"), (4, 600, "medium"), (2, 180, "medium"), (1, 600, "low"), (5, 179, "low")],
)
def test_engagement(spark, clicks_, seconds, level):
    start = dt.datetime(2024, 1, 1, 10, 0, 0, 900_000)
    end = dt.datetime(2024, 1, 1, 10) + dt.timedelta(seconds=seconds)
    row = dict.fromkeys(schemas.BRONZE_SESSIONS.names) | {
        "session_id": "s", "session_start": start.isoformat(), "session_end": end.isoformat(),
        "total_events": 9, "total_clicks": clicks_,
    }
    got = silver.silver_sessions(spark.createDataFrame([row], schemas.BRONZE_SESSIONS)).first()
    assert got.session_duration_minutes == seconds / 60.0  # fractions of a second are cut on both ends
    assert got.engagement_level == level


def test_unknown_duration_is_low(spark):
    row = dict.fromkeys(schemas.BRONZE_SESSIONS.names) | {"session_id": "s", "total_clicks": 50}
    got = silver.silver_sessions(spark.createDataFrame([row], schemas.BRONZE_SESSIONS)).first()
    assert got.session_duration_minutes is None and got.engagement_level == "low"


def test_rules_count_without_dropping(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    seen = Observation("seen")
    assert expect(df, "positive", "x > 0", seen).count() == 3
    assert seen.get == {"rows": 3, "positive": 2}  # an unknown outcome is a failure
    dropped = Observation("dropped")
    assert expect_or_drop(df, "positive", "x > 0", dropped).count() == 1
    assert dropped.get["positive"] == 2
    assert expect_or_drop(df, "positive", "x > 0").count() == 1


def test_quality_report(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    rules = [Rule("known", "x IS NOT NULL", drops=True), Rule("positive", "x > 0")]
    rows = [tuple(r) for r in quality_report(df, rules, "d").orderBy("rule").collect()]
    assert rows == [("d", "known", "drop", 2, 1, 1), ("d", "positive", "warn", 1, 2, 0)]
    empty = quality_report(df.filter("false"), rules, "d").collect()
    assert [(r.passed, r.failed) for r in empty] == [(0, 0), (0, 0)]


def test_uniqueness_and_readability(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "soon"), ("b", None)], "k string, d string")
    assert tuple(uniqueness_report(df, ["k"], "d").first()) == ("d", "unique_k", "warn", 1, 2, 0)
    assert tuple(uniqueness_report(df.filter("false"), ["k"], "d").first())[3:] == (0, 0, 0)
    rule = parse_rule("d", "try_cast(d AS date)")
    assert tuple(quality_report(df, [rule], "d").first()) == ("d", "readable_d", "warn", 2, 1, 0)


def test_metrics_of_a_silver_write(spark):
    seen = Observation("clicks")
    raw = clicks(spark, {"event_id": None}, {"event_id": "e3", "action_type": "hover"})
    silver.silver_clicks(raw, metrics=seen).collect()
    assert seen.get == {"rows": 2, "valid_event_id": 1, "valid_campaign_id": 0, "valid_action_type": 1}


def test_json_safe(spark):
    df = spark.sql(
        "SELECT 1 AS i, true AS b, 1.50 AS d, date'2024-01-02' AS day, timestamp'2024-01-02 03:04:05' AS t,"
        " timestamp_ntz'2024-01-02 03:04:05.000001' AS u, 'x' AS s, cast(NULL AS int) AS n"
    )
    row = C.json_safe(df).first().asDict()
    assert row == {
        "i": 1.0, "b": 1.0, "d": 1.5, "day": "2024-01-02", "t": "2024-01-02T03:04:05",
        "u": "2024-01-02T03:04:05.000001", "s": "x", "n": None,
    }


def test_read_what_was_written(spark):
    folder = work_dir(spark, "bronze")
    raw = clicks(spark, {}, {"event_id": "e2"})
    sinks.materialize(raw, folder)
    assert sinks.materialize(raw, folder, "append").count() == 4
    assert readers.read_clicks(spark, folder).count() == 4
    assert readers.read_clicks(spark, folder, streaming=True).isStreaming
    assert sinks.materialize(sinks.compact(raw, target_files=1), folder).count() == 2
    assert len(spark.read.parquet(folder).inputFiles()) == 1


def test_catalog_table_with_comment_and_properties(spark):
    raw = clicks(spark, {})
    spark.sql("CREATE DATABASE IF NOT EXISTS demo LOCATION '{}'".format(work_dir(spark, "demo")))
    stored = sinks.materialize(raw, "demo.clicks", catalog=True, comment="Bob's \\ clicks", properties={"quality": "bronze"})
    assert stored.count() == 1
    assert readers.read_clicks(spark, "demo.clicks", fmt="table").count() == 1
    about = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED demo.clicks").collect()}
    assert about["Comment"] == "Bob's \\ clicks" and "quality=bronze" in about["Table Properties"]
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE demo.clicks").collect()}
    assert comments["event_id"] == "Unique id of the interaction"
    spark.sql("DROP TABLE demo.clicks")


def test_comment_needs_a_table(spark):
    with pytest.raises(ValueError):
        sinks.materialize(spark.range(1), work_dir(spark, "x"), comment="no")


def test_missing_column_helper_leaves_present_ones(spark):
    df = spark.range(1).withColumn("a", F.lit("x"))
    assert C.ensure_columns(df, {"a": "int", "b": "int"}).dtypes == [("id", "bigint"), ("a", "string"), ("b", "int")]
