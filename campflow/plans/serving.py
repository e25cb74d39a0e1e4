"""What the dashboard asks of the gold tables. Every answer is a DataFrame.

Orders are made total by the key of the table, so that a cut-off always falls in the same place.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campflow.functions.measures import exact_ratio
from campflow.operators.topk import top_k, top_k_per

_HOURLY = (
    "campaign_id", "campaign_name", "event_date", "hour_of_day",
    "impressions", "clicks", "conversions", "ctr", "total_events",
)
_MINUTE = (*_HOURLY[:4], "minute_of_hour", *_HOURLY[4:])
_BY_HOUR = ("-event_date", "hour_of_day")
_BY_MINUTE = ("-event_date", "-hour_of_day", "-minute_of_hour")
_COMPARED = (
    "campaign_id", "campaign_name", "campaign_category", "campaign_channel", "target_segment", "budget_brl",
    "total_impressions", "total_clicks", "total_conversions", "ctr", "conversion_rate", "total_conversion_value",
    "avg_response_time_ms", "cost_per_click", "total_events",
)


def kpis_summary(daily: DataFrame) -> DataFrame:
    """Key figures over all days; one row of zeros when there are none."""
    names = ("total_impressions", "total_clicks", "total_conversions", "total_events", "sum_response_time_ms")
    sums = daily.agg(*[F.expr(f"coalesce(sum({n}), 0L) AS {n}") for n in names])
    return sums.selectExpr(
        "total_impressions",
        "total_clicks",
        f"{exact_ratio('total_clicks', 'total_impressions', 100, 2)} AS ctr",
        "total_conversions",
        "total_events",
        f"{exact_ratio('sum_response_time_ms', 'total_events', 1, 0)} AS avg_response_time_ms",
    )


def kpis_daily(daily: DataFrame, n: int = 30) -> DataFrame:
    """The latest ``n`` days."""
    columns = (
        "event_date", "total_impressions", "total_clicks", "ctr", "total_conversions", "total_events",
        "avg_response_time_ms", "conversion_rate",
    )
    return top_k(daily.select(*columns), ["-event_date"], n)


def _latency_view(table: DataFrame, key: str, order: list[str]) -> DataFrame:
    columns = (key, "total_impressions", "total_clicks", "ctr", "avg_response_time_ms", "total_events")
    return top_k(table.select(*columns), order, tie_break=[key])


def channels(channel_performance: DataFrame) -> DataFrame:
    """Channels, most clicks first."""
    return _latency_view(channel_performance, "campaign_channel", ["-total_clicks"])


def segments(segment_analysis: DataFrame) -> DataFrame:
    """Segments, most clicks first."""
    return _latency_view(segment_analysis, "target_segment", ["-total_clicks"])


def ab_test(ab_test_results: DataFrame) -> DataFrame:
    """Experiment groups by name."""
    return _latency_view(ab_test_results, "ab_test_group", [])


def geo(geo_performance: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` places with most clicks."""
    columns = ("geo_region", "geo_city", "total_events", "total_clicks", "total_impressions", "ctr")
    return top_k(geo_performance.select(*columns), ["-total_clicks"], n, ["geo_region", "geo_city"])


def campaigns_performance(perf: DataFrame) -> DataFrame:
    """All campaigns, best click-through first."""
    columns = (*_COMPARED[:6], "is_active", *_COMPARED[6:])
    return top_k(perf.select(*columns), ["-ctr"], tie_break=["campaign_id"])


def _over_campaigns(series: DataFrame, *keys: str) -> DataFrame:
    sums = series.groupBy(*keys).agg(
        *[F.expr(f"sum({c}) AS {c}") for c in ("impressions", "clicks", "conversions", "total_events")]
    )
    ctr = f"{exact_ratio('clicks', 'impressions', 100, 2)} AS ctr"
    return sums.selectExpr(*keys, "impressions", "clicks", "conversions", ctr, "total_events")


def newest_days(series: DataFrame, n: int) -> DataFrame:
    """The rows of the newest ``n`` days, those without a day among them.

    Every day has a row at least, so the newest ``n`` rows lie in the newest ``n`` days. The bound is a scalar
    subquery, which prunes the folders of a table that is stored by day.
    """
    days = top_k(series.select("event_date").distinct(), ["-event_date"], n)
    oldest = days.agg(F.min("event_date")).scalar()
    return series.filter((F.col("event_date") >= oldest) | F.col("event_date").isNull())


def hourly(
    hourly_metrics: DataFrame, campaign_id: str | None = None, n: int = 168, by_day: bool = False
) -> DataFrame:
    """``n`` hours of one campaign, or summed over all: latest days first, hours ascending within a day.

    The cut therefore takes the late hours off the oldest day shown. ``by_day`` says that the table is stored by
    ``event_date``: then only the newest days are read.
    """
    if campaign_id:
        hourly_metrics = hourly_metrics.filter(F.col("campaign_id") == campaign_id)
    if by_day:
        hourly_metrics = newest_days(hourly_metrics, n)
    if campaign_id:
        return top_k(hourly_metrics.select(*_HOURLY), _BY_HOUR, n, ["campaign_name"])
    return top_k(_over_campaigns(hourly_metrics, "event_date", "hour_of_day"), _BY_HOUR, n)


def minutely(
    minute_metrics: DataFrame, campaign_id: str | None = None, n: int = 60, by_day: bool = False
) -> DataFrame:
    """The latest ``n`` minutes of one campaign, or summed over all; ``by_day`` as for :func:`hourly`."""
    if campaign_id:
        minute_metrics = minute_metrics.filter(F.col("campaign_id") == campaign_id)
    if by_day:
        minute_metrics = newest_days(minute_metrics, n)
    if campaign_id:
        return top_k(minute_metrics.select(*_MINUTE), _BY_MINUTE, n, ["campaign_name"])
    return top_k(_over_campaigns(minute_metrics, "event_date", "hour_of_day", "minute_of_hour"), _BY_MINUTE, n)


def trend(
    hourly_metrics: DataFrame, minute_metrics: DataFrame, granularity: str = "hour", campaign_id: str | None = None,
    by_day: bool = False,
) -> DataFrame:
    """The minute series for ``"minute"``, the hourly one for anything else."""
    if granularity == "minute":
        return minutely(minute_metrics, campaign_id, by_day=by_day)
    return hourly(hourly_metrics, campaign_id, by_day=by_day)


def search_campaigns(perf: DataFrame, term: str, n: int = 10) -> DataFrame:
    """Campaigns whose name, category or channel contains ``term`` in any case, most clicks first.

    ``%`` and ``_`` in the term are wildcards, unless a backslash stands before them; before any other character a
    backslash means nothing. A blank term finds nothing; blanks around a term count.
    """
    columns = (
        "campaign_id", "campaign_name", "campaign_category", "campaign_channel", "target_segment",
        "total_impressions", "total_clicks", "total_conversions", "ctr", "total_events",
    )
    shown = perf.select(*columns)
    if not term.strip():
        return shown.filter(F.lit(False))
    # Spark refuses an escape that escapes nothing
    plain = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{term}%", flags=re.DOTALL)
    pattern = F.lower(F.lit(plain))
    found = (
        F.like(F.lower("campaign_name"), pattern)
        | F.like(F.lower("campaign_category"), pattern)
        | F.like(F.lower("campaign_channel"), pattern)
    )
    return top_k(shown.filter(found), ["-total_clicks"], n, ["campaign_id"])


def _in_hour(date: dt.date | str, hour: int) -> Column:
    return (F.col("event_date") == F.lit(str(date)).cast("date")) & (F.col("hour_of_day") == hour)


def hour_detail_top(hourly_metrics: DataFrame, date: dt.date | str, hour: int, n: int = 5) -> DataFrame:
    """The ``n`` campaigns with most clicks in one hour."""
    columns = ("campaign_id", "campaign_name", "impressions", "clicks", "conversions", "ctr")
    rows = hourly_metrics.filter(_in_hour(date, hour)).select(*columns)
    return top_k(rows, ["-clicks"], n, ["campaign_id", "campaign_name"])


def hour_detail_channels(
    perf: DataFrame, hourly_metrics: DataFrame, date: dt.date | str, hour: int
) -> DataFrame:
    """Clicks and impressions per channel of the campaigns active in one hour.

    The sums are those campaigns' totals over all time, not of that hour.
    """
    active = hourly_metrics.filter(_in_hour(date, hour)).select("campaign_id")
    by_channel = (
        perf.join(active, "campaign_id", "left_semi")
        .groupBy("campaign_channel")
        .agg(F.sum("total_clicks").alias("clicks"), F.sum("total_impressions").alias("impressions"))
    )
    return top_k(by_channel, ["-clicks"], tie_break=["campaign_channel"])


def hour_channels(hourly_metrics: DataFrame, campaigns: DataFrame, date: dt.date | str, hour: int) -> DataFrame:
    """The same as :func:`hour_detail_channels` from the hourly table and the metadata alone.

    The totals of a campaign and whether it was active in the hour come from one aggregation, so the hours, or the
    events that they are made of, are read once.
    """
    per_campaign = hourly_metrics.groupBy("campaign_id").agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"),
        F.max(F.coalesce(_in_hour(date, hour), F.lit(False))).alias("_active"),
    )
    named = per_campaign.filter("_active").join(campaigns.select("campaign_id", "campaign_channel"), "campaign_id", "left")
    by_channel = named.groupBy("campaign_channel").agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"))
    return top_k(by_channel, ["-clicks"], tie_break=["campaign_channel"])


def _sides(df: DataFrame, id1: str, id2: str) -> DataFrame:
    """Rows of two campaigns tagged 1 and 2 in one scan; a campaign compared with itself gets both tags."""
    own = F.col("campaign_id")
    tags = F.array(F.when(own == id1, 1), F.when(own == id2, 2))
    return df.filter(own.isin(id1, id2)).withColumn("side", F.explode(F.array_compact(tags)))


def compare_campaigns(perf: DataFrame, id1: str, id2: str) -> DataFrame:
    """The two campaigns' totals as rows of ``side`` 1 and 2; an unknown campaign has no row."""
    return _sides(perf.select(*_COMPARED), id1, id2).select("side", *_COMPARED)


def compare_hours(hourly_metrics: DataFrame, id1: str, id2: str, n: int = 48) -> DataFrame:
    """``n`` hours of each of two campaigns as rows of ``side`` 1 and 2, cut as in :func:`hourly`."""
    columns = ("event_date", "hour_of_day", "impressions", "clicks", "conversions", "ctr")
    rows = _sides(hourly_metrics.select("campaign_id", "campaign_name", *columns), id1, id2)
    return top_k_per(rows, ["side"], _BY_HOUR, n, ["campaign_name"]).select("side", *columns)
