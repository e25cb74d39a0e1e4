"""Data work that the dashboard does on the answers of :mod:`campflow.plans.serving`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campflow.operators.topk import top_k, with_rank
from campflow.plans.serving import compare_campaigns, compare_hours

_LAST = {"hour": 48, "minute": 60}


def _clock(hour: str, minute: Column) -> Column:
    return F.concat(F.lpad(F.col(hour).cast("string"), 2, "0"), F.lit(":"), minute)


def trend_series(series: DataFrame, granularity: str = "hour") -> DataFrame:
    """The last 48 hours (60 minutes) of a series in ascending order, labelled for the axis and the tooltip."""
    by_minute = granularity == "minute"
    order = ["event_date", "hour_of_day"] + (["minute_of_hour"] if by_minute else [])
    minute = F.lpad(F.col("minute_of_hour").cast("string"), 2, "0") if by_minute else F.lit("00")
    last = top_k(series, [f"-{c}" for c in order], _LAST["minute" if by_minute else "hour"])
    label = _clock("hour_of_day", minute)
    full = F.concat(F.date_format("event_date", "yyyy-MM-dd"), F.lit(" "), label)
    return top_k(last.withColumns({"label": label, "full_label": full}), order)


def cross_filter(perf: DataFrame, channel: str | None = None, segment: str | None = None) -> DataFrame:
    """Campaigns of one channel and / or one segment; no restriction where none is given."""
    if channel:
        perf = perf.filter(F.col("campaign_channel") == channel)
    if segment:
        perf = perf.filter(F.col("target_segment") == segment)
    return perf


def cross_filter_top(
    perf: DataFrame, channel: str | None = None, segment: str | None = None, n: int = 12
) -> DataFrame:
    """The ``n`` best click-through rates among the cross-filtered campaigns."""
    return top_k(cross_filter(perf, channel, segment), ["-ctr"], n, ["campaign_id"])


_METRICS = (
    "total_impressions", "total_clicks", "ctr", "total_conversions", "conversion_rate", "total_conversion_value",
    "cost_per_click",
)


def _metric_rows(df: DataFrame, metrics: tuple[str, ...], *keep: str) -> DataFrame:
    """One row per metric, in the given order."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for i, m in enumerate(metrics, 1)
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def compare_metrics(perf: DataFrame, id1: str, id2: str) -> DataFrame:
    """Seven metric rows of two campaigns side by side, with the sign of their difference (unknown counts as 0).

    Empty unless both campaigns are known.
    """
    rows = _metric_rows(compare_campaigns(perf, id1, id2), _METRICS, "side")
    paired = rows.groupBy("position", "metric").agg(
        F.max(F.when(F.col("side") == 1, F.col("value"))).alias("value1"),
        F.max(F.when(F.col("side") == 2, F.col("value"))).alias("value2"),
        F.count_distinct("side").alias("_sides"),
    )
    zero = F.lit(0.0)
    sign = F.signum(F.coalesce("value1", zero) - F.coalesce("value2", zero)).alias("trend")
    return top_k(paired.filter(F.col("_sides") == 2), ["position"]).select(
        "position", "metric", "value1", "value2", sign
    )


def compare_hourly(hourly_metrics: DataFrame, id1: str, id2: str, n: int = 48) -> DataFrame:
    """Clicks per hour of two campaigns on one axis, 0 where one of them has no row.

    Both series come from one scan, so grouping by hour stands in for a full outer join of two.
    """
    hours = compare_hours(hourly_metrics, id1, id2, n).groupBy("event_date", "hour_of_day")
    merged = hours.agg(
        *[F.sum(F.when(F.col("side") == i, F.col("clicks")).otherwise(0)).alias(f"clicks{i}") for i in (1, 2)]
    )
    day = F.date_format("event_date", "yyyy-MM-dd")
    label = F.concat(day, F.lit(" "), _clock("hour_of_day", F.lit("00"))).alias("label")
    return top_k(merged.select(label, "clicks1", "clicks2"), ["label"])


def share_of_max(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """``column`` as a percentage of its largest value (at least 1). The maximum is a scalar subquery."""
    largest = df.agg(F.greatest(F.coalesce(F.max(column), F.lit(1)), F.lit(1))).scalar()
    return df.withColumn(name, F.col(column) / largest * 100)


def share_of_total(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """``column`` as a percentage of its sum, 0 when the sum is 0. The sum is a scalar subquery."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(name, F.coalesce(F.try_divide(F.col(column), total) * 100, F.lit(0.0)))


def geo_labels(geo: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` places with most clicks, labelled ``city (region)``."""
    top = top_k(geo, ["-total_clicks"], n, ["geo_region", "geo_city"])
    return top.withColumn("label", F.concat(F.col("geo_city"), F.lit(" ("), F.col("geo_region"), F.lit(")")))


def overall_conversion_rate(summary: DataFrame) -> DataFrame:
    """Conversions per hundred clicks over everything; NULL while there are no clicks."""
    clicks, conversions = F.col("total_clicks"), F.col("total_conversions")
    rate = F.when(clicks > 0, conversions / clicks * 100).alias("overall_conversion_rate")
    return summary.select("total_clicks", "total_conversions", rate)


_CARDS = ("total_impressions", "total_clicks", "ctr", "total_conversions")


def kpi_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Key figures that differ from the previous refresh and were not 0 then."""
    both = _metric_rows(previous, _CARDS).withColumn("_now", F.lit(False)).unionByName(
        _metric_rows(current, _CARDS).withColumn("_now", F.lit(True))
    )
    paired = both.groupBy("metric").agg(
        F.max(F.when(~F.col("_now"), F.col("value"))).alias("previous"),
        F.max(F.when(F.col("_now"), F.col("value"))).alias("current"),
    )
    return paired.filter((F.col("previous") != 0) & (F.col("previous") != F.col("current")))


def hour_rank(hour_top: DataFrame) -> DataFrame:
    """The list of an hour's campaigns with their rank: the whole list, which is as long as its limit."""
    return with_rank(hour_top, ["-clicks"], None, ["campaign_id", "campaign_name"])
