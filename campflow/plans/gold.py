"""Campaign performance tables.

Every table is a set of group keys, sums, and ratios of those sums. The sums can be taken straight from the
cleaned interactions (batch or stream), or from activity cells: one pass over the interactions that holds the sums
of every table, from which all eight follow without touching the interactions again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.functions import measures as M

_PERIOD = {
    "impressions": "impressions",
    "clicks": "clicks",
    "conversions": "conversions",
    "total_events": "events",
    "ctr": M.percent("clicks", "impressions"),
}
_TOTAL = {
    "total_impressions": "impressions",
    "total_clicks": "clicks",
    "total_conversions": "conversions",
    "total_dismisses": "dismisses",
    "total_deep_links": "deep_links",
    "total_conversion_value": "conversion_value",
    "sum_response_time_ms": "response_time_ms",
    "total_events": "events",
    "avg_response_time_ms": M.mean_over_rows("response_time_ms", "events"),
    "ctr": M.percent("clicks", "impressions"),
    "conversion_rate": M.percent("conversions", "clicks"),
    "cost_per_click": M.cost_per("budget_brl", "clicks"),
}
_LATENCY = (
    "total_impressions", "total_clicks", "sum_response_time_ms", "total_events", "avg_response_time_ms", "ctr",
)


@dataclass(frozen=True)
class GoldTable:
    """Group keys, key columns of the published replica, and output columns of one table."""

    group: tuple[str, ...]
    primary_key: tuple[str, ...]
    outputs: tuple[str, ...]
    comment: str


_HOUR = ("campaign_id", "event_date", "hour_of_day")

TABLES = {
    "gold_campaign_performance": GoldTable(
        ("campaign_id",),
        ("campaign_id",),
        (
            "total_impressions", "total_clicks", "total_conversions", "total_dismisses", "total_deep_links", "ctr",
            "conversion_rate", "total_conversion_value", "avg_response_time_ms", "cost_per_click", "total_events",
        ),
        "Performance per campaign",
    ),
    "gold_campaign_hourly_metrics": GoldTable(
        ("campaign_id", "campaign_name", "event_date", "hour_of_day"), _HOUR, tuple(_PERIOD),
        "Hourly series per campaign",
    ),
    "gold_campaign_minute_metrics": GoldTable(
        ("campaign_id", "campaign_name", "event_date", "hour_of_day", "minute_of_hour"),
        (*_HOUR, "minute_of_hour"), tuple(_PERIOD),
        "Series per minute and campaign",
    ),
    "gold_channel_performance": GoldTable(
        ("campaign_channel",), ("campaign_channel",), _LATENCY, "Performance per channel"
    ),
    "gold_segment_analysis": GoldTable(
        ("target_segment",), ("target_segment",), _LATENCY, "Performance per customer segment"
    ),
    "gold_geo_performance": GoldTable(
        ("geo_region", "geo_city"), ("geo_region", "geo_city"),
        ("total_events", "total_clicks", "total_impressions", "ctr"), "Performance per region and city",
    ),
    "gold_ab_test_results": GoldTable(
        ("ab_test_group",), ("ab_test_group",), _LATENCY, "Performance per experiment group"
    ),
    "gold_daily_kpis": GoldTable(
        ("event_date",),
        ("event_date",),
        (
            "total_impressions", "total_clicks", "total_conversions", "total_dismisses", "total_conversion_value",
            "sum_response_time_ms", "total_events", "avg_response_time_ms", "ctr", "conversion_rate",
        ),
        "Daily key figures over all campaigns",
    ),
}
PRIMARY_KEYS = {name: table.primary_key for name, table in TABLES.items()}
#: The tables that need campaign metadata besides the interactions.
WITH_CAMPAIGNS = ("gold_campaign_performance", "gold_segment_analysis")

_CAMPAIGN_ATTRIBUTES = (
    "campaign_name", "campaign_category", "campaign_channel", "target_segment", "budget_brl", "is_active",
    "is_expired",
)


def _finish(summed: DataFrame, name: str, keys: tuple[str, ...] | None = None) -> DataFrame:
    table = TABLES[name]
    known = _PERIOD if table.outputs == tuple(_PERIOD) else _TOTAL
    return summed.selectExpr(*(keys or table.group), *[f"{known[c]} AS {c}" for c in table.outputs])


def finish_sums(sums: DataFrame, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A table without metadata from rows that hold its sums, and the columns ``extra`` as they are. Row by row, so it
    works on stored sums, on their images and on streams of them."""
    return _finish(sums, name, (*TABLES[name].group, *extra))


def _simple(source: DataFrame, name: str) -> DataFrame:
    return _finish(M.totals(source, *TABLES[name].group), name)


def campaign_sums(source: DataFrame) -> DataFrame:
    """All sums per campaign, of which both tables with metadata are made."""
    return M.totals(source, "campaign_id")


def campaign_performance(source: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Totals per campaign with its attributes; campaigns without metadata have NULL attributes.

    Sums first, so the join sees one row per campaign whatever the event volume.
    """
    summed = M.totals(source, "campaign_id")
    joined = summed.join(campaigns.select("campaign_id", *_CAMPAIGN_ATTRIBUTES), "campaign_id", "left")
    return _finish(joined, "gold_campaign_performance", ("campaign_id", *_CAMPAIGN_ATTRIBUTES))


def campaign_hourly_metrics(source: DataFrame) -> DataFrame:
    """Counts and click-through per campaign and hour. Any lateness is accepted."""
    return _simple(source, "gold_campaign_hourly_metrics")


def campaign_minute_metrics(source: DataFrame) -> DataFrame:
    """Counts and click-through per campaign and minute."""
    if "minute_of_hour" not in source.columns:
        source = source.withColumn("minute_of_hour", F.minute("event_timestamp"))
    return _simple(source, "gold_campaign_minute_metrics")


def channel_performance(source: DataFrame) -> DataFrame:
    """Totals per channel, as recorded on the events."""
    return _simple(source, "gold_channel_performance")


def segment_analysis(source: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Totals per target segment; events of campaigns without metadata form the NULL segment.

    In a batch the events are summed per campaign before the join, so a campaign with a large share of the events
    is one row by then; repeated metadata rows multiply the sums exactly as they would multiply the events. A
    stream in update mode allows one aggregation only, so there the join comes first.
    """
    segments = campaigns.select("campaign_id", "target_segment")
    summed = source if source.isStreaming else M.totals(source, "campaign_id")
    return _simple(summed.join(segments, "campaign_id", "left"), "gold_segment_analysis")


def geo_performance(source: DataFrame) -> DataFrame:
    """Totals per region and city."""
    return _simple(source, "gold_geo_performance")


def ab_test_results(source: DataFrame) -> DataFrame:
    """Totals per experiment group."""
    return _simple(source, "gold_ab_test_results")


def daily_kpis(source: DataFrame) -> DataFrame:
    """Totals per day, by date. Streams only sort in complete mode, so a stream is left unordered."""
    days = _simple(source, "gold_daily_kpis")
    return days if source.isStreaming else days.orderBy("event_date")


def build(name: str, source: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """One gold table by name; ``campaigns`` is needed for campaign performance and segments only."""
    if name == "gold_campaign_performance":
        return campaign_performance(source, campaigns)
    if name == "gold_segment_analysis":
        return segment_analysis(source, campaigns)
    return {
        "gold_campaign_hourly_metrics": campaign_hourly_metrics,
        "gold_campaign_minute_metrics": campaign_minute_metrics,
        "gold_channel_performance": channel_performance,
        "gold_geo_performance": geo_performance,
        "gold_ab_test_results": ab_test_results,
        "gold_daily_kpis": daily_kpis,
    }[name](source)


_CELL_SETS = {
    "campaign_minute": (
        "campaign_id", "campaign_name", "campaign_channel", "event_date", "hour_of_day", "minute_of_hour",
    ),
    "geo": ("geo_region", "geo_city"),
    "ab_test": ("ab_test_group",),
}
_CELL_SET_OF = {"gold_geo_performance": "geo", "gold_ab_test_results": "ab_test"}


def activity_cells(clicks: DataFrame) -> DataFrame:
    """All sums that the gold tables need, from one pass and one shuffle over the interactions.

    Three grouping sets: campaign by minute (the finest table there is, and the source of six of them), place, and
    experiment group. Column ``cell_set`` tells them apart. A full cube would have the product of their sizes.
    """
    minutes = clicks.withColumn("minute_of_hour", F.minute("event_timestamp"))
    keys = [k for keys in _CELL_SETS.values() for k in keys]
    # grouping_id has a 1 bit for each key that a set leaves out, first key first
    ids = {
        name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)
        for name, own in _CELL_SETS.items()
    }
    names = " ".join(f"WHEN {number} THEN '{name}'" for name, number in ids.items())
    grouped = minutes.groupingSets([[F.col(k) for k in own] for own in _CELL_SETS.values()], *[F.col(k) for k in keys])
    cells = grouped.agg(F.grouping_id().alias("_set"), *M.sums_of_events())
    return cells.selectExpr(f"CASE _set {names} END AS cell_set", *keys, *M.EVENT_SUMS)


_MINUTE_KEYS = _CELL_SETS["campaign_minute"]


def minute_cells(clicks: DataFrame) -> DataFrame:
    """The sums per campaign, name, channel and minute: the finest table there is. Not expanded for other sets."""
    return M.totals(clicks.withColumn("minute_of_hour", F.minute("event_timestamp")), *_MINUTE_KEYS)


def hour_cells(minutes: DataFrame) -> DataFrame:
    """The same per hour, from the minute cells: what the tables per campaign, channel, segment and day come from."""
    return M.totals(minutes, *_MINUTE_KEYS[:-1])


def side_cells(clicks: DataFrame) -> DataFrame:
    """The sums per place and per experiment group, in one pass. Both have few groups, so each task sends few rows."""
    keys = [*_CELL_SETS["geo"], *_CELL_SETS["ab_test"]]
    sets = [[F.col(k) for k in _CELL_SETS[name]] for name in ("geo", "ab_test")]
    grouped = clicks.groupingSets(sets, *[F.col(k) for k in keys])
    cells = grouped.agg(F.grouping("ab_test_group").alias("_set"), *M.sums_of_events())
    return cells.selectExpr("if(_set = 1, 'geo', 'ab_test') AS cell_set", *keys, *M.EVENT_SUMS)


def build_from_cascade(
    name: str, minutes: DataFrame, hours: DataFrame, sides: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """One gold table by name, from the smallest stored cells that hold it."""
    if name in _CELL_SET_OF:
        return build(name, sides.filter(F.col("cell_set") == _CELL_SET_OF[name]))
    return build(name, minutes if name == "gold_campaign_minute_metrics" else hours, campaigns)

