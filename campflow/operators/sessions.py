"""Sessions from interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SESSION_ATTRIBUTES = ("customer_id", "device_id", "device_os", "app_version", "geo_region", "geo_city")


def _counts() -> list[Column]:
    # ISO strings of one format sort like the times they name, so min and max need no parsing
    return [
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).cast("int").alias("total_events"),
        F.count_if(F.col("action_type") == "click").cast("int").alias("total_clicks"),
    ]


def _build(events: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    attributes = [c for c in SESSION_ATTRIBUTES if c in events.columns]
    first = F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(arrival)], *attributes)).alias("_first")
    built = events.groupBy(*keys).agg(first, *_counts())
    return built.select(
        *keys,
        *[F.col("_first")[c].alias(c) for c in attributes],
        "session_start", "session_end", "total_events", "total_clicks",
    )


def sessions_from_events(events: DataFrame, arrival: Sequence[str] = ("event_timestamp", "event_id")) -> DataFrame:
    """One row per session: attributes of its first event by ``arrival``, time span, events and clicks.

    A single aggregation with partial results per task, so one session may hold any share of the events.
    """
    return _build(events, ["session_id"], arrival)


def with_flush_number(events: DataFrame, sequence: str, every: int = 3000) -> DataFrame:
    """Number the flush each event falls in, from its place in the ingest sequence (0-based, numeric)."""
    return events.withColumn("flush_number", F.floor(F.col(sequence) / every).cast("bigint"))


def session_fragments(
    events: DataFrame, flush: str = "flush_number", arrival: Sequence[str] = ("event_timestamp", "event_id")
) -> DataFrame:
    """One row per session and flush, counted from zero in each flush."""
    return _build(events, ["session_id", flush], arrival)


def merge_session_fragments(fragments: DataFrame, flush: str = "flush_number") -> DataFrame:
    """Whole sessions from their fragments: earliest start, latest end, summed counters, first attributes."""
    attributes = [c for c in SESSION_ATTRIBUTES if c in fragments.columns]
    merged = fragments.groupBy("session_id").agg(
        F.min(F.struct(flush, *attributes)).alias("_first"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("total_events").cast("int").alias("total_events"),
        F.sum("total_clicks").cast("int").alias("total_clicks"),
    )
    return merged.select(
        "session_id",
        *[F.col("_first")[c].alias(c) for c in attributes],
        "session_start", "session_end", "total_events", "total_clicks",
    )
