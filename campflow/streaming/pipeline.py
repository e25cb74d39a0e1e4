"""Continuous pipeline: raw interactions to silver files to replicas of the gold tables.

Silver is written once and read by every gold query, so the ids of the deduplication are kept in one place and the
gold queries hold their sums only. With ``forget_after`` the ids are bounded as well. Campaign metadata is never part
of a stream's state: the streams sum per campaign, and metadata is joined from a fresh read of its table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from campflow.functions import measures as M
from campflow.operators.dedup import SPREAD
from campflow.plans import gold
from campflow.plans.answers import Dashboard
from campflow.plans.silver import silver_clicks, silver_sessions
from campflow.streaming.replica import read_gold, read_replica, stream_upsert
from campflow.streaming.run import finish, start


def gold_stream(name: str, clicks: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """A gold table over streaming silver clicks, for update or complete mode.

    ``campaigns`` stays as it is when the query starts; :func:`start_sums` and :func:`read_sums` follow its changes.
    """
    if not clicks.isStreaming:
        raise ValueError("clicks must be a stream")
    return gold.build(name, clicks, campaigns)


def hourly_windows(clicks: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Hourly metrics in append mode: an hour is emitted once, when ``lateness`` has passed since its end.

    The state is bounded. In return, events without a time have no hour here, and events that arrive later than
    ``lateness`` are not counted; :func:`campflow.streaming.late.bounded_dedup` keeps both apart, so that none is
    lost.
    """
    hours = (
        clicks.withWatermark("event_timestamp", lateness)
        .groupBy(F.window("event_timestamp", "1 hour").alias("_hour"), "campaign_id", "campaign_name")
        .agg(*M.sums_of_events())
        .withColumns({"event_date": F.to_date("_hour.start"), "hour_of_day": F.hour("_hour.start")})
    )
    return hours.selectExpr(
        "campaign_id", "campaign_name", "event_date", "hour_of_day", "impressions", "clicks", "conversions",
        "events AS total_events", f"{M.percent('clicks', 'impressions')} AS ctr",
    )


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment below ``root``; a new ``run`` starts all state and output afresh."""

    root: str
    run: str

    @classmethod
    def new(cls, root: str) -> Layout:
        return cls(root, uuid.uuid4().hex)

    def data(self, name: str) -> str:
        return f"{self.root}/{self.run}/data/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/{self.run}/checkpoint/{name}"


def start_silver(
    bronze: DataFrame, layout: Layout, trigger: str | None = None, forget_after: str | None = None, spread: int = SPREAD
) -> StreamingQuery:
    """Clean the raw interactions into files that the gold queries follow."""
    clean = silver_clicks(bronze, metrics="silver_clicks", forget_after=forget_after, spread=spread)
    return start(clean, layout.data("silver_clicks"), layout.checkpoint("silver_clicks"), trigger=trigger)


def start_sessions(
    bronze: DataFrame, layout: Layout, trigger: str | None = None, forget_after: str | None = None, spread: int = SPREAD
) -> StreamingQuery:
    """Clean the raw sessions into files."""
    clean = silver_sessions(bronze, metrics="silver_sessions", forget_after=forget_after, spread=spread)
    return start(clean, layout.data("silver_sessions"), layout.checkpoint("silver_sessions"), trigger=trigger)


Campaigns = DataFrame | Callable[[], DataFrame]


def _fresh(campaigns: Campaigns) -> DataFrame:
    return campaigns() if callable(campaigns) else campaigns


def start_sums(
    name: str, clicks: DataFrame, path: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Keep the replica of one gold table's stream up to date: the table itself, or sums per campaign for the tables
    that need metadata."""
    source = gold.campaign_sums(clicks) if name in gold.WITH_CAMPAIGNS else gold_stream(name, clicks, None)
    keys = ("campaign_id",) if name in gold.WITH_CAMPAIGNS else gold.TABLES[name].group
    return stream_upsert(source, path, keys, checkpoint, trigger)


def read_sums(
    spark: SparkSession, name: str, path: str, clicks: DataFrame, campaigns: Campaigns
) -> DataFrame:
    """The current rows of one gold table from the replica that :func:`start_sums` keeps.

    ``campaigns`` is the metadata, or a function that reads it: it is asked now, so campaigns that were added or
    changed while the stream runs show at once, also those that have no new events.
    """
    if name in gold.WITH_CAMPAIGNS:
        sums = read_replica(spark, path, ("campaign_id",), gold.campaign_sums(clicks).schema)
        return gold.build(name, sums, _fresh(campaigns))
    return read_gold(spark, path, name, gold.build(name, clicks).schema)


def start_gold(
    spark: SparkSession, name: str, silver: DataFrame, layout: Layout, trigger: str | None = None
) -> StreamingQuery:
    """Keep the replica of one gold table up to date from the silver files. ``silver`` gives their schema."""
    clicks = spark.readStream.schema(silver.schema).parquet(layout.data("silver_clicks"))
    return start_sums(name, clicks, layout.data(name), layout.checkpoint(name), trigger)


def gold_table(spark: SparkSession, name: str, silver: DataFrame, campaigns: Campaigns, layout: Layout) -> DataFrame:
    """The current rows of one gold table of a running deployment."""
    return read_sums(spark, name, layout.data(name), silver, campaigns)


def start_daily(
    spark: SparkSession, silver: DataFrame, sink: Callable[[DataFrame, int], None], layout: Layout,
    trigger: str | None = None,
) -> StreamingQuery:
    """The daily table by date, whole at every trigger (complete mode), for a ``sink`` of micro-batch and batch id.

    Complete mode is for tables with few rows: it hands on all days each time.
    """
    clicks = spark.readStream.schema(silver.schema).parquet(layout.data("silver_clicks"))
    days = gold.daily_kpis(clicks).orderBy("event_date")
    return start(days, sink, layout.checkpoint("daily_complete"), mode="complete", trigger=trigger)


def live_dashboard(spark: SparkSession, silver: DataFrame, campaigns: Campaigns, layout: Layout) -> Dashboard:
    """The dashboard's questions over the current rows of the replicas of a deployment. The hourly and minute replicas are
    stored by day, so trends read the newest days only."""
    return Dashboard({name: gold_table(spark, name, silver, campaigns, layout) for name in gold.TABLES}, by_day=True)


def refresh(
    spark: SparkSession,
    bronze: DataFrame,
    campaigns: Campaigns,
    root: str,
    forget_after: str | None = None,
    spread: int = SPREAD,
    sessions: DataFrame | None = None,
) -> tuple[Layout, dict[str, DataFrame]]:
    """Full refresh: recompute every table from all raw interactions, under new folders and new checkpoints.

    Returns the layout to carry on with and the current rows of each table; ``sessions``, a stream of raw sessions,
    adds the cleaned sessions. Earlier runs are left in place until the readers have moved on.
    """
    layout = Layout.new(root)
    clean = silver_clicks(bronze)
    finish(start_silver(bronze, layout, forget_after=forget_after, spread=spread))
    queries = [start_gold(spark, name, clean, layout) for name in gold.TABLES]
    if sessions is not None:
        queries.append(start_sessions(sessions, layout, forget_after=forget_after, spread=spread))
    for query in queries:
        finish(query)
    tables = {name: gold_table(spark, name, clean, campaigns, layout) for name in gold.TABLES}
    if sessions is not None:
        kind = silver_sessions(sessions).schema
        tables["silver_sessions"] = spark.read.schema(kind).parquet(layout.data("silver_sessions"))
    return layout, tables
