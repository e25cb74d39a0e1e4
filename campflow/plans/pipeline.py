"""Batch pipeline: raw tables to stored silver and gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from campflow.plans import gold, silver
from campflow.session import sized_shuffles
from campflow.sources.sinks import compact, materialize

# Stored by date, and sorted within files, so that reading a campaign skips most row groups.
_BY_DATE = {
    "gold_campaign_hourly_metrics": ("event_date", "campaign_id", "hour_of_day"),
    "gold_campaign_minute_metrics": ("event_date", "campaign_id", "hour_of_day", "minute_of_hour"),
}


@dataclass
class PipelineResult:
    """The stored datasets by name, and the rule counts of each silver dataset."""

    tables: dict[str, DataFrame]
    quality: dict[str, dict[str, int]] = field(default_factory=dict)


def run_batch(
    clicks: DataFrame,
    campaigns: DataFrame,
    sessions: DataFrame,
    target: str,
    as_of: dt.date | str | None = None,
    catalog: bool = False,
    properties: Mapping[str, str] | None = None,
) -> PipelineResult:
    """Compute every dataset below the folder ``target``, or as tables of the catalog schema ``target``; what is there
    is overwritten. Tables in the catalog carry their comment, the property ``quality`` (silver, gold or cells), and
    ``properties``.

    The interactions are shuffled once by event_id on the way into silver, and once by campaign and minute. Each
    further table comes from the smallest that holds it: minutes, then hours of campaign and channel, then the rest;
    places and experiment groups, which have few groups, from a second narrow pass. Each stage reads what the one
    before has written, so a lost executor costs a task, not the chain.
    """
    with sized_shuffles(clicks, campaigns, sessions):
        return _run(clicks, campaigns, sessions, target, as_of, catalog, properties)


def _run(
    clicks: DataFrame, campaigns: DataFrame, sessions: DataFrame, target: str, as_of: dt.date | str | None, catalog: bool,
    properties: Mapping[str, str] | None,
) -> PipelineResult:
    seen = {name: Observation(name) for name in ("silver_clicks", "silver_campaigns", "silver_sessions")}

    def store(name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        if not catalog:
            return materialize(df, f"{target}/{name}", partition_by=partition_by)
        comment = gold.TABLES[name].comment if name in gold.TABLES else None
        about = {"quality": name.partition("_")[0] if name.startswith(("silver", "gold")) else "cells", **(properties or {})}
        return materialize(df, f"{target}.{name}", partition_by=partition_by, comment=comment, properties=about, catalog=True)

    def store_gold(name: str) -> DataFrame:
        cells = [tables[f"{kind}_cells"] for kind in ("minute", "hour", "side")]
        df = gold.build_from_cascade(name, *cells, tables["silver_campaigns"])
        if name not in _BY_DATE:
            return store(name, df)
        return store(name, compact(df, ["event_date"]).sortWithinPartitions(*_BY_DATE[name]), "event_date")

    # Datasets that do not need each other are written at the same time: most are too small to fill a cluster.
    with ThreadPoolExecutor(len(gold.TABLES)) as pool:
        # a fixed choice among differing copies: a recomputed task must not change what other tasks have seen.
        # Left unpartitioned, so that the files are cut where AQE cut the deduplication's own shuffle.
        cleaned = {
            "silver_clicks": silver.silver_clicks(
                clicks, metrics=seen["silver_clicks"], order_by=["event_timestamp"]
            ),
            "silver_campaigns": silver.silver_campaigns(campaigns, as_of, metrics=seen["silver_campaigns"]),
            "silver_sessions": silver.silver_sessions(
                sessions, metrics=seen["silver_sessions"], order_by=["session_start"]
            ),
        }
        tables = dict(zip(cleaned, pool.map(store, cleaned, cleaned.values())))
        sides = pool.submit(store, "side_cells", gold.side_cells(tables["silver_clicks"]), "cell_set")
        tables["minute_cells"] = store("minute_cells", gold.minute_cells(tables["silver_clicks"]))
        tables["hour_cells"] = store("hour_cells", gold.hour_cells(tables["minute_cells"]))
        tables["side_cells"] = sides.result()
        tables |= dict(zip(gold.TABLES, list(pool.map(store_gold, gold.TABLES))))
    return PipelineResult(tables, {name: observation.get for name, observation in seen.items()})
