"""The dashboard's twelve questions over one set of gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from campflow.functions.columns import json_safe
from campflow.plans import gold, serving


class Dashboard:
    """Answers by question, ready for JSON where the dashboard expects that.

    ``tables`` maps gold table names to DataFrames: stored tables of a batch, or current rows of the replicas.
    """

    def __init__(self, tables: Mapping[str, DataFrame], by_day: bool = False) -> None:
        """``by_day``: the hourly and minute tables are stored by ``event_date``."""
        self._tables, self._by_day = tables, by_day

    @classmethod
    def stored(cls, spark: SparkSession, folder: str) -> Dashboard:
        """Over the tables that the batch pipeline has written below ``folder``."""
        return cls({name: spark.read.parquet(f"{folder}/{name}") for name in gold.TABLES}, by_day=True)

    def _table(self, name: str) -> DataFrame:
        return self._tables[f"gold_{name}"]

    def kpis_summary(self) -> DataFrame:
        return serving.kpis_summary(self._table("daily_kpis"))

    def kpis_daily(self) -> DataFrame:
        return json_safe(serving.kpis_daily(self._table("daily_kpis")))

    def channels(self) -> DataFrame:
        return json_safe(serving.channels(self._table("channel_performance")))

    def segments(self) -> DataFrame:
        return json_safe(serving.segments(self._table("segment_analysis")))

    def ab_test(self) -> DataFrame:
        return json_safe(serving.ab_test(self._table("ab_test_results")))

    def geo(self) -> DataFrame:
        return json_safe(serving.geo(self._table("geo_performance")))

    def campaigns_performance(self) -> DataFrame:
        return json_safe(serving.campaigns_performance(self._table("campaign_performance")))

    def campaigns_hourly(self, campaign_id: str | None = None) -> DataFrame:
        return json_safe(serving.hourly(self._table("campaign_hourly_metrics"), campaign_id, by_day=self._by_day))

    def campaigns_trend(self, granularity: str = "hour", campaign_id: str | None = None) -> DataFrame:
        hours, minutes = self._table("campaign_hourly_metrics"), self._table("campaign_minute_metrics")
        return json_safe(serving.trend(hours, minutes, granularity, campaign_id, self._by_day))

    def campaigns_search(self, q: str = "") -> DataFrame:
        return json_safe(serving.search_campaigns(self._table("campaign_performance"), q))

    def hour_detail(self, date: dt.date | str, hour: int) -> dict[str, DataFrame]:
        """The hour's ``top_campaigns`` and ``channel_breakdown``."""
        perf, hours = self._table("campaign_performance"), self._table("campaign_hourly_metrics")
        return {
            "top_campaigns": json_safe(serving.hour_detail_top(hours, date, hour)),
            "channel_breakdown": json_safe(serving.hour_detail_channels(perf, hours, date, hour)),
        }

    def compare(self, id1: str, id2: str) -> dict[str, DataFrame]:
        """``campaigns`` and ``hours`` of both campaigns, told apart by ``side``."""
        return {
            "campaigns": json_safe(serving.compare_campaigns(self._table("campaign_performance"), id1, id2)),
            "hours": json_safe(serving.compare_hours(self._table("campaign_hourly_metrics"), id1, id2)),
        }
