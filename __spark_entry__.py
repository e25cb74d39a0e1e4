"""

``queries()`` runs each query on the generic test tables, mapped to raw campaign tables as FIXTURES.md describes.
``oracle_sql()`` states the same results in plain SQL, written independently of the Spark code.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from campflow.functions.columns import json_safe  # noqa: E402
from campflow.operators import changes, sessions  # noqa: E402
from campflow.operators.dedup import dedup  # noqa: E402
from campflow.operators.quality import quality_report, uniqueness_report  # noqa: E402
from campflow.plans import dashboard, gold, pipeline, serving, silver  # noqa: E402
from campflow.session import configure, input_bytes, work_dir  # noqa: E402
from campflow.sources import readers, sinks, synth, testdata  # noqa: E402
from campflow.streaming import live, tidy  # noqa: E402
from campflow.streaming.late import bounded_dedup, read_kept, read_late  # noqa: E402
from campflow.streaming.pipeline import (  # noqa: E402
    Layout, hourly_windows, read_sums, start_daily, start_sessions, start_sums,
)
from campflow.streaming.replica import read_replica, stream_upsert  # noqa: E402
from campflow.streaming.rules import RuleHistory, rule_history, rule_report  # noqa: E402
from campflow.streaming.run import finish, start  # noqa: E402

try:  # the operators for training text can be left out of an installation
    import corpus_pipeline
    from campflow.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "campflow.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-02-15"
CAMPAIGN, SECOND, UNLISTED = "CMP-000000000007", "CMP-000000000012", "CMP-000000000003"
DAY, HOUR = "2024-01-15", 10
BEFORE, AFTER = "2024-01-20 12:30:00", "2024-01-05 00:30:00"
FLUSH_EVERY = 1000  # cuts through sessions of twelve events
SYNTH = {"seed": 7, "base": dt.datetime(2024, 2, 15), "campaigns": 12, "sessions": 50_000}

_GOLD = {name.removeprefix("gold_"): name for name in gold.TABLES}


class _Inputs:
    """The datasets of one test folder, as unevaluated DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = configure(spark), sf_dir

    def clicks(self) -> DataFrame:
        return silver.silver_clicks(testdata.bronze_clicks(self.spark, self.sf_dir))

    def campaigns(self) -> DataFrame:
        return silver.silver_campaigns(testdata.bronze_campaigns(self.spark, self.sf_dir), AS_OF)

    def sessions(self) -> DataFrame:
        return silver.silver_sessions(testdata.bronze_sessions(self.spark, self.sf_dir))

    def gold(self, name: str) -> DataFrame:
        needs_campaigns = name in ("campaign_performance", "segment_analysis")
        return gold.build(f"gold_{name}", self.clicks(), self.campaigns() if needs_campaigns else None)

    def perf(self) -> DataFrame:
        return self.gold("campaign_performance")

    def hourly(self) -> DataFrame:
        return self.gold("campaign_hourly_metrics")

    def minutely(self) -> DataFrame:
        return self.gold("campaign_minute_metrics")

    def daily(self) -> DataFrame:
        return self.gold("daily_kpis")

    def stream_clicks(self) -> DataFrame:
        # as a glob, the path may be one file or a folder of files
        events = testdata.stream_events(self.spark, f"{self.sf_dir}/events.parque[t]")
        return silver.silver_clicks(testdata.bronze_clicks(self.spark, self.sf_dir, events))

    def work_dir(self, purpose: str) -> str:
        return work_dir(self.spark, purpose)

    def raw_events(self) -> DataFrame:
        return dedup(testdata.bronze_clicks(self.spark, self.sf_dir), ["event_id"])

    def fragments(self) -> DataFrame:
        numbered = self.raw_events().withColumn("_sequence", F.expr("bigint(substr(event_id, 5))"))
        flushed = sessions.with_flush_number(numbered, "_sequence", FLUSH_EVERY)
        return sessions.session_fragments(flushed, arrival=["event_id"])

    def synthetic(self) -> DataFrame:
        return synth.clicks_of(testdata.read_events(self.spark, self.sf_dir), "event_id", **SYNTH)

    def two_states(self) -> tuple[DataFrame, DataFrame]:
        """The hourly table before some events had come in, and after some old ones had gone."""
        clicks, time = self.clicks(), F.col("event_timestamp")
        return (
            gold.campaign_hourly_metrics(clicks.filter(time < F.lit(BEFORE).cast("timestamp"))),
            gold.campaign_hourly_metrics(clicks.filter(time >= F.lit(AFTER).cast("timestamp"))),
        )


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking engine has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def _quality(i: _Inputs) -> DataFrame:
    campaigns = testdata.bronze_campaigns(i.spark, i.sf_dir)
    reports = [
        quality_report(testdata.bronze_clicks(i.spark, i.sf_dir), silver.CLICK_RULES + silver.CLICK_PARSING, "clicks"),
        quality_report(campaigns, silver.CAMPAIGN_RULES + silver.CAMPAIGN_PARSING, "campaigns"),
        uniqueness_report(campaigns, ["campaign_id"], "campaigns"),
        quality_report(
            testdata.bronze_sessions(i.spark, i.sf_dir), silver.SESSION_RULES + silver.SESSION_PARSING, "sessions"
        ),
    ]
    return reduce(DataFrame.unionAll, reports)


def _kpi_changes(i: _Inputs) -> DataFrame:
    daily = i.daily()
    earlier = daily.filter(F.col("event_date") < F.lit(DAY).cast("date"))
    return dashboard.kpi_changes(serving.kpis_summary(earlier), serving.kpis_summary(daily))


def _change_feed(i: _Inputs) -> DataFrame:
    before, after = i.two_states()
    return changes.change_feed(before, after, gold.PRIMARY_KEYS["gold_campaign_hourly_metrics"])


def _keyed_upsert(i: _Inputs) -> DataFrame:
    before, _ = i.two_states()
    touched = i.hourly().filter(F.col("event_date") >= F.lit(BEFORE[:10]).cast("date"))
    return changes.upsert(before, touched, gold.PRIMARY_KEYS["gold_campaign_hourly_metrics"])


def _materialized(i: _Inputs) -> DataFrame:
    days = ["event_date"]
    return sinks.materialize(sinks.compact(i.hourly(), days), i.work_dir("hourly"), partition_by=days)


def _full_refresh(i: _Inputs) -> DataFrame:
    spark, sf_dir = i.spark, i.sf_dir
    result = pipeline.run_batch(
        testdata.bronze_clicks(spark, sf_dir),
        testdata.bronze_campaigns(spark, sf_dir),
        testdata.bronze_sessions(spark, sf_dir),
        i.work_dir("refresh"),
        AS_OF,
    )
    counts = [
        result.tables[name].agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_events").alias("total_events"))
        .select(F.lit(name).alias("table_name"), "row_count", "total_events")
        for name in gold.TABLES
    ]
    return reduce(DataFrame.unionAll, counts)


def _stream_gold(name: str) -> Callable[[_Inputs], DataFrame]:
    def run(i: _Inputs) -> DataFrame:
        folder = i.work_dir(name)
        finish(start_sums(name, i.stream_clicks(), f"{folder}/data", f"{folder}/checkpoint"))
        return read_sums(i.spark, name, f"{folder}/data", i.clicks(), i.campaigns)

    return run


def _arriving(i: _Inputs, phases: list[str], run: Callable[[DataFrame, int], None], folder: str) -> None:
    """Calls ``run`` with the stream of raw events once for each of ``phases``, conditions under which they arrive."""
    events = testdata.read_events(i.spark, i.sf_dir)
    for number, condition in enumerate(phases):
        events.filter(condition).write.mode("append").parquet(f"{folder}/raw")
        run(testdata.stream_events(i.spark, f"{folder}/raw"), number)


def _stream_renamed(i: _Inputs) -> DataFrame:
    """Hourly metrics over three micro-batches, between which every campaign gets a new name."""
    folder, name = i.work_dir("renamed"), "gold_campaign_hourly_metrics"
    version = F.expr("bigint(substr(event_id, 5)) % 3")

    def clicks(events: DataFrame) -> DataFrame:
        bronze = testdata.bronze_clicks(i.spark, i.sf_dir, events)
        return silver.silver_clicks(bronze.withColumn("campaign_name", F.concat("campaign_name", F.lit(" v"), version)))

    def run(events: DataFrame, _: int) -> None:
        finish(start_sums(name, clicks(events), f"{folder}/data", f"{folder}/checkpoint"))

    _arriving(i, [f"event_id % 3 = {n}" for n in range(3)], run, folder)
    return read_sums(i.spark, name, f"{folder}/data", i.clicks(), i.campaigns)


def _stream_fresh_metadata(i: _Inputs) -> DataFrame:
    """Campaign performance; half of the metadata comes after the stream has started, and after half of the events."""
    folder, name, all_campaigns = i.work_dir("fresh"), "gold_campaign_performance", i.campaigns()

    def run(events: DataFrame, phase: int) -> None:
        known = all_campaigns.filter("pmod(hash(campaign_id), 2) = 0") if phase == 0 else all_campaigns
        known.write.mode("overwrite").parquet(f"{folder}/campaigns")
        # each event_id comes twice at most, so no task gets many copies of one, and one state of ids is enough
        clicks = silver.silver_clicks(testdata.bronze_clicks(i.spark, i.sf_dir, events), spread=1)
        finish(start_sums(name, clicks, f"{folder}/data", f"{folder}/checkpoint"))

    _arriving(i, ["event_id % 2 = 0", "event_id % 2 = 1"], run, folder)
    metadata = i.spark.read.schema(all_campaigns.schema).parquet(f"{folder}/campaigns")
    return read_sums(i.spark, name, f"{folder}/data", i.clicks(), lambda: metadata)


_THIRDS = [f"event_id % 3 = {n}" for n in range(3)]
_deployments: dict[tuple, str] = {}


def _deployed(i: _Inputs, kind: str, build: Callable[[str], None]) -> str:
    """The folder of tables that several queries ask: built once in a session for each input."""
    key = (i.spark.sparkContext.applicationId, i.sf_dir, kind)
    if key not in _deployments:
        folder = i.work_dir(kind)
        build(folder)
        _deployments[key] = folder
    return _deployments[key]


def _live(i: _Inputs, reset_at: int | None = None) -> str:
    """All tables from one stream of three micro-batches; the folder they are in."""
    return _deployed(i, f"live{reset_at or ''}", lambda folder: _run_live(i, folder, reset_at)) + "/live"


def _run_live(i: _Inputs, folder: str, reset_at: int | None) -> None:
    """With ``reset_at`` the checkpoint is lost before that batch: the query begins again with all that has arrived."""
    events = testdata.read_events(i.spark, i.sf_dir)
    for phase, condition in enumerate(_THIRDS):
        clicks = silver.silver_clicks(testdata.bronze_clicks(i.spark, i.sf_dir, events.filter(condition)))
        clicks.write.mode("append").parquet(f"{folder}/silver")
        stream = i.spark.readStream.schema(clicks.schema).parquet(f"{folder}/silver")
        checkpoint = "second" if reset_at is not None and phase >= reset_at else "first"
        finish(live.start_live(stream, f"{folder}/live", f"{folder}/{checkpoint}"))


def _live_table(name: str, reset_at: int | None = None) -> Callable[[_Inputs], DataFrame]:
    return lambda i: live.live_table(i.spark, _live(i, reset_at), name, i.campaigns)


def _live_feed_applied(i: _Inputs) -> DataFrame:
    """The change feed of the hourly table, followed as a stream and applied to an empty table, version by version."""
    name, folder = "gold_campaign_hourly_metrics", i.work_dir("followed")
    feed = live.live_feed(i.spark, _live(i), name, streaming=True)
    columns, keys = [c for c in feed.columns if c not in ("_change_type", "version")], gold.PRIMARY_KEYS[name]

    def follow(images: DataFrame, _: int) -> None:
        images.write.mode("append").parquet(f"{folder}/images")

    finish(start(feed, follow, f"{folder}/checkpoint"))
    state = i.spark.createDataFrame([], feed.select(*columns).schema)
    images = i.spark.read.parquet(f"{folder}/images")
    for row in images.select("version").distinct().orderBy("version").collect():
        state = changes.apply_feed(state, images.filter(F.col("version") == row.version).drop("version"), keys)
    return state


def _replica_after_reset(i: _Inputs) -> DataFrame:
    """The hourly replica of a query that loses its checkpoint after two of three micro-batches."""
    folder, name = i.work_dir("reset"), "gold_campaign_hourly_metrics"
    keys, kind = gold.TABLES[name].group, None

    def run(events: DataFrame, phase: int) -> None:
        nonlocal kind
        hours = gold.campaign_hourly_metrics(silver.silver_clicks(testdata.bronze_clicks(i.spark, i.sf_dir, events)))
        kind = hours.schema
        finish(stream_upsert(hours, f"{folder}/data", keys, f"{folder}/checkpoint-{phase // 2}"))

    _arriving(i, _THIRDS, run, folder)
    return read_replica(i.spark, f"{folder}/data", keys, kind)


def _refreshed(i: _Inputs) -> str:
    """The tables of two loads by date: what came before a day, and what comes from then on."""
    raw = testdata.bronze_clicks(i.spark, i.sf_dir)

    def load(folder: str) -> None:
        for part in ("<", ">="):
            live.refresh_dates(raw.filter(f"event_timestamp {part} '{BEFORE[:10]}'"), folder)

    return _deployed(i, "dates", load)


def _refreshed_table(name: str) -> Callable[[_Inputs], DataFrame]:
    return lambda i: live.live_table(i.spark, _refreshed(i), name, i.campaigns)


def _compacted(i: _Inputs) -> DataFrame:
    """Cleaned interactions of a raw table that came in eight parts a day, after its closed days were compacted."""
    folder, raw = i.work_dir("appended"), testdata.bronze_clicks(i.spark, i.sf_dir)
    dated = raw.withColumn("day", F.to_date(F.substring("event_timestamp", 1, 10)))
    for part in range(8):
        arrived = dated.filter(F.pmod(F.xxhash64("event_id"), F.lit(8)) == part)
        arrived.write.mode("append").partitionBy("day").parquet(f"{folder}/raw")
    tidy.compact_closed(i.spark, f"{folder}/raw", dated.schema, "day", BEFORE[:10])
    return silver.silver_clicks(i.spark.read.schema(dated.schema).parquet(f"{folder}/raw").drop("day"))


def _catalog_tables(i: _Inputs) -> DataFrame:
    """The gold tables that the batch pipeline has put into a schema of the catalog: comment, property and rows."""
    folder, spark = i.work_dir("catalog"), i.spark
    schema = "campflow_" + folder.rpartition("-")[2]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder}'")
    raw = testdata.bronze_clicks(spark, i.sf_dir), testdata.bronze_campaigns(spark, i.sf_dir), testdata.bronze_sessions(spark, i.sf_dir)
    pipeline.run_batch(*raw, schema, AS_OF, catalog=True, properties={"team": "campaigns"})
    found = []
    for name in gold.TABLES:
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.{name}").collect()}
        kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.{name}").collect()}
        rows = spark.table(f"{schema}.{name}").agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_events").alias("total_events"))
        labels = {"table_name": name, "comment": about["Comment"], "quality": kept["quality"], "team": kept["team"]}
        found.append(rows.select(*[F.lit(text).alias(label) for label, text in labels.items()], "row_count", "total_events"))
    return reduce(DataFrame.unionAll, found)


def _continuous(i: _Inputs) -> DataFrame:
    """The daily table of a stream that runs continuously, with a trigger each second, while files arrive."""
    folder, clicks = i.work_dir("continuous"), i.clicks()
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    clicks.filter(third == 0).write.parquet(f"{folder}/silver")
    stream = i.spark.readStream.schema(clicks.schema).parquet(f"{folder}/silver")
    query = live.start_live(stream, f"{folder}/live", f"{folder}/checkpoint", trigger="1 second")
    try:
        for part in (1, 2):
            query.processAllAvailable()
            clicks.filter(third == part).write.mode("append").parquet(f"{folder}/silver")
        query.processAllAvailable()
    finally:
        query.stop()
    return live.live_table(i.spark, f"{folder}/live", "gold_daily_kpis")


def _stream_sessions_from_events(i: _Inputs) -> DataFrame:
    """Sessions kept up to date by a stream of events, over three micro-batches that cut through them."""
    folder, kind = i.work_dir("built"), None

    def run(events: DataFrame, _: int) -> None:
        nonlocal kind
        raw = dedup(testdata.bronze_clicks(i.spark, i.sf_dir, events), ["event_id"])
        built = sessions.sessions_from_events(raw, arrival=["event_id"])
        kind = built.schema
        finish(stream_upsert(built, f"{folder}/data", ["session_id"], f"{folder}/checkpoint", buckets=4))

    _arriving(i, _THIRDS, run, folder)
    return read_replica(i.spark, f"{folder}/data", ["session_id"], kind, buckets=4)


def _stream_rule_report(i: _Inputs) -> DataFrame:
    """The rule counts of a stream of three micro-batches, as a listener has stored them."""
    folder = i.work_dir("rules")
    history = RuleHistory(i.spark, f"{folder}/history", {"clicks": silver.CLICK_RULES})

    def run(events: DataFrame, _: int) -> None:
        raw = testdata.bronze_clicks(i.spark, i.sf_dir, events)
        query = start(silver.silver_clicks(raw, metrics="clicks"), f"{folder}/data", f"{folder}/checkpoint")
        finish(query)
        history.wait(str(query.runId))

    i.spark.streams.addListener(history)
    try:
        _arriving(i, _THIRDS, run, folder)
    finally:
        i.spark.streams.removeListener(history)
    return rule_report(rule_history(i.spark, f"{folder}/history"))


LATE_DELAY = "7 days"


def _bounded_dedup(i: _Inputs) -> DataFrame:
    """How often each event is kept, late or without a time, if a fifth of them comes after the others."""
    folder = i.work_dir("bounded")
    kind = None

    def run(events: DataFrame, phase: int) -> None:
        nonlocal kind
        timed = events.withColumn("ts", F.when(F.col("event_id") % 97 != 0, F.col("ts")))
        rows = timed.selectExpr("event_id", "timestamp(ts) AS ts", "explode(if(event_id % 50 = 0, array(1, 2), array(1))) AS n")
        rows, kind = rows.select("event_id", "ts"), rows.select("event_id", "ts").schema
        finish(start(rows, bounded_dedup(folder, ["event_id"], "ts", LATE_DELAY), f"{folder}/checkpoint"))

    _arriving(i, ["event_id % 5 != 0", "event_id % 5 = 0 OR event_id % 7 = 0"], run, folder)
    kept = read_kept(i.spark, folder, kind).select("event_id", F.lit("kept").alias("outcome"))
    late = read_late(i.spark, folder, kind).select("event_id", F.col("reason").alias("outcome"))
    return kept.unionAll(late).groupBy("event_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


_FILE_BYTES = 16 << 20  # of events, for each file of raw sessions


def _stream_sessions(i: _Inputs) -> DataFrame:
    folder = i.work_dir("sessions")
    raw = testdata.bronze_sessions(i.spark, i.sf_dir)
    size = input_bytes(testdata.read_events(i.spark, i.sf_dir))
    files = 3 * -(-max(size, 1) // (3 * _FILE_BYTES))  # in three micro-batches
    raw.repartition(files).write.parquet(f"{folder}/raw")
    stream = readers.read_sessions(i.spark, f"{folder}/raw", streaming=True, maxFilesPerTrigger=str(files // 3))
    layout = Layout.new(folder)
    finish(start_sessions(stream, layout))
    kind = silver.silver_sessions(stream).schema
    return i.spark.read.schema(kind).parquet(layout.data("silver_sessions"))


def _stream_daily(i: _Inputs) -> DataFrame:
    """The daily table in complete mode over stored silver files, as many as their size asks for."""
    layout = Layout.new(i.work_dir("daily"))
    sinks.compact(i.clicks()).write.parquet(layout.data("silver_clicks"))
    last = f"{layout.root}/last"
    finish(start_daily(i.spark, i.clicks(), lambda days, _: days.write.mode("overwrite").parquet(last), layout))
    return i.spark.read.parquet(last)


def _from_files(i: _Inputs) -> DataFrame:
    """Cleaned interactions of raw files that arrived in two parts, read with the declared schema."""
    folder = i.work_dir("raw")
    raw = testdata.bronze_clicks(i.spark, i.sf_dir)
    for part in ("<", ">="):
        sinks.materialize(raw.filter(f"event_timestamp {part} '{BEFORE[:10]}'"), folder, "append")
    # the declared schema also has the columns that these files lack; they read as NULL
    return silver.silver_clicks(readers.read_clicks(i.spark, folder)).select(i.clicks().columns)


def _stored_trend(granularity: str) -> Callable[[_Inputs], DataFrame]:
    """A trend over the stored tables, of which only the newest days are read."""

    def run(i: _Inputs) -> DataFrame:
        spark, sf_dir, folder = i.spark, i.sf_dir, i.work_dir("stored")
        raw = testdata.bronze_clicks(spark, sf_dir), testdata.bronze_campaigns(spark, sf_dir), testdata.bronze_sessions(spark, sf_dir)
        tables = pipeline.run_batch(*raw, folder, AS_OF).tables
        hours, minutes = tables["gold_campaign_hourly_metrics"], tables["gold_campaign_minute_metrics"]
        return serving.trend(hours, minutes, granularity, by_day=True)

    return run


def _stored_gold(name: str) -> Callable[[_Inputs], DataFrame]:
    """A table that the batch pipeline has stored."""

    def run(i: _Inputs) -> DataFrame:
        spark, sf_dir, folder = i.spark, i.sf_dir, i.work_dir("stored")
        raw = testdata.bronze_clicks(spark, sf_dir), testdata.bronze_campaigns(spark, sf_dir), testdata.bronze_sessions(spark, sf_dir)
        return pipeline.run_batch(*raw, folder, AS_OF).tables[name]

    return run


def _stream_append(i: _Inputs, df: DataFrame, purpose: str) -> DataFrame:
    folder = i.work_dir(purpose)
    finish(start(df, f"{folder}/data", f"{folder}/checkpoint"))
    return i.spark.read.schema(df.schema).parquet(f"{folder}/data")


def _definitions() -> dict[str, Callable[[_Inputs], DataFrame]]:
    table = {
        # cleaned tables and rules
        "silver_clicks": lambda i: _plain_times(i.clicks()),
        "silver_campaigns": lambda i: i.campaigns(),
        "silver_sessions": lambda i: _plain_times(i.sessions()),
        "quality_report": _quality,
        # one pass for all gold tables
        "activity_cells": lambda i: gold.activity_cells(i.clicks()),
        # dashboard answers
        "kpis_summary": lambda i: serving.kpis_summary(i.daily()),
        "kpis_daily": lambda i: serving.kpis_daily(i.daily()),
        "channels": lambda i: serving.channels(i.gold("channel_performance")),
        "segments": lambda i: serving.segments(i.gold("segment_analysis")),
        "ab_test": lambda i: serving.ab_test(i.gold("ab_test_results")),
        "geo_top": lambda i: serving.geo(i.gold("geo_performance")),
        "campaigns_performance": lambda i: serving.campaigns_performance(i.perf()),
        "hourly_all": lambda i: serving.hourly(i.hourly()),
        "hourly_one": lambda i: serving.hourly(i.hourly(), CAMPAIGN),
        "trend_hour_all": lambda i: serving.trend(i.hourly(), i.minutely(), "hour"),
        "trend_hour_one": lambda i: serving.trend(i.hourly(), i.minutely(), "hour", CAMPAIGN),
        "trend_minute_all": lambda i: serving.trend(i.hourly(), i.minutely(), "minute"),
        "trend_minute_one": lambda i: serving.trend(i.hourly(), i.minutely(), "minute", CAMPAIGN),
        "search": lambda i: serving.search_campaigns(i.perf(), "BANNER"),
        "search_wildcard": lambda i: serving.search_campaigns(i.perf(), "gn 3_"),
        "search_escaped": lambda i: serving.search_campaigns(i.perf(), r"in\_app\_b\anner"),
        "hour_detail_top": lambda i: serving.hour_detail_top(i.hourly(), DAY, HOUR),
        "hour_detail_channels": lambda i: serving.hour_channels(i.hourly(), i.campaigns(), DAY, HOUR),
        "compare_perf": lambda i: serving.compare_campaigns(i.perf(), CAMPAIGN, UNLISTED),
        "compare_hours": lambda i: serving.compare_hours(i.hourly(), CAMPAIGN, UNLISTED),
        "json_safe_campaigns": lambda i: json_safe(serving.campaigns_performance(i.perf())),
        "json_safe_daily": lambda i: json_safe(serving.kpis_daily(i.daily())),
        # work of the dashboard itself
        "trend_series_hour": lambda i: dashboard.trend_series(serving.hourly(i.hourly()), "hour"),
        "trend_series_minute": lambda i: dashboard.trend_series(serving.minutely(i.minutely()), "minute"),
        "cross_filter_top": lambda i: dashboard.cross_filter_top(i.perf(), "push", "varejo"),
        "compare_metrics": lambda i: dashboard.compare_metrics(i.perf(), CAMPAIGN, SECOND),
        "compare_series": lambda i: dashboard.compare_hourly(i.hourly(), CAMPAIGN, SECOND),
        "channel_share": lambda i: dashboard.share_of_max(
            serving.hour_channels(i.hourly(), i.campaigns(), DAY, HOUR), "clicks"
        ),
        "segment_share": lambda i: dashboard.share_of_total(
            serving.segments(i.gold("segment_analysis")), "total_clicks"
        ),
        "geo_labels": lambda i: dashboard.geo_labels(serving.geo(i.gold("geo_performance"))),
        "overall_conversion_rate": lambda i: dashboard.overall_conversion_rate(serving.kpis_summary(i.daily())),
        "kpi_changes": _kpi_changes,
        "hour_rank": lambda i: dashboard.hour_rank(serving.hour_detail_top(i.hourly(), DAY, HOUR)),
        # sessions, changes, storage
        "sessions_from_events": lambda i: testdata.bronze_sessions(i.spark, i.sf_dir),
        "session_fragments": lambda i: i.fragments(),
        "session_fragments_merged": lambda i: sessions.merge_session_fragments(i.fragments()),
        "silver_sessions_of_fragments": lambda i: _plain_times(
            silver.silver_sessions(i.fragments(), order_by=["flush_number"])
        ),
        "change_feed": _change_feed,
        "keyed_upsert": _keyed_upsert,
        "materialized_hourly": _materialized,
        "full_refresh": _full_refresh,
        # streams
        "stream_dedup": lambda i: _plain_times(_stream_append(i, i.stream_clicks(), "silver")),
        "stream_sessions": lambda i: _plain_times(_stream_sessions(i)),
        "stream_daily_complete": _stream_daily,
        "stream_hourly_renamed": _stream_renamed,
        "stream_fresh_metadata": _stream_fresh_metadata,
        "bounded_dedup_outcome": _bounded_dedup,
        "silver_clicks_from_files": lambda i: _plain_times(_from_files(i)),
        "stored_campaign_performance": _stored_gold("gold_campaign_performance"),
        "stored_campaign_hourly_metrics": _stored_gold("gold_campaign_hourly_metrics"),
        "stored_daily_kpis": _stored_gold("gold_daily_kpis"),
        "stored_geo_performance": _stored_gold("gold_geo_performance"),
        "stored_campaign_minute_metrics": _stored_gold("gold_campaign_minute_metrics"),
        "stored_trend_hour": _stored_trend("hour"),
        "stored_trend_minute": _stored_trend("minute"),
        "stream_hourly_watermarked": lambda i: _stream_append(i, hourly_windows(i.stream_clicks()), "windows"),
        # all tables from one stream, by signed sums
        "live_campaign_performance": _live_table("gold_campaign_performance"),
        "live_campaign_minute_metrics": _live_table("gold_campaign_minute_metrics"),
        "live_segment_analysis": _live_table("gold_segment_analysis"),
        "live_geo_performance": _live_table("gold_geo_performance"),
        "live_daily_after_reset": _live_table("gold_daily_kpis", reset_at=2),
        "live_feed_applied": _live_feed_applied,
        "live_kpi_changes": lambda i: live.kpi_changes(i.spark, _live(i)),
        "live_trend_hour": lambda i: serving.trend(
            *[live.live_table(i.spark, _live(i), f"gold_campaign_{grain}_metrics") for grain in ("hourly", "minute")], "hour", by_day=True),
        "replica_after_reset": _replica_after_reset,
        "refreshed_campaign_performance": _refreshed_table("gold_campaign_performance"),
        "refreshed_campaign_hourly_metrics": _refreshed_table("gold_campaign_hourly_metrics"),
        "refreshed_daily_kpis": _refreshed_table("gold_daily_kpis"),
        "stream_rule_report": _stream_rule_report,
        "stream_sessions_from_events": _stream_sessions_from_events,
        "live_continuous_daily": _continuous,
        "catalog_tables": _catalog_tables,
        "compacted_raw": lambda i: _plain_times(_compacted(i)),
        "search_blank": lambda i: serving.search_campaigns(i.perf(), "  "),
        # generated interactions, one for each event
        "synth_clicks": lambda i: i.synthetic(),
        "synth_sessions": lambda i: sessions.sessions_from_events(i.synthetic(), arrival=["event_id"]),
    }
    for short, name in _GOLD.items():
        table[name] = lambda i, short=short: i.gold(short)
        table[f"stream_{short}"] = _stream_gold(name)
    return table


def entry(spark: SparkSession) -> DataFrame:
    """Campaign performance on the smallest test data."""
    return _Inputs(spark, "/root/testdata/sf0.001").perf()


def queries() -> dict[str, Query]:
    def bind(definition: Callable[[_Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: definition(_Inputs(spark, sf_dir))

    own = {name: bind(definition) for name, definition in _definitions().items()}
    return own | (llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})


# --- checking SQL -----------------------------------------------------------------------------------------------

def _padded(number: str, width: int) -> str:
    """Leading zeros up to ``width``; longer numbers stay whole."""
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


_INPUTS = f"""
WITH raw AS (
 SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
 UNION ALL SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events WHERE event_id % 50 = 0),
bronze_clicks AS (
 SELECT concat('EVT-', {_padded('event_id', 16)}) AS event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
  concat('CUST-', {_padded('user_id', 12)}) AS customer_id,
  concat('SESS-', {_padded('event_id // 12', 16)}) AS session_id,
  concat('DEV-', lpad(CAST(user_id * 31 % 100000 AS VARCHAR), 6, '0')) AS device_id,
  CASE WHEN user_id % 20 < 9 THEN 'iOS' ELSE 'Android' END AS device_os,
  concat('8.', CAST(9 + user_id % 4 AS VARCHAR), '.0') AS app_version,
  CASE WHEN k = 98 THEN NULL
       ELSE concat('CMP-', {_padded('(event_id * 7 + user_id) % 45', 12)}) END AS campaign_id,
  concat('Campaign ', CAST((event_id * 7 + user_id) % 45 AS VARCHAR)) AS campaign_name,
  CASE (event_id * 7 + user_id) % 45 % 4 WHEN 0 THEN 'push' WHEN 1 THEN 'in_app_banner'
       WHEN 2 THEN 'in_app_modal' ELSE 'story' END AS campaign_channel,
  CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'conversion'
       WHEN 'error' THEN 'dismiss'
       ELSE CASE WHEN k = 99 THEN 'hover' WHEN k % 2 = 0 THEN 'swipe' ELSE 'deep_link' END END AS action_type,
  r_name AS geo_region, n_name AS geo_city, k < 65 AS is_personalized,
  CASE user_id % 3 WHEN 0 THEN 'control' WHEN 1 THEN 'variant_a' ELSE 'variant_b' END AS ab_test_group,
  CASE WHEN k = 97 THEN NULL ELSE 50 + (k * 7) % 750 END AS response_time_ms,
  CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS conversion_value
 FROM raw JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
bronze_campaigns AS (
 SELECT concat('CMP-', {_padded('p_partkey + 5', 12)}) AS campaign_id,
  concat('Campaign ', CAST(p_partkey + 5 AS VARCHAR)) AS campaign_name, p_type AS campaign_category,
  CASE (p_partkey + 5) % 4 WHEN 0 THEN 'push' WHEN 1 THEN 'in_app_banner' WHEN 2 THEN 'in_app_modal'
       ELSE 'story' END AS campaign_channel,
  CAST(DATE '2024-01-01' - CAST(p_size AS INT) AS VARCHAR) AS campaign_start_date,
  CAST(DATE '2024-02-01' + CAST(p_partkey % 40 AS INT) AS VARCHAR) AS campaign_end_date,
  CASE p_size % 4 WHEN 0 THEN 'varejo' WHEN 1 THEN 'alta_renda' WHEN 2 THEN 'private' ELSE 'pj' END AS target_segment,
  p_retailprice * 100 AS budget_brl, p_partkey % 40 >= 15 AS is_active
 FROM part),
bronze_sessions AS (
 SELECT session_id, min_by(customer_id, event_id) AS customer_id, min_by(device_id, event_id) AS device_id,
  min_by(device_os, event_id) AS device_os, min_by(app_version, event_id) AS app_version,
  min_by(geo_region, event_id) AS geo_region, min_by(geo_city, event_id) AS geo_city,
  min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
  CAST(count(DISTINCT event_id) AS INT) AS total_events,
  CAST(count(DISTINCT CASE WHEN action_type = 'click' THEN event_id END) AS INT) AS total_clicks
 FROM bronze_clicks GROUP BY session_id),
silver_clicks AS (
 SELECT DISTINCT event_id, CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, customer_id, session_id, device_id,
  device_os, app_version, campaign_id, campaign_name, campaign_channel, action_type, geo_region, geo_city,
  is_personalized, ab_test_group, CAST(response_time_ms AS INT) AS response_time_ms,
  CAST(conversion_value AS DECIMAL(15,2)) AS conversion_value,
  CAST(CAST(event_timestamp AS TIMESTAMP) AS DATE) AS event_date,
  CAST(hour(CAST(event_timestamp AS TIMESTAMP)) AS INT) AS hour_of_day,
  CAST(minute(CAST(event_timestamp AS TIMESTAMP)) AS INT) AS minute_of_hour,
  CAST(dayofweek(CAST(event_timestamp AS TIMESTAMP)) + 1 AS INT) AS day_of_week,
  hour(CAST(event_timestamp AS TIMESTAMP)) BETWEEN 9 AND 18
   AND dayofweek(CAST(event_timestamp AS TIMESTAMP)) BETWEEN 1 AND 5 AS is_business_hours
 FROM bronze_clicks WHERE event_id IS NOT NULL AND campaign_id IS NOT NULL),
silver_campaigns AS (
 SELECT campaign_id, campaign_name, campaign_category, campaign_channel,
  CAST(campaign_start_date AS DATE) AS campaign_start_date, CAST(campaign_end_date AS DATE) AS campaign_end_date,
  target_segment, CAST(budget_brl AS DECIMAL(15,2)) AS budget_brl, is_active,
  CAST(campaign_end_date AS DATE) < DATE '2024-02-15' AS is_expired,
  CAST(datediff('day', CAST(campaign_start_date AS DATE), CAST(campaign_end_date AS DATE)) AS INT) AS duration_days
 FROM bronze_campaigns)"""


def _typed_sessions(source: str) -> str:
    return f"""
 SELECT * REPLACE (CAST(session_start AS TIMESTAMP) AS session_start, CAST(session_end AS TIMESTAMP) AS session_end),
  (CAST(floor(epoch(CAST(session_end AS TIMESTAMP))) AS BIGINT)
   - CAST(floor(epoch(CAST(session_start AS TIMESTAMP))) AS BIGINT)) / CAST(60.0 AS DOUBLE) AS session_duration_minutes,
  CASE WHEN total_clicks >= 5 AND session_duration_minutes >= 10 THEN 'high'
       WHEN total_clicks >= 2 AND session_duration_minutes >= 3 THEN 'medium' ELSE 'low' END AS engagement_level
 FROM {source}"""


def _count(action: str) -> str:
    return f"CAST(sum(CASE WHEN action_type = '{action}' THEN 1 ELSE 0 END) AS BIGINT)"


_EVENTS = "CAST(count(*) AS BIGINT)"
_LATENCY_SUM = "CAST(sum(response_time_ms) AS BIGINT)"
_VALUE = "CAST(sum(CASE WHEN action_type = 'conversion' THEN conversion_value END) AS DECIMAL(25,2))"
_AVG = "CASE WHEN total_events > 0 THEN round(sum_response_time_ms / total_events, 2) ELSE 0.0 END"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round({part} / {whole} * 100, 2) ELSE CAST(0 AS DOUBLE) END"


def _exact_pct(part: str, whole: str) -> str:
    """Exact half-up percentage, as a decimal."""
    return (
        f"CAST(CASE WHEN {whole} > 0 THEN ({part} * 20000 + {whole}) // (2 * {whole}) / 100.0 ELSE 0 END"
        " AS DECIMAL(20,2))"
    )


def _latency_table(source: str, key: str) -> str:
    return f"""
 SELECT *, {_AVG} AS avg_response_time_ms, {_pct('total_clicks', 'total_impressions')} AS ctr FROM (
  SELECT {key}, {_count('impression')} AS total_impressions, {_count('click')} AS total_clicks,
   {_LATENCY_SUM} AS sum_response_time_ms, {_EVENTS} AS total_events FROM {source} GROUP BY {key})"""


def _period_table(keys: str, source: str = "silver_clicks") -> str:
    return f"""
 SELECT *, {_pct('clicks', 'impressions')} AS ctr FROM (
  SELECT {keys}, {_count('impression')} AS impressions, {_count('click')} AS clicks,
   {_count('conversion')} AS conversions, {_EVENTS} AS total_events FROM {source} GROUP BY {keys})"""


def _daily_of(source: str) -> str:
    return f"""
 SELECT *, {_AVG} AS avg_response_time_ms, {_pct('total_clicks', 'total_impressions')} AS ctr,
  {_pct('total_conversions', 'total_clicks')} AS conversion_rate FROM (
  SELECT event_date, {_count('impression')} AS total_impressions, {_count('click')} AS total_clicks,
   {_count('conversion')} AS total_conversions, {_count('dismiss')} AS total_dismisses,
   {_VALUE} AS total_conversion_value, {_LATENCY_SUM} AS sum_response_time_ms, {_EVENTS} AS total_events
  FROM {source} GROUP BY event_date)"""


_CPC = (
    "CASE WHEN total_clicks > 0 THEN CAST((CAST(budget_brl * 100 AS BIGINT) * 2 + total_clicks)"
    " // (2 * total_clicks) / 100.0 AS DECIMAL(16,2)) END"
)
_HOUR_KEYS = "campaign_id, campaign_name, event_date, hour_of_day"
_PERF_COLUMNS = (
    "campaign_id, campaign_name, campaign_category, campaign_channel, target_segment, budget_brl, total_impressions,"
    " total_clicks, total_conversions, ctr, conversion_rate, total_conversion_value, avg_response_time_ms,"
    " cost_per_click, total_events"
)

_TABLES = _INPUTS + f""",
silver_sessions AS ({_typed_sessions('bronze_sessions')}),
gold_campaign_performance AS (
 SELECT a.campaign_id, campaign_name, campaign_category, campaign_channel, target_segment, budget_brl, is_active,
  is_expired, total_impressions, total_clicks, total_conversions, total_dismisses, total_deep_links,
  {_pct('total_clicks', 'total_impressions')} AS ctr, {_pct('total_conversions', 'total_clicks')} AS conversion_rate,
  total_conversion_value, {_AVG} AS avg_response_time_ms, {_CPC} AS cost_per_click, total_events
 FROM (SELECT campaign_id, {_count('impression')} AS total_impressions, {_count('click')} AS total_clicks,
   {_count('conversion')} AS total_conversions, {_count('dismiss')} AS total_dismisses,
   {_count('deep_link')} AS total_deep_links, {_VALUE} AS total_conversion_value,
   {_LATENCY_SUM} AS sum_response_time_ms, {_EVENTS} AS total_events FROM silver_clicks GROUP BY campaign_id) a
  LEFT JOIN silver_campaigns c ON a.campaign_id = c.campaign_id),
gold_campaign_hourly_metrics AS ({_period_table(_HOUR_KEYS)}),
gold_campaign_minute_metrics AS ({_period_table(_HOUR_KEYS + ', minute_of_hour')}),
gold_channel_performance AS ({_latency_table('silver_clicks', 'campaign_channel')}),
gold_segment_analysis AS ({_latency_table(
    '(SELECT s.*, c.target_segment FROM silver_clicks s LEFT JOIN silver_campaigns c USING (campaign_id))',
    'target_segment')}),
gold_geo_performance AS (
 SELECT *, {_pct('total_clicks', 'total_impressions')} AS ctr FROM (
  SELECT geo_region, geo_city, {_EVENTS} AS total_events, {_count('click')} AS total_clicks,
   {_count('impression')} AS total_impressions FROM silver_clicks GROUP BY geo_region, geo_city)),
gold_ab_test_results AS ({_latency_table('silver_clicks', 'ab_test_group')}),
gold_daily_kpis AS ({_daily_of('silver_clicks')})
"""


def _summary(where: str = "true", source: str | None = None) -> str:
    return f"""SELECT total_impressions, total_clicks, {_exact_pct('total_clicks', 'total_impressions')} AS ctr,
  total_conversions, total_events,
  CAST(CASE WHEN total_events > 0 THEN (2 * latency + total_events) // (2 * total_events) ELSE 0 END
   AS DECIMAL(20,0)) AS avg_response_time_ms
 FROM (SELECT CAST(coalesce(sum(total_impressions), 0) AS BIGINT) AS total_impressions,
  CAST(coalesce(sum(total_clicks), 0) AS BIGINT) AS total_clicks,
  CAST(coalesce(sum(total_conversions), 0) AS BIGINT) AS total_conversions,
  CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
  CAST(coalesce(sum(sum_response_time_ms), 0) AS BIGINT) AS latency FROM {f'({source})' if source else 'gold_daily_kpis'} WHERE {where})"""


def _over_campaigns(table: str, keys: str) -> str:
    return f"""SELECT {keys}, impressions, clicks, conversions, {_exact_pct('clicks', 'impressions')} AS ctr,
  total_events FROM (SELECT {keys}, CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(conversions) AS BIGINT) AS conversions,
  CAST(sum(total_events) AS BIGINT) AS total_events FROM {table} GROUP BY {keys})"""


def _checks() -> dict[str, str]:
    """Result of each query, on top of the tables above."""
    hourly, minutely = "gold_campaign_hourly_metrics", "gold_campaign_minute_metrics"
    by_hour = "ORDER BY event_date DESC NULLS FIRST, hour_of_day NULLS LAST LIMIT"
    by_minute = (
        "ORDER BY event_date DESC NULLS FIRST, hour_of_day DESC NULLS FIRST, minute_of_hour DESC NULLS FIRST LIMIT"
    )
    hour_all = f"{_over_campaigns(hourly, 'event_date, hour_of_day')} {by_hour} 168"
    hour_one = f"SELECT * FROM {hourly} WHERE campaign_id = '{CAMPAIGN}' {by_hour} 168"
    minute_all = f"{_over_campaigns(minutely, 'event_date, hour_of_day, minute_of_hour')} {by_minute} 60"
    minute_one = f"SELECT * FROM {minutely} WHERE campaign_id = '{CAMPAIGN}' {by_minute} 60"
    latency_view = "total_impressions, total_clicks, ctr, avg_response_time_ms, total_events"
    search_columns = (
        "campaign_id, campaign_name, campaign_category, campaign_channel, target_segment, total_impressions,"
        " total_clicks, total_conversions, ctr, total_events"
    )

    def search(pattern: str) -> str:
        tests = " OR ".join(
            f"lower({c}) LIKE lower('{pattern}') ESCAPE '\\'"
            for c in ("campaign_name", "campaign_category", "campaign_channel")
        )
        return (
            f"SELECT {search_columns} FROM gold_campaign_performance WHERE {tests}"
            " ORDER BY total_clicks DESC, campaign_id LIMIT 10"
        )

    in_hour = f"event_date = DATE '{DAY}' AND hour_of_day = {HOUR}"
    hour_top = (
        f"SELECT campaign_id, campaign_name, impressions, clicks, conversions, ctr FROM {hourly} WHERE {in_hour}"
        " ORDER BY clicks DESC, campaign_id LIMIT 5"
    )
    hour_channels = f"""SELECT campaign_channel, CAST(sum(total_clicks) AS BIGINT) AS clicks,
  CAST(sum(total_impressions) AS BIGINT) AS impressions FROM gold_campaign_performance
 WHERE campaign_id IN (SELECT DISTINCT campaign_id FROM {hourly} WHERE {in_hour}) GROUP BY campaign_channel"""
    hour_columns = "event_date, hour_of_day, impressions, clicks, conversions, ctr"
    geo_top = (
        "SELECT geo_region, geo_city, total_events, total_clicks, total_impressions, ctr FROM gold_geo_performance"
        " ORDER BY total_clicks DESC, geo_region, geo_city LIMIT"
    )
    daily_columns = (
        "event_date, total_impressions, total_clicks, ctr, total_conversions, total_events, avg_response_time_ms,"
        " conversion_rate"
    )

    def side(number: int, campaign: str, n: int = 48) -> str:
        rows = f"SELECT {hour_columns} FROM {hourly} WHERE campaign_id = '{campaign}' {by_hour} {n}"
        return f"SELECT {number} AS side, * FROM ({rows})"

    def doubles(names: str) -> str:
        return ", ".join(f"CAST({c.strip()} AS DOUBLE) AS {c.strip()}" for c in names.split(","))

    metrics = (
        "total_impressions", "total_clicks", "ctr", "total_conversions", "conversion_rate",
        "total_conversion_value", "cost_per_click",
    )
    compare_metrics = " UNION ALL ".join(
        f"SELECT {i} AS position, '{m}' AS metric, CAST(a.{m} AS DOUBLE) AS value1, CAST(b.{m} AS DOUBLE) AS value2,"
        f" CAST(sign(coalesce(CAST(a.{m} AS DOUBLE), 0) - coalesce(CAST(b.{m} AS DOUBLE), 0)) AS DOUBLE) AS trend"
        f" FROM gold_campaign_performance a, gold_campaign_performance b"
        f" WHERE a.campaign_id = '{CAMPAIGN}' AND b.campaign_id = '{SECOND}'"
        for i, m in enumerate(metrics, 1)
    )
    kpi_changes = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST(p.{m} AS DOUBLE) AS previous, CAST(c.{m} AS DOUBLE) AS current"
        f" FROM ({_summary(f'event_date < DATE {chr(39)}{DAY}{chr(39)}')}) p, ({_summary()}) c"
        f" WHERE p.{m} <> 0 AND p.{m} <> c.{m}"
        for m in ("total_impressions", "total_clicks", "ctr", "total_conversions")
    )
    phase = "CAST(substr(event_id, 5) AS BIGINT) % 3"
    summed = " UNION ALL ".join(
        f"SELECT {n} AS at, * FROM ({_summary(source=_daily_of(f'(SELECT * FROM silver_clicks WHERE {phase} < {n})'))})" for n in range(4)
    )
    live_kpis = " UNION ALL ".join(
        f"SELECT CAST(c.at AS BIGINT) AS at, '{m}' AS metric, CAST(p.{m} AS DOUBLE) AS previous, CAST(c.{m} AS DOUBLE) AS current"
        f" FROM ({summed}) p JOIN ({summed}) c ON c.at = p.at + 1 WHERE p.{m} <> 0 AND p.{m} <> c.{m}"
        for m in ("total_impressions", "total_clicks", "ctr", "total_conversions")
    )
    before = _period_table(_HOUR_KEYS, f"(SELECT * FROM silver_clicks WHERE event_timestamp < TIMESTAMP '{BEFORE}')")
    after = _period_table(_HOUR_KEYS, f"(SELECT * FROM silver_clicks WHERE event_timestamp >= TIMESTAMP '{AFTER}')")
    key = "campaign_id, event_date, hour_of_day"
    feed = f"""SELECT *, CASE WHEN ({key}) IN (SELECT ({key}) FROM b) THEN 'update_postimage' ELSE 'insert' END
  AS _change_type FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
 UNION ALL SELECT *, CASE WHEN ({key}) IN (SELECT ({key}) FROM a) THEN 'update_preimage' ELSE 'delete' END
  AS _change_type FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
    fragments = f"""SELECT session_id, CAST(CAST(substr(event_id, 5) AS BIGINT) // {FLUSH_EVERY} AS BIGINT)
  AS flush_number, min_by(customer_id, event_id) AS customer_id, min_by(device_id, event_id) AS device_id,
  min_by(device_os, event_id) AS device_os, min_by(app_version, event_id) AS app_version,
  min_by(geo_region, event_id) AS geo_region, min_by(geo_city, event_id) AS geo_city,
  min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
  CAST(count(DISTINCT event_id) AS INT) AS total_events,
  CAST(count(DISTINCT CASE WHEN action_type = 'click' THEN event_id END) AS INT) AS total_clicks
 FROM bronze_clicks GROUP BY ALL"""
    cells = f"""{_count('impression')} AS impressions, {_count('click')} AS clicks,
  {_count('conversion')} AS conversions, {_count('dismiss')} AS dismisses, {_count('deep_link')} AS deep_links,
  {_VALUE} AS conversion_value, {_LATENCY_SUM} AS response_time_ms, {_EVENTS} AS events"""
    rules = """SELECT 'clicks' AS dataset, 'valid_event_id' AS rule, 'drop' AS action,
   event_id IS NOT NULL AS ok FROM bronze_clicks
  UNION ALL SELECT 'clicks', 'valid_campaign_id', 'drop', campaign_id IS NOT NULL FROM bronze_clicks
  UNION ALL SELECT 'clicks', 'valid_action_type', 'warn', coalesce(action_type IN
   ('impression', 'click', 'dismiss', 'swipe', 'deep_link', 'conversion'), false) FROM bronze_clicks
  UNION ALL SELECT 'clicks', 'readable_event_timestamp', 'warn', event_timestamp IS NULL
   OR TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL FROM bronze_clicks
  UNION ALL SELECT 'clicks', 'readable_conversion_value', 'warn', conversion_value IS NULL
   OR TRY_CAST(conversion_value AS DECIMAL(15,2)) IS NOT NULL FROM bronze_clicks
  UNION ALL SELECT 'campaigns', 'valid_campaign_id', 'drop', campaign_id IS NOT NULL FROM bronze_campaigns
  UNION ALL SELECT 'campaigns', 'readable_campaign_start_date', 'warn', campaign_start_date IS NULL
   OR TRY_CAST(campaign_start_date AS DATE) IS NOT NULL FROM bronze_campaigns
  UNION ALL SELECT 'campaigns', 'readable_campaign_end_date', 'warn', campaign_end_date IS NULL
   OR TRY_CAST(campaign_end_date AS DATE) IS NOT NULL FROM bronze_campaigns
  UNION ALL SELECT 'campaigns', 'readable_budget_brl', 'warn', budget_brl IS NULL
   OR TRY_CAST(budget_brl AS DECIMAL(15,2)) IS NOT NULL FROM bronze_campaigns
  UNION ALL SELECT 'campaigns', 'unique_campaign_id', 'warn', count(*) OVER (PARTITION BY campaign_id) = 1
   FROM bronze_campaigns
  UNION ALL SELECT 'sessions', 'readable_session_start', 'warn', session_start IS NULL
   OR TRY_CAST(session_start AS TIMESTAMP) IS NOT NULL FROM bronze_sessions
  UNION ALL SELECT 'sessions', 'readable_session_end', 'warn', session_end IS NULL
   OR TRY_CAST(session_end AS TIMESTAMP) IS NOT NULL FROM bronze_sessions
  UNION ALL SELECT 'sessions', 'valid_session_id', 'drop', session_id IS NOT NULL FROM bronze_sessions"""
    silver_clicks = (
        "SELECT * EXCLUDE (minute_of_hour), CAST(NULL AS VARCHAR) AS conversion_product FROM silver_clicks"
    )
    checks = {
        "silver_clicks": silver_clicks,
        "silver_campaigns": "SELECT * FROM silver_campaigns",
        "silver_sessions": "SELECT * FROM silver_sessions",
        "quality_report": f"""SELECT dataset, rule, action,
  CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN ok OR action = 'warn' THEN 0 ELSE 1 END) AS BIGINT) AS dropped
 FROM ({rules}) GROUP BY dataset, rule, action""",
        "activity_cells": f"""SELECT CASE WHEN grouping(campaign_id) = 0 THEN 'campaign_minute'
   WHEN grouping(geo_region) = 0 THEN 'geo' ELSE 'ab_test' END AS cell_set, campaign_id, campaign_name,
  campaign_channel, event_date, hour_of_day, minute_of_hour, geo_region, geo_city, ab_test_group, {cells}
 FROM silver_clicks GROUP BY GROUPING SETS (
  (campaign_id, campaign_name, campaign_channel, event_date, hour_of_day, minute_of_hour),
  (geo_region, geo_city), (ab_test_group))""",
        "kpis_summary": _summary(),
        "kpis_daily": f"SELECT {daily_columns} FROM gold_daily_kpis ORDER BY event_date DESC NULLS FIRST LIMIT 30",
        "channels": f"SELECT campaign_channel, {latency_view} FROM gold_channel_performance",
        "segments": f"SELECT target_segment, {latency_view} FROM gold_segment_analysis",
        "ab_test": f"SELECT ab_test_group, {latency_view} FROM gold_ab_test_results",
        "geo_top": f"{geo_top} 20",
        "campaigns_performance": f"SELECT {_PERF_COLUMNS}, is_active FROM gold_campaign_performance",
        "hourly_all": hour_all,
        "hourly_one": hour_one,
        "trend_hour_all": hour_all,
        "trend_hour_one": hour_one,
        "trend_minute_all": minute_all,
        "trend_minute_one": minute_one,
        "search": search("%BANNER%"),
        "search_wildcard": search("%gn 3_%"),
        "search_escaped": f"SELECT {search_columns} FROM gold_campaign_performance"
        " WHERE contains(lower(campaign_channel), 'in_app_banner') ORDER BY total_clicks DESC, campaign_id LIMIT 10",
        "hour_detail_top": hour_top,
        "hour_detail_channels": hour_channels,
        "compare_perf": f"""SELECT CASE campaign_id WHEN '{CAMPAIGN}' THEN 1 ELSE 2 END AS side, {_PERF_COLUMNS}
 FROM gold_campaign_performance WHERE campaign_id IN ('{CAMPAIGN}', '{UNLISTED}')""",
        "compare_hours": f"{side(1, CAMPAIGN)} UNION ALL {side(2, UNLISTED)}",
        "json_safe_campaigns": "SELECT campaign_id, campaign_name, campaign_category, campaign_channel,"
        f" target_segment, {doubles('budget_brl, is_active, ' + ', '.join(_PERF_COLUMNS.split(', ')[6:]))}"
        " FROM (SELECT * REPLACE (CAST(is_active AS INT) AS is_active) FROM gold_campaign_performance)",
        "json_safe_daily": "SELECT strftime(event_date, '%Y-%m-%d') AS event_date,"
        f" {doubles(daily_columns.split(', ', 1)[1])} FROM gold_daily_kpis"
        " ORDER BY gold_daily_kpis.event_date DESC NULLS FIRST LIMIT 30",
        "trend_series_hour": f"""SELECT *, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS label,
  CAST(event_date AS VARCHAR) || ' ' || lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS full_label
 FROM ({hour_all}) ORDER BY event_date DESC, hour_of_day DESC LIMIT 48""",
        "trend_series_minute": f"""SELECT *, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':'
   || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') AS label,
  CAST(event_date AS VARCHAR) || ' ' || lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':'
   || lpad(CAST(minute_of_hour AS VARCHAR), 2, '0') AS full_label FROM ({minute_all})""",
        "cross_filter_top": "SELECT * FROM gold_campaign_performance WHERE campaign_channel = 'push'"
        " AND target_segment = 'varejo' ORDER BY ctr DESC, campaign_id LIMIT 12",
        "compare_metrics": compare_metrics,
        "compare_series": f"""SELECT CAST(coalesce(l.event_date, r.event_date) AS VARCHAR) || ' '
   || lpad(CAST(coalesce(l.hour_of_day, r.hour_of_day) AS VARCHAR), 2, '0') || ':00' AS label,
  coalesce(l.clicks, 0) AS clicks1, coalesce(r.clicks, 0) AS clicks2
 FROM ({side(1, CAMPAIGN)}) l FULL OUTER JOIN ({side(2, SECOND)}) r
  ON l.event_date = r.event_date AND l.hour_of_day = r.hour_of_day""",
        "channel_share": "SELECT *, clicks / (SELECT greatest(coalesce(max(clicks), 1), 1) FROM"
        f" ({hour_channels})) * 100 AS share FROM ({hour_channels})",
        "segment_share": f"SELECT target_segment, {latency_view}, total_clicks / (SELECT sum(total_clicks) FROM"
        " gold_segment_analysis) * 100 AS share FROM gold_segment_analysis",
        "geo_labels": f"SELECT *, geo_city || ' (' || geo_region || ')' AS label FROM ({geo_top} 15)",
        "overall_conversion_rate": "SELECT total_clicks, total_conversions, CASE WHEN total_clicks > 0 THEN"
        f" total_conversions / total_clicks * 100 END AS overall_conversion_rate FROM ({_summary()})",
        "kpi_changes": kpi_changes,
        "hour_rank": "SELECT *, CAST(row_number() OVER (ORDER BY clicks DESC, campaign_id) AS INT) AS rank"
        f" FROM ({hour_top})",
        "sessions_from_events": "SELECT * FROM bronze_sessions",
        "session_fragments": fragments,
        "session_fragments_merged": "SELECT * FROM bronze_sessions",
        "silver_sessions_of_fragments": f"SELECT * FROM ({_typed_sessions(f'({fragments})')}) AS f"
        " QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY flush_number) = 1",
        "change_feed": f"FROM (WITH b AS ({before}), a AS ({after}) {feed})",
        "keyed_upsert": f"SELECT * FROM {hourly}",
        "materialized_hourly": f"SELECT * FROM {hourly}",
        "full_refresh": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count,"
            f" CAST(sum(total_events) AS BIGINT) AS total_events FROM {name}"
            for name in gold.TABLES
        ),
        "stream_dedup": silver_clicks,
        "compacted_raw": silver_clicks,
        "silver_clicks_from_files": silver_clicks,
        "stream_sessions": "SELECT * FROM silver_sessions",
        "stream_daily_complete": "SELECT * FROM gold_daily_kpis",
        "stream_hourly_renamed": f"""SELECT *, {_pct('clicks', 'impressions')} AS ctr FROM (
 SELECT campaign_id, max(campaign_name || ' v' || CAST(substr(event_id, 5) AS BIGINT) % 3) AS campaign_name,
  event_date, hour_of_day, {_count('impression')} AS impressions, {_count('click')} AS clicks,
  {_count('conversion')} AS conversions, {_EVENTS} AS total_events
 FROM silver_clicks GROUP BY campaign_id, event_date, hour_of_day)""",
        "stream_fresh_metadata": "SELECT * FROM gold_campaign_performance",
        "bounded_dedup_outcome": f"""FROM (WITH t AS (
  SELECT event_id, CASE WHEN event_id % 97 != 0 THEN ts END AS ts,
   CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END AS n FROM events),
 h AS (SELECT max(ts) - INTERVAL {LATE_DELAY} AS horizon FROM t WHERE event_id % 5 != 0)
 SELECT event_id, outcome, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT event_id, CASE WHEN ts IS NULL THEN 'untimed' ELSE 'kept' END AS outcome,
   CASE WHEN ts IS NULL THEN n ELSE 1 END AS n FROM t WHERE event_id % 5 != 0
  UNION ALL
  SELECT event_id, CASE WHEN ts IS NULL THEN 'untimed' WHEN ts < horizon THEN 'late' ELSE 'kept' END,
   CASE WHEN ts IS NULL OR ts < horizon THEN n ELSE 1 END
  FROM t, h WHERE (event_id % 5 = 0 OR event_id % 7 = 0)
   AND (event_id % 5 = 0 OR ts IS NULL OR ts < horizon)) GROUP BY event_id, outcome)""",
        "stored_campaign_performance": "SELECT * FROM gold_campaign_performance",
        "stored_campaign_hourly_metrics": f"SELECT * FROM {hourly}",
        "stored_daily_kpis": "SELECT * FROM gold_daily_kpis",
        "stored_geo_performance": "SELECT * FROM gold_geo_performance",
        "stored_campaign_minute_metrics": f"SELECT * FROM {minutely}",
        "stored_trend_hour": hour_all,
        "stored_trend_minute": minute_all,
        **{name: "SELECT * FROM gold_" + name.partition("_")[2] for name in (
            "live_campaign_performance", "live_campaign_minute_metrics", "live_segment_analysis", "live_geo_performance",
            "refreshed_campaign_performance", "refreshed_campaign_hourly_metrics", "refreshed_daily_kpis")},
        "live_daily_after_reset": "SELECT * FROM gold_daily_kpis",
        "live_continuous_daily": "SELECT * FROM gold_daily_kpis",
        "stream_sessions_from_events": "SELECT * FROM bronze_sessions",
        "search_blank": f"SELECT {search_columns} FROM gold_campaign_performance WHERE false",
        "catalog_tables": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{table.comment}' AS comment, 'gold' AS quality, 'campaigns' AS team,"
            f" CAST(count(*) AS BIGINT) AS row_count, CAST(sum(total_events) AS BIGINT) AS total_events FROM {name}"
            for name, table in gold.TABLES.items()
        ),
        "live_feed_applied": f"SELECT * FROM {hourly}",
        "replica_after_reset": f"SELECT * FROM {hourly}",
        "live_trend_hour": hour_all,
        "live_kpi_changes": live_kpis,
        "stream_rule_report": f"""SELECT dataset, rule, action, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN ok OR action = 'warn' THEN 0 ELSE 1 END) AS BIGINT) AS dropped
 FROM ({rules}) WHERE dataset = 'clicks' AND rule LIKE 'valid%' GROUP BY dataset, rule, action""",
        "stream_hourly_watermarked": f"""SELECT * FROM {hourly}
 WHERE event_date + to_hours(hour_of_day + 1)
  <= (SELECT max(event_timestamp) - INTERVAL 7 DAY FROM silver_clicks)""",
    }
    for short, name in _GOLD.items():
        checks[name] = checks[f"stream_{short}"] = f"SELECT * FROM {name}"
    return checks


# Generated interactions. A draw is eight hex digits of md5('seed:topic:number:draw div 4').


def _word(topic: str, number: str, draw: int) -> str:
    digest = f"md5('{SYNTH['seed']}:{topic}:' || {number} || ':{draw // 4}')"
    return f"CAST(('0x' || substr({digest}, {1 + 8 * (draw % 4)}, 8)) AS BIGINT)"


def _choice(values: tuple[str, ...], index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[({index}) + 1]"


def _by_weight(draw: str, weights: tuple[int, ...], values: tuple[object, ...]) -> str:
    """The weights written out: each value repeated as often as it weighs."""
    repeated = [v for v, w in zip(values, weights) for _ in range(w)]
    return f"([{', '.join(repr(v) for v in repeated)}])[({draw}) % {len(repeated)} + 1]"


def _synthetic() -> str:
    def click(draw: int) -> str:
        return _word("click", "event_id", draw)

    def session(draw: int) -> str:
        return _word("session", "s", draw)

    low, high = synth.RESPONSE_MS
    cents = " ".join(
        f"WHEN '{c}' THEN v % {(b - a) * 100 + 1} + {a * 100}" for c, (a, b) in synth.CONVERSION_RANGE.items()
    )
    return f"""
WITH drawn AS (
 SELECT event_id, {click(0)} % {SYNTH['campaigns']} AS c, {click(1)} % {SYNTH['sessions']} AS s,
  {_by_weight(click(2), synth.ACTION_WEIGHTS, synth.ACTION_TYPES)} AS action_type,
  {_by_weight(click(3), synth.HOUR_WEIGHTS, tuple(range(24)))} AS h, {click(4)} % 3600 AS sec,
  CAST({click(5)} % {synth.DAYS_BACK + 1} AS INT) AS days, {click(6)} % {synth.SCREENS} AS screen,
  {click(7)} % {synth.SCREENS - 1} AS ref, {_choice(synth.ELEMENTS, f'{click(8)} % {len(synth.ELEMENTS)}')} AS element,
  {click(9)} % 100 < {synth.PERSONALIZED_PERCENT} AS is_personalized,
  {_choice(synth.AB_GROUPS, f'{click(10)} % 3')} AS ab_test_group,
  CAST({click(11)} % {high - low + 1} + {low} AS INT) AS response_time_ms, {click(12)} AS v,
  {click(13)} % {synth.OFFERS} + 1 AS offer FROM events),
named AS (
 SELECT *, {_choice(synth.CATEGORIES, f'c % {len(synth.CATEGORIES)}')} AS campaign_category,
  {session(0)} % {synth.REGIONS} AS region FROM drawn),
synthetic AS (
 SELECT 'EVT-' || {_padded('event_id', 16)} AS event_id,
  CAST(DATE '{SYNTH['base'].date()}' - days AS VARCHAR) || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':'
   || lpad(CAST(sec // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') AS event_timestamp,
  'CUST-' || ({session(1)} % 900000 + 100000) AS customer_id,
  'SESS-' || lpad(CAST(s AS VARCHAR), 12, '0') AS session_id,
  'DEV-' || lpad(CAST({session(2)} AS VARCHAR), 10, '0') AS device_id,
  {_by_weight(session(3), synth.DEVICE_WEIGHTS, synth.DEVICE_SYSTEMS)} AS device_os,
  {_choice(synth.APP_VERSIONS, f'{session(4)} % {len(synth.APP_VERSIONS)}')} AS app_version,
  'CMP-' || lpad(CAST(c AS VARCHAR), 6, '0') AS campaign_id, 'Campaign ' || c AS campaign_name,
  {_choice(synth.CHANNELS, f'c % {len(synth.CHANNELS)}')} AS campaign_channel, campaign_category,
  'OFR-' || lpad(CAST(c AS VARCHAR), 6, '0') || '-' || lpad(CAST(offer AS VARCHAR), 3, '0') AS offer_id, action_type,
  CASE WHEN action_type IN ('click', 'deep_link', 'conversion') THEN element END AS action_element,
  'screen ' || screen AS screen_name, 'screen ' || ((screen + 1 + ref) % {synth.SCREENS}) AS referrer_screen,
  'Region ' || region AS geo_region,
  'City ' || region || '-' || ({session(5)} % {synth.CITIES_PER_REGION}) AS geo_city,
  is_personalized, ab_test_group, response_time_ms,
  CAST(CASE WHEN action_type = 'conversion' THEN (CASE campaign_category {cents} ELSE 0 END) / 100 ELSE 0.0 END
   AS DOUBLE) AS conversion_value,
  CASE WHEN action_type = 'conversion' THEN 'Product ' || campaign_category ELSE '' END AS conversion_product
 FROM named)
"""


def oracle_sql() -> dict[str, str]:
    out = {name: _TABLES + check for name, check in _checks().items()}
    out["synth_clicks"] = _synthetic() + "SELECT * FROM synthetic"
    out["synth_sessions"] = _synthetic() + """SELECT session_id, any_value(customer_id) AS customer_id,
  any_value(device_id) AS device_id, any_value(device_os) AS device_os, any_value(app_version) AS app_version,
  any_value(geo_region) AS geo_region, any_value(geo_city) AS geo_city, min(event_timestamp) AS session_start,
  max(event_timestamp) AS session_end, CAST(count(*) AS INT) AS total_events,
  CAST(sum(CASE WHEN action_type = 'click' THEN 1 ELSE 0 END) AS INT) AS total_clicks
 FROM synthetic GROUP BY session_id"""
    if llm:
        out |= llm.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return out
