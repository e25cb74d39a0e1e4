"""All campaign tables from one stream, kept up to date by what changes.

One streaming aggregation holds the sums of the finest cells: campaign by minute, place by day, experiment group by day.
A micro-batch brings the new sums of the cells it changed. Merged into the stored cells, each has an image before and an
image after; their difference is a signed sum, and all coarser tables (minutes, hours, days, campaigns, channels, places,
experiment groups) are brought up to date by adding the signed sums of their own keys. So the cost of a batch follows the
partitions it touches, there is one state store for eight tables, and the tables always agree with the stored cells:
also when a query that lost its checkpoint replays everything from the beginning.

Tables with campaign metadata are made when they are read, from the sums per campaign and the metadata of that moment.
The same tables can be brought up to date by a batch: :func:`refresh_dates` takes arrivals, finds the dates they touch, and
recomputes the cells of those dates alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from campflow.functions import measures as M
from campflow.operators.dedup import dedup
from campflow.plans import dashboard, gold, serving
from campflow.plans.answers import Dashboard
from campflow.plans.silver import silver_clicks
from campflow.streaming.run import start
from campflow.streaming.store import Batch, Store, Table, changed_rows, columns, run_of, within

#: Besides the sums: how many rows have a value at all, so that a sum of nothing is told from one of zeros.
_FILLED = {
    "value_rows": "count_if(action_type = 'conversion' AND conversion_value IS NOT NULL)",
    "latency_rows": "count(response_time_ms)",
}
_NULL_WITHOUT = {"conversion_value": "value_rows", "response_time_ms": "latency_rows"}
_SUMS = {**M.EVENT_SUMS, **_FILLED}
_SUM_KINDS = {c: "decimal(25,2)" if c == "conversion_value" else "bigint" for c in _SUMS}
_SUM_COLUMNS = {c: "money" if c == "conversion_value" else "bigint" for c in _SUMS}

_SETS = {
    "campaign_minute": ("campaign_id", "campaign_name", "campaign_channel", "event_date", "hour_of_day", "minute_of_hour"),
    "geo": ("event_date", "geo_region", "geo_city"),
    "ab_test": ("event_date", "ab_test_group"),
}
_CELL_KEYS = tuple(dict.fromkeys(k for own in _SETS.values() for k in own))
_KINDS = {"event_date": "date", "hour_of_day": "int", "minute_of_hour": "int"}


def _table(name: str, keys: tuple[str, ...], by: str | None, values: tuple[str, ...] = (), buckets: int = 1) -> Table:
    named = {k: _KINDS.get(k, "string") for k in (*keys, *values)}
    return Table(name, columns(**named, **_SUM_COLUMNS), keys, by, buckets)


CELLS = _table("cells", ("cell_set", *_CELL_KEYS), "event_date")
#: The tables of sums under their keys. Names of campaigns are no keys.
_HOUR = ("campaign_id", "event_date", "hour_of_day")
MINUTES = _table("minutes", (*_HOUR, "minute_of_hour"), "event_date", ("campaign_name",))
HOURS = _table("hours", _HOUR, "event_date", ("campaign_name",))
CAMPAIGNS = _table("campaigns", ("campaign_id",), None, buckets=16)
#: Tables of few rows are one table, stored by kind; keys that a kind does not have are NULL.
_KINDS_OF = {"campaign_minute": ("days", "channels"), "geo": ("places",), "ab_test": ("groups",)}
_KIND_KEYS = {"days": ("event_date",), "channels": ("campaign_channel",), "places": ("geo_region", "geo_city"), "groups": ("ab_test_group",)}
TOTALS = _table("totals", ("kind", *[k for keys in _KIND_KEYS.values() for k in keys]), "kind")
_SUMS_OF = {
    "gold_campaign_minute_metrics": MINUTES, "gold_campaign_hourly_metrics": HOURS,
    "gold_campaign_performance": CAMPAIGNS, "gold_segment_analysis": CAMPAIGNS,
}
_KIND_OF = {
    "gold_daily_kpis": "days", "gold_channel_performance": "channels", "gold_geo_performance": "places",
    "gold_ab_test_results": "groups",
}
#: Key figures that a batch changed, as the dashboard would flash them, one row per figure and batch.
KPI_CHANGES = Table("kpi_changes", columns(at="bigint", metric="string", previous="double", current="double"), ("at", "metric"))


def live_cells(clicks: DataFrame) -> DataFrame:
    """The sums of all cells of cleaned interactions, a stream or not: one pass, one shuffle, one state."""
    minutes = clicks.withColumn("minute_of_hour", F.minute("event_timestamp"))
    ids = {name: sum(1 << (len(_CELL_KEYS) - 1 - i) for i, k in enumerate(_CELL_KEYS) if k not in own) for name, own in _SETS.items()}
    names = " ".join(f"WHEN {number} THEN '{name}'" for name, number in ids.items())
    sets = [[F.col(k) for k in own] for own in _SETS.values()]
    grouped = minutes.groupingSets(sets, *[F.col(k) for k in _CELL_KEYS])
    sums = [F.expr(f"{text} AS {name}") for name, text in _SUMS.items()]
    return grouped.agg(F.grouping_id().alias("_set"), *sums).selectExpr(f"CASE _set {names} END AS cell_set", *_CELL_KEYS, *_SUMS)


def _signed(images: DataFrame) -> DataFrame:
    """What each changed cell adds to the tables above it: the sums after less the sums before."""
    def after_less_before(c: str) -> Column:
        new, old = (F.coalesce(F.col(f"{side}.{c}"), F.lit(0)) for side in ("new", "old"))
        return (new - old).cast(_SUM_KINDS[c]).alias(c)

    weight = F.coalesce("new.events", F.lit(0)).alias("_weight")
    return changed_rows(images).select(*CELLS.keys, weight, *[after_less_before(c) for c in _SUMS])


def _added(c: str) -> Column:
    """A stored sum and a signed sum; NULL again where nothing is left that has a value."""
    def both(name: str) -> Column:
        return F.coalesce(F.col(f"old.{name}"), F.lit(0)) + F.col(f"change.{name}")

    return F.when(both(_NULL_WITHOUT[c]) > 0, both(c)) if c in _NULL_WITHOUT else both(c)


def _changes(table: Table, signed: DataFrame) -> DataFrame:
    """The signed sums of one table's keys."""
    sums = [F.sum(c).cast(_SUM_KINDS[c]).alias(c) for c in _SUMS]
    if table is TOTALS:
        kinds = " ".join(f"WHEN '{cells}' THEN array{kinds!r}".replace(",)", ")") for cells, kinds in _KINDS_OF.items())
        rows = signed.withColumn("kind", F.explode(F.expr(f"CASE cell_set {kinds} END")))
        own = [F.when(F.col("kind") == kind, F.col(k)).alias(k) for kind, keys in _KIND_KEYS.items() for k in keys]
        return rows.select("kind", *own, *_SUMS).groupBy(*table.keys).agg(*sums)
    rows = signed.filter("cell_set = 'campaign_minute'")
    if "campaign_name" not in table.values:
        return rows.groupBy(*table.keys).agg(*sums)
    # a key takes the name that changed last; of several in one batch, that with most events
    named = rows.groupBy(*table.keys, "campaign_name").agg(F.sum("_weight").alias("_weight"), *sums)
    best = F.max_by("campaign_name", F.struct("_weight", "campaign_name")).alias("campaign_name")
    return named.groupBy(*table.keys).agg(best, *sums)


def _merge_cells(batch: Batch, cells: DataFrame, dates: list, whole: bool = False) -> None:
    images = batch.merge(CELLS, cells, touched=dates, whole=whole, feed=False)
    signed = batch.keep("signed", _signed(images))
    # sums only shrink where rows are taken back: by a new run of a query, or by other copies of an event
    shrinks = (signed.agg(F.min("events").alias("least")).first().least or 0) < 0
    left = F.col("new.events") > 0 if shrinks else None
    touched = {MINUTES: dates, HOURS: dates, CAMPAIGNS: None, TOTALS: list(_KIND_KEYS)}

    def merge(table: Table) -> DataFrame:
        combine = {c: _added(c) for c in _SUMS}
        return batch.merge(table, _changes(table, signed), combine=combine, keep_row=left, touched=touched[table])

    with ThreadPoolExecutor(len(touched)) as pool:  # most of the tables are too small to fill a cluster
        merged = dict(zip(touched, list(pool.map(merge, touched))))
    _merge_kpi_changes(batch, merged[TOTALS].filter("kind = 'days'"))


def _merge_kpi_changes(batch: Batch, days: DataFrame) -> None:
    """The key figures over all days before and after the batch, where they differ."""
    def summary(side: str) -> DataFrame:
        rows = days.filter(F.col(side).isNotNull()).select("event_date", f"{side}.*")
        return serving.kpis_summary(finished("gold_daily_kpis", rows))

    moved = dashboard.kpi_changes(summary("old"), summary("new"))
    moved = moved.select(F.lit(batch.version).cast("long").alias("at"), "metric", "previous", "current")
    batch.merge(KPI_CHANGES, moved, feed=False)


def merge_changed_cells(root: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function for an update-mode stream of :func:`live_cells`."""

    def write(cells: DataFrame, batch_id: int) -> None:
        def prepare(batch: Batch) -> None:
            changed = batch.keep("cells", cells)
            _merge_cells(batch, changed, _dates(changed))

        Store(cells.sparkSession, root).apply(run_of(cells), batch_id, prepare)

    return write


def start_live(clicks: DataFrame, root: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep all campaign tables below ``root`` up to date from a stream of cleaned interactions.

    Each batch writes the dates it touches anew, so triggers of a minute and more suit it.
    """
    return start(live_cells(clicks), merge_changed_cells(root), checkpoint, mode="update", trigger=trigger)


def finished(name: str, sums: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """A gold table from rows of its sums; row by row, so feeds and their streams can be finished too."""
    if name in gold.WITH_CAMPAIGNS:
        return gold.build(name, sums.select("campaign_id", *M.EVENT_SUMS), campaigns)
    return gold.finish_sums(sums, name)


def live_table(spark: SparkSession, root: str, name: str, campaigns: DataFrame | Callable[[], DataFrame] | None = None) -> DataFrame:
    """The current rows of a gold table; ``campaigns`` (or a function that reads it now) for the two that need it."""
    store = Store(spark, root)
    if name in _KIND_OF:
        sums = store.read(TOTALS).filter(F.col("kind") == _KIND_OF[name])
    else:
        sums = store.read(_SUMS_OF[name])
    return finished(name, sums, campaigns() if callable(campaigns) else campaigns)


def live_feed(spark: SparkSession, root: str, name: str, streaming: bool = False) -> DataFrame:
    """The change feed of a gold table without metadata: its rows with ``_change_type`` and ``version``.

    As a stream it follows the feed's files, each of which belongs to one version.
    """
    if name in gold.WITH_CAMPAIGNS:
        raise ValueError(f"{name} changes with the metadata too; follow the sums of its campaigns")
    feed = Store(spark, root).feed(TOTALS if name in _KIND_OF else _SUMS_OF[name], streaming)
    if name in _KIND_OF:
        feed = feed.filter(F.col("kind") == _KIND_OF[name])
    return gold.finish_sums(feed, name, extra=("_change_type", "version"))


def kpi_changes(spark: SparkSession, root: str) -> DataFrame:
    """The key figures that each batch changed: ``at`` (the batch's version), ``metric, previous, current``."""
    return Store(spark, root).read(KPI_CHANGES)


def live_tables(spark: SparkSession, root: str, campaigns: DataFrame | Callable[[], DataFrame]) -> Dashboard:
    """The dashboard over the live tables. Trends read the newest days only."""
    return Dashboard({name: live_table(spark, root, name, campaigns) for name in gold.TABLES}, by_day=True)


def refresh_dates(arrivals: DataFrame, root: str, run: str | None = None) -> list:
    """Bring silver and all tables below ``root`` up to date with newly arrived raw interactions; returns the dates.

    Only the dates of the arrivals are read and written: their silver rows are merged with what is stored, one per
    event_id, their cells are counted anew, and the tables above get the differences. The first call, on an empty
    folder, is a full load. An arrival that repeats a stored event with another date counts on both; a full refresh
    settles that. ``run`` names the arrivals: the same name again, right after itself, does nothing.
    """
    spark = arrivals.sparkSession
    store, dates = Store(spark, root), []

    def prepare(batch: Batch) -> None:
        clean = batch.keep("arrived", silver_clicks(arrivals, order_by=["event_timestamp"]))
        silver = silver_table(clean)
        dates[:] = _dates(clean)
        rows = clean  # one per event_id
        if store.holds(silver, dates):
            stored = store.read(silver).filter(within("event_date", dates))
            rows = dedup(stored.select(*clean.columns).unionByName(clean), ["event_id"], ["event_timestamp"])
        images = batch.merge(silver, rows, touched=dates, whole=True, feed=False, unique=True)
        current = images.filter("new IS NOT NULL").select("event_id", "event_date", "new.*")
        _merge_cells(batch, live_cells(current), dates, whole=True)

    store.apply(run or uuid.uuid4().hex, 0, prepare)
    return dates


def _dates(rows: DataFrame) -> list:
    return [row[0] for row in rows.select("event_date").distinct().collect()]


def silver_table(clicks: DataFrame) -> Table:
    """Cleaned interactions stored by date, as :func:`refresh_dates` keeps them; ``clicks`` gives the schema."""
    return Table("silver_clicks", clicks.schema, ("event_id",), "event_date")
