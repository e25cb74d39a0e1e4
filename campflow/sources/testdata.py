"""The generic test tables, mapped to raw campaign tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campflow.operators.dedup import dedup
from campflow.operators.sessions import sessions_from_events

# declared, so that opening a table starts no job to infer them
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_CUSTOMER = "c_custkey bigint, c_nationkey int"
_NATION = "n_nationkey int, n_name string, n_regionkey int"
_REGION = "r_regionkey int, r_name string"
_PART = "p_partkey bigint, p_type string, p_size int, p_retailprice double"


def _table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _channel(number: str) -> str:
    return (
        f"CASE {number} % 4 WHEN 0 THEN 'push' WHEN 1 THEN 'in_app_banner' WHEN 2 THEN 'in_app_modal' ELSE 'story' END"
    )


def _padded(number: str, width: int) -> str:
    """Leading zeros up to ``width``; longer numbers stay whole (lpad alone would cut them)."""
    return f"lpad(string({number}), greatest({width}, length(string({number}))), '0')"


_CLICK_COLUMNS = (
    f"concat('EVT-', {_padded('event_id', 16)}) AS event_id",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS event_timestamp",
    f"concat('CUST-', {_padded('user_id', 12)}) AS customer_id",
    f"concat('SESS-', {_padded('event_id div 12', 16)}) AS session_id",
    "concat('DEV-', lpad(string(user_id * 31 % 100000), 6, '0')) AS device_id",
    "if(user_id % 20 < 9, 'iOS', 'Android') AS device_os",
    "concat('8.', 9 + user_id % 4, '.0') AS app_version",
    f"if(k = 98, NULL, concat('CMP-', {_padded('c', 12)})) AS campaign_id",
    "concat('Campaign ', c) AS campaign_name",
    f"{_channel('c')} AS campaign_channel",
    """CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'conversion'
       WHEN 'error' THEN 'dismiss'
       ELSE CASE WHEN k = 99 THEN 'hover' WHEN k % 2 = 0 THEN 'swipe' ELSE 'deep_link' END END AS action_type""",
    "r_name AS geo_region",
    "n_name AS geo_city",
    "k < 65 AS is_personalized",
    "CASE user_id % 3 WHEN 0 THEN 'control' WHEN 1 THEN 'variant_a' ELSE 'variant_b' END AS ab_test_group",
    "if(k = 97, NULL, 50 + (k * 7) % 750) AS response_time_ms",
    "if(event_type = 'purchase', value, double(0)) AS conversion_value",
)
# Part 0 is campaign 5: the events of campaigns 0 to 4 have no metadata, and most metadata has no events.
_CAMPAIGN_COLUMNS = (
    f"concat('CMP-', {_padded('p_partkey + 5', 12)}) AS campaign_id",
    "concat('Campaign ', p_partkey + 5) AS campaign_name",
    "p_type AS campaign_category",
    f"{_channel('(p_partkey + 5)')} AS campaign_channel",
    "string(date_sub(date'2024-01-01', p_size)) AS campaign_start_date",
    "string(date_add(date'2024-02-01', int(p_partkey % 40))) AS campaign_end_date",
    """CASE p_size % 4 WHEN 0 THEN 'varejo' WHEN 1 THEN 'alta_renda' WHEN 2 THEN 'private' ELSE 'pj' END
       AS target_segment""",
    "p_retailprice * 100 AS budget_brl",
    "p_partkey % 40 >= 15 AS is_active",
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events", EVENTS_SCHEMA)


def stream_events(spark: SparkSession, location: str, files_per_batch: int | None = None) -> DataFrame:
    """The events as a stream. ``location`` is a folder of files, or a glob (which may match a single file)."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(location)


def bronze_clicks(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Raw interactions from events; every fiftieth event arrives twice.

    The repeats come from exploding a one- or two-element array, so events are scanned once. The small tables are
    joined to the events one by one: each is then sized by its own files, broadcast below Spark's threshold and
    merged beyond it (joined to each other first, their estimate would be the product of their sizes).
    """
    events = read_events(spark, sf_dir) if events is None else events
    located = (
        events.join(_table(spark, sf_dir, "customer", _CUSTOMER), F.expr("user_id = c_custkey"))
        .join(_table(spark, sf_dir, "nation", _NATION), F.expr("c_nationkey = n_nationkey"))
        .join(_table(spark, sf_dir, "region", _REGION), F.expr("n_regionkey = r_regionkey"))
    )
    arrivals = located.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "n_name", "r_name",
        "int(get_json_object(props, '$.k')) AS k",
        "(event_id * 7 + user_id) % 45 AS c",
        "explode(if(event_id % 50 = 0, array(1, 2), array(1))) AS arrival",
    )
    return arrivals.selectExpr(*_CLICK_COLUMNS)


def bronze_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign metadata, one campaign for each part."""
    return _table(spark, sf_dir, "part", _PART).selectExpr(*_CAMPAIGN_COLUMNS)


def bronze_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the raw interactions, repeats counted once."""
    events = dedup(bronze_clicks(spark, sf_dir), ["event_id"])
    return sessions_from_events(events, arrival=["event_id"])
