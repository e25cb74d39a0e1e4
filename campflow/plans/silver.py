"""Cleaned datasets. Each function takes a batch or a streaming DataFrame and returns one of the same kind."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from campflow.functions import columns as C
from campflow.operators.dedup import SPREAD, dedup, dedup_within
from campflow.operators.quality import Rule, counted, drop_failed, parse_rule
from campflow.sources.schemas import ACTION_TYPES

CLICK_RULES = (
    Rule("valid_event_id", "event_id IS NOT NULL", drops=True),
    Rule("valid_campaign_id", "campaign_id IS NOT NULL", drops=True),
    Rule("valid_action_type", "action_type IN ({})".format(", ".join(f"'{a}'" for a in ACTION_TYPES))),
)
CAMPAIGN_RULES = (Rule("valid_campaign_id", "campaign_id IS NOT NULL", drops=True),)
SESSION_RULES = (Rule("valid_session_id", "session_id IS NOT NULL", drops=True),)

# Not rules of the datasets but of their raw form: values that become NULL when typed.
CLICK_PARSING = (
    parse_rule("event_timestamp", "try_to_timestamp(event_timestamp)"),
    parse_rule("conversion_value", "try_cast(conversion_value AS decimal(15,2))"),
)
CAMPAIGN_PARSING = (
    parse_rule("campaign_start_date", "try_cast(campaign_start_date AS date)"),
    parse_rule("campaign_end_date", "try_cast(campaign_end_date AS date)"),
    parse_rule("budget_brl", "try_cast(budget_brl AS decimal(15,2))"),
)
SESSION_PARSING = (
    parse_rule("session_start", "try_to_timestamp(session_start)"),
    parse_rule("session_end", "try_to_timestamp(session_end)"),
)


def _screened(df: DataFrame, rules: Sequence[Rule], metrics: Observation | str | None) -> DataFrame:
    # before the deduplication: a bad copy can then never displace a good one, and fewer rows are shuffled
    return drop_failed(df if metrics is None else counted(df, rules, metrics), rules)


def silver_clicks(
    bronze: DataFrame,
    *,
    metrics: Observation | str | None = None,
    order_by: Sequence[str] = (),
    forget_after: str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Typed interactions, one row per event_id, with calendar columns.

    ``order_by`` fixes which of several differing copies is kept (batch). ``forget_after`` bounds the state of a
    stream: an event_id may then come back after that much event time, and events that arrive later than that are
    dropped (:func:`campflow.streaming.late.bounded_dedup` keeps them); without it ids are kept for ever. ``spread``
    is for streams in which single ids come in very many copies (see :func:`dedup`).
    """
    df = C.ensure_columns(bronze, {"conversion_value": C.MONEY, "conversion_product": "string"})
    df = _screened(df, CLICK_RULES, metrics)
    df = C.parse_times(df, timestamps=["event_timestamp"])
    df = C.cast_columns(df, {"response_time_ms": "int", "conversion_value": C.MONEY})
    if forget_after is not None:
        df = dedup_within(df, ["event_id"], "event_timestamp", forget_after, spread)
    else:
        df = dedup(df, ["event_id"], order_by, spread)
    # derived columns come after the shuffle of the deduplication, not through it
    return C.with_calendar(df, "event_timestamp")


def silver_campaigns(
    bronze: DataFrame,
    as_of: dt.date | str | None = None,
    *,
    metrics: Observation | str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Typed campaign metadata. ``as_of`` stands in for today when telling expired campaigns.

    Repeated campaign rows are kept, and multiply in joins, unless ``unique`` asks for the latest of each.
    """
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    df = _screened(bronze, CAMPAIGN_RULES, metrics)
    df = C.parse_times(df, dates=["campaign_start_date", "campaign_end_date"])
    df = C.cast_columns(df, {"budget_brl": C.MONEY}).withColumns(
        {
            "is_expired": F.col("campaign_end_date") < today,
            "duration_days": F.datediff("campaign_end_date", "campaign_start_date"),
        }
    )
    if unique:
        newest = F.max(F.struct("campaign_start_date", *[c for c in df.columns if c != "campaign_start_date"]))
        kept = df.groupBy("campaign_id").agg(newest.alias("_kept"))
        df = kept.select(*[F.col("_kept")[c].alias(c) for c in df.columns])
    return df


def silver_sessions(
    bronze: DataFrame,
    *,
    metrics: Observation | str | None = None,
    order_by: Sequence[str] = (),
    forget_after: str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Typed sessions, one row per session_id, with length and engagement.

    Where sessions arrive in fragments only one of them is kept; see ``merge_session_fragments`` for the whole.
    """
    df = _screened(bronze, SESSION_RULES, metrics)
    df = C.parse_times(df, timestamps=["session_start", "session_end"])
    df = C.cast_columns(df, {"total_events": "int", "total_clicks": "int"})
    if forget_after is not None:
        df = dedup_within(df, ["session_id"], "session_start", forget_after, spread)
    else:
        df = dedup(df, ["session_id"], order_by, spread)
    df = df.withColumn("session_duration_minutes", C.minutes_between("session_start", "session_end"))
    return df.withColumn("engagement_level", C.engagement("total_clicks", "session_duration_minutes"))
