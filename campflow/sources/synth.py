"""Generated interactions, campaigns and sessions.

Every value is drawn from a hash of (seed, row number, name of the draw), so a row is the same however the work is
split, and a recomputed task repeats itself. Draws are whole numbers below 2**32: MD5 yields four of them per
call, and any SQL engine can recompute them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campflow.sources.schemas import AB_GROUPS, ACTION_TYPES, BRONZE_CAMPAIGNS, BRONZE_CLICKS, CATEGORIES, CHANNELS
from campflow.sources.schemas import DEVICE_SYSTEMS, SEGMENTS

# Relative weights, in the order of the values they belong to.
ACTION_WEIGHTS = (35, 22, 15, 10, 10, 8)
DEVICE_WEIGHTS = (45, 55)
HOUR_WEIGHTS = (1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 5, 4, 4, 5, 5, 5, 6, 7, 8, 9, 9, 7, 4, 2)
PERSONALIZED_PERCENT = 65
RESPONSE_MS = (50, 800)
DAYS_BACK = 6
# Least and largest conversion value by category; other categories convert at no value.
CONVERSION_RANGE = {"credito": (5000, 50000), "investimentos": (1000, 100000), "seguros": (800, 5000)}
APP_VERSIONS = tuple(f"1.{n}" for n in range(5))
ELEMENTS = tuple(f"element {n}" for n in range(5))
SCREENS = 10
REGIONS = 10
CITIES_PER_REGION = 3
OFFERS = 5


class _Draws:
    """Whole-number draws for the row numbered ``number``."""

    def __init__(self, number: str, seed: int, topic: str) -> None:
        self._number, self._prefix, self._topic = number, f"{seed}:{topic}:", topic

    def digests(self, draws: int) -> list[Column]:
        """The hashes behind the first ``draws`` draws, as columns to be selected before drawing from them."""
        text = f"'{self._prefix}', {self._number}, ':'"
        return [F.expr(f"md5(binary(concat({text}, {i})))").alias(self._column(i)) for i in range((draws + 3) // 4)]

    def _column(self, group: int) -> str:
        return f"_{self._topic}_{group}"

    def word(self, draw: int) -> Column:
        """Draw number ``draw``: eight hex digits of the hash of its group of four."""
        return F.expr(f"bigint(conv(substr({self._column(draw // 4)}, {1 + 8 * (draw % 4)}, 8), 16, 10))")

    def below(self, draw: int, n: int) -> Column:
        return self.word(draw) % n

    def between(self, draw: int, low: int, high: int) -> Column:
        return self.below(draw, high - low + 1) + low


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _weighted(draw: Column, weights: tuple[int, ...], values: tuple[object, ...]) -> Column:
    """The value that ``draw`` (below the sum of the weights) falls on, each spread as wide as its weight.

    A lookup, not a chain of comparisons: each comparison would compute the draw anew.
    """
    spread = [repr(value) for value, weight in zip(values, weights) for _ in range(weight)]
    return F.element_at(F.expr(f"array({', '.join(spread)})"), (draw + 1).cast("int"))


def _coded(prefix: str, index: Column, width: int) -> Column:
    # never narrower than the number itself: lpad would cut it
    text = index.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def _campaign(index: Column) -> dict[str, Column]:
    """Attributes of a campaign, from its index alone: interactions and metadata agree without a join."""
    return {
        "campaign_id": _coded("CMP-", index, 6),
        "campaign_name": F.concat(F.lit("Campaign "), index.cast("string")),
        "campaign_channel": _pick(index % len(CHANNELS), CHANNELS),
        "campaign_category": _pick(index % len(CATEGORIES), CATEGORIES),
    }


def _with_session(df: DataFrame, index: str, seed: int) -> DataFrame:
    """Add the attributes of the session of the pool numbered ``index``, from that number alone."""
    draws = _Draws(index, seed, "session")
    hashed = df.select("*", *draws.digests(6))
    region = draws.below(0, REGIONS).cast("string")
    return hashed.select(
        *df.columns,
        _coded("SESS-", F.col(index), 12).alias("session_id"),
        F.concat(F.lit("CUST-"), draws.between(1, 100000, 999999).cast("string")).alias("customer_id"),
        _coded("DEV-", draws.word(2), 10).alias("device_id"),
        _weighted(draws.below(3, sum(DEVICE_WEIGHTS)), DEVICE_WEIGHTS, DEVICE_SYSTEMS).alias("device_os"),
        _pick(draws.below(4, len(APP_VERSIONS)), APP_VERSIONS).alias("app_version"),
        F.concat(F.lit("Region "), region).alias("geo_region"),
        F.concat(F.lit("City "), region, F.lit("-"), draws.below(5, CITIES_PER_REGION).cast("string")).alias(
            "geo_city"
        ),
    )


def _conversion_cents(category: Column, word: Column) -> Column:
    value = F.lit(0).cast("bigint")
    for name, (low, high) in CONVERSION_RANGE.items():
        value = F.when(category == name, word % ((high - low) * 100 + 1) + low * 100).otherwise(value)
    return value


def clicks_of(
    df: DataFrame,
    number: str,
    *,
    seed: int = 0,
    base: dt.datetime | None = None,
    campaigns: int = 12,
    sessions: int = 50_000,
) -> DataFrame:
    """One raw interaction for each row of ``df`` (batch or stream), a function of the row's ``number``."""
    base = base or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    draws = _Draws("_n", seed, "click")
    numbered = df.select(F.col(number).cast("bigint").alias("_n"))
    drawn = numbered.select("_n", *draws.digests(14)).select(
        "_n",
        draws.below(0, campaigns).alias("_campaign"),
        draws.below(1, sessions).alias("_session"),
        _weighted(draws.below(2, sum(ACTION_WEIGHTS)), ACTION_WEIGHTS, ACTION_TYPES).alias("action_type"),
        _weighted(draws.below(3, sum(HOUR_WEIGHTS)), HOUR_WEIGHTS, tuple(range(24))).alias("_hour"),
        draws.below(4, 3600).alias("_second"),
        draws.below(5, DAYS_BACK + 1).alias("_days"),
        draws.below(6, SCREENS).alias("_screen"),
        draws.below(7, SCREENS - 1).alias("_referrer"),
        _pick(draws.below(8, len(ELEMENTS)), ELEMENTS).alias("_element"),
        (draws.below(9, 100) < PERSONALIZED_PERCENT).alias("is_personalized"),
        _pick(draws.below(10, len(AB_GROUPS)), AB_GROUPS).alias("ab_test_group"),
        draws.between(11, *RESPONSE_MS).cast("int").alias("response_time_ms"),
        draws.word(12).alias("_value"),
        draws.between(13, 1, OFFERS).alias("_offer"),
    )
    campaign = _campaign(F.col("_campaign"))
    day = F.date_sub(F.lit(base.date().isoformat()).cast("date"), F.col("_days").cast("int"))
    minute, second = F.floor(F.col("_second") / 60), F.col("_second") % 60
    time = F.concat(_coded("T", F.col("_hour"), 2), _coded(":", minute, 2), _coded(":", second, 2))
    converted = F.col("action_type") == "conversion"
    cents = _conversion_cents(campaign["campaign_category"], F.col("_value"))
    columns = {
        **campaign,
        "event_id": _coded("EVT-", F.col("_n"), 16),
        "event_timestamp": F.concat(day.cast("string"), time),
        "offer_id": F.concat(_coded("OFR-", F.col("_campaign"), 6), _coded("-", F.col("_offer"), 3)),
        "action_element": F.when(F.col("action_type").isin("click", "deep_link", "conversion"), F.col("_element")),
        "screen_name": F.concat(F.lit("screen "), F.col("_screen").cast("string")),
        # a step of 1 to 9 around the ring of screens never ends on the screen itself
        "referrer_screen": F.concat(
            F.lit("screen "), ((F.col("_screen") + 1 + F.col("_referrer")) % SCREENS).cast("string")
        ),
        "conversion_value": F.when(converted, cents / 100).otherwise(F.lit(0.0)),
        "conversion_product": F.when(
            converted, F.concat(F.lit("Product "), campaign["campaign_category"])
        ).otherwise(F.lit("")),
    }
    placed = _with_session(drawn, "_session", seed)
    return placed.select(*[columns.get(f.name, F.col(f.name)).alias(f.name) for f in BRONZE_CLICKS.fields])


def synth_clicks(spark: SparkSession, n: int, partitions: int | None = None, **shape: object) -> DataFrame:
    """``n`` raw interactions, generated by the executors."""
    numbers = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return clicks_of(numbers, "id", **shape)


def synth_campaigns(spark: SparkSession, n: int = 12, seed: int = 0, base_date: dt.date | None = None) -> DataFrame:
    """Metadata of ``n`` campaigns: begun 10 to 60 days ago, 30 to 90 days long."""
    base_date = base_date or dt.datetime.now(dt.timezone.utc).date()
    draws = _Draws("id", seed, "campaign")
    today = F.lit(base_date.isoformat()).cast("date")
    start = F.date_sub(today, draws.between(0, 10, 60).cast("int"))
    end = F.date_add(start, draws.between(1, 30, 90).cast("int"))
    attributes = _campaign(F.col("id"))
    segment = _pick(draws.below(2, len(SEGMENTS)), SEGMENTS)
    columns = {
        **attributes,
        "campaign_description": F.concat(attributes["campaign_name"], F.lit(" for segment "), segment),
        "campaign_start_date": start.cast("string"),
        "campaign_end_date": end.cast("string"),
        "target_segment": segment,
        "budget_brl": (draws.between(3, 45, 300) * 1000).cast("double"),
        "is_active": end >= today,
        "created_by": F.concat(F.lit("team "), draws.below(4, 3).cast("string")),
    }
    hashed = spark.range(n).select("id", *draws.digests(5))
    return hashed.select(*[columns[f.name].alias(f.name) for f in BRONZE_CAMPAIGNS.fields])


def synth_sessions(spark: SparkSession, n: int = 50_000, seed: int = 0) -> DataFrame:
    """The pool that interactions pick their sessions from: fixed attributes, no events yet."""
    return _with_session(spark.range(n), "id", seed).drop("id")
