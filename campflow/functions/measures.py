"""The measures of every gold table, as SQL expressions.

All counts and sums are additive, so they can be taken from events or re-taken from any finer table; ratios are
always computed last, from sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of raw interactions. Rows without an action count as events only; unused sums are pruned by the optimizer.
# The conversion value is NULL, not 0, where there is no conversion.
EVENT_SUMS = {
    "impressions": "count_if(action_type = 'impression')",
    "clicks": "count_if(action_type = 'click')",
    "conversions": "count_if(action_type = 'conversion')",
    "dismisses": "count_if(action_type = 'dismiss')",
    "deep_links": "count_if(action_type = 'deep_link')",
    "conversion_value": "sum(CASE WHEN action_type = 'conversion' THEN conversion_value END)",
    "response_time_ms": "sum(response_time_ms)",
    "events": "count(1)",
}
# Of rows that already hold the sums; the types stay what they were.
CELL_SUMS = {name: f"sum({name})" for name in EVENT_SUMS}
CELL_SUMS["conversion_value"] = "cast(sum(conversion_value) AS decimal(25,2))"


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in expressions.items()]


def sums_of_events() -> list[Column]:
    return _named(EVENT_SUMS)


def totals(df: DataFrame, *keys: str) -> DataFrame:
    """Group events or cells by ``keys``: partial sums before the shuffle, one row per key and task through it."""
    is_cells = set(EVENT_SUMS) <= set(df.columns)
    return df.groupBy(*keys).agg(*_named(CELL_SUMS if is_cells else EVENT_SUMS))


def percent(part: str, whole: str) -> str:
    """part / whole * 100 in double arithmetic, to 2 places; 0 when the whole is 0."""
    return f"CASE WHEN {whole} > 0 THEN round({part} / {whole} * 100, 2) ELSE 0D END"


def mean_over_rows(total: str, rows: str) -> str:
    """total / rows to 2 places. The divisor counts every row, also those whose value is NULL."""
    return f"CASE WHEN {rows} > 0 THEN round({total} / {rows}, 2) ELSE 0D END"


def cost_per(budget: str, count: str) -> str:
    """budget / count to 2 places, NULL when the count is 0 or the budget unknown."""
    return f"CASE WHEN {count} > 0 THEN round({budget} / {count}, 2) END"


def exact_ratio(part: str, whole: str, factor: int, places: int) -> str:
    """part * factor / whole, rounded half away from zero to ``places``, 0 unless the whole is positive.

    Whole-number arithmetic: a decimal quotient would already be rounded once before the final rounding.
    """
    doubled = 2 * factor * 10**places
    rounded = f"cast(signum({part}) AS bigint) * ((abs({part}) * {doubled} + {whole}) div (2 * {whole}))"
    kind = f"decimal(20,{places})"
    value = f"cast(cast({rounded} AS decimal(20,0)) / {10**places} AS {kind})"
    return f"CASE WHEN {whole} > 0 THEN {value} ELSE cast(0 AS {kind}) END"
