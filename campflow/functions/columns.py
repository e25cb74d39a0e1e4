"""Row-wise typing and enrichment. Everything is a built-in expression, so it stays in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the named columns that ``df`` lacks, as typed NULLs (older files have fewer columns)."""
    present = set(df.columns)
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in present}
    return df.withColumns(missing) if missing else df


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes NULL and the job goes on."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def parse_times(df: DataFrame, timestamps: Iterable[str] = (), dates: Iterable[str] = ()) -> DataFrame:
    """Parse ISO-8601 strings; a malformed string becomes NULL."""
    parsed = {name: F.try_to_timestamp(F.col(name)) for name in timestamps}
    parsed |= {name: F.col(name).try_cast("date") for name in dates}
    return df.withColumns(parsed)


def business_hours(moment: str) -> str:
    """From 09:00:00 to 18:59:59, Monday to Friday."""
    return f"hour({moment}) BETWEEN 9 AND 18 AND dayofweek({moment}) BETWEEN 2 AND 6"


def with_calendar(df: DataFrame, moment: str) -> DataFrame:
    """Add the calendar columns of a timestamp (day_of_week: 1 is Sunday)."""
    return df.selectExpr(
        "*",
        f"to_date({moment}) AS event_date",
        f"hour({moment}) AS hour_of_day",
        f"dayofweek({moment}) AS day_of_week",
        f"{business_hours(moment)} AS is_business_hours",
    )


def minutes_between(start: str, end: str) -> Column:
    """Minutes between two timestamps, each cut to whole seconds first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def engagement(clicks: str, minutes: str) -> Column:
    """high / medium / low, by clicks and length; an unknown length is low."""
    # Least clicks and least minutes of each level.
    return (
        F.when((F.col(clicks) >= 5) & (F.col(minutes) >= 10), "high")
        .when((F.col(clicks) >= 2) & (F.col(minutes) >= 3), "medium")
        .otherwise("low")
    )


def json_safe(df: DataFrame) -> DataFrame:
    """Dates and times as ISO strings, numbers and booleans as doubles, anything else unchanged."""

    def convert(name: str, kind: str) -> Column:
        col = F.col(f"`{name}`")
        if kind == "date":
            return F.date_format(col, "yyyy-MM-dd")
        if kind in ("timestamp", "timestamp_ntz"):
            # the fraction is shown only when there is one
            fraction = F.date_format(col, "SSSSSS")
            seconds = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
            return F.when(fraction == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), fraction))
        if kind == "boolean" or kind in _NUMBERS or kind.startswith("decimal"):
            return col.cast("double")
        return col

    return df.select(*[convert(name, kind).alias(name) for name, kind in df.dtypes])


_NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double"}
