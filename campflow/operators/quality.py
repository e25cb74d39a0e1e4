"""Named row rules: drop or warn, counted while the rows pass through."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A condition that rows should meet. A NULL outcome counts as a failure."""

    name: str
    condition: str
    drops: bool = False

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))

    def failed(self) -> Column:
        return ~self.passed()


def drop_failed(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Keep the rows that meet every dropping rule; warnings drop nothing."""
    for rule in rules:
        if rule.drops:
            df = df.filter(F.expr(rule.condition))
    return df


def counted(df: DataFrame, rules: Iterable[Rule], into: Observation | str) -> DataFrame:
    """Count rows and failures per rule as a side effect of the next action, without another pass.

    Give an ``Observation`` to a batch and a name to a stream (a query listener reports it per micro-batch).
    Filters above the counter cannot move below it, so use this where the dataset is written, not in ad-hoc reads.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(rule.failed()).alias(rule.name) for rule in rules]
    return df.observe(into, *metrics)


def expect(df: DataFrame, name: str, condition: str, into: Observation | str) -> DataFrame:
    """Count the rows that miss the condition, keep all of them."""
    return counted(df, [Rule(name, condition)], into)


def expect_or_drop(df: DataFrame, name: str, condition: str, into: Observation | str | None = None) -> DataFrame:
    """Drop the rows that miss the condition, counting them first when asked to."""
    rule = Rule(name, condition, drops=True)
    return drop_failed(df if into is None else counted(df, [rule], into), [rule])


def parse_rule(column: str, parsed: str) -> Rule:
    """Warns of values that ``parsed``, an expression over the column, turns into NULL."""
    return Rule(f"readable_{column}", f"{column} IS NULL OR {parsed} IS NOT NULL")


def uniqueness_report(df: DataFrame, keys: Sequence[str], dataset: str) -> DataFrame:
    """The report row of a rule that a key occurs once; all rows of a repeated key fail."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.selectExpr("n", "n > 1 AS repeated").agg(
        F.lit(dataset).alias("dataset"),
        F.lit("unique_" + "_".join(keys)).alias("rule"),
        F.lit("warn").alias("action"),
        F.expr("coalesce(sum(n) FILTER (WHERE NOT repeated), 0L)").alias("passed"),
        F.expr("coalesce(sum(n) FILTER (WHERE repeated), 0L)").alias("failed"),
        F.lit(0).cast("bigint").alias("dropped"),
    )


def quality_report(df: DataFrame, rules: Iterable[Rule], dataset: str) -> DataFrame:
    """One row per rule (dataset, rule, action, passed, failed, dropped), from a single pass over ``df``."""
    rules = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(rule.failed()).alias(f"failed_{i}") for i, rule in enumerate(rules)],
    )
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("rule"),
            F.lit("drop" if rule.drops else "warn").alias("action"),
            (F.col("rows") - F.col(f"failed_{i}")).alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col(f"failed_{i}") if rule.drops else F.lit(0).cast("bigint")).alias("dropped"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))
