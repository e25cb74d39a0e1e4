"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campflow.llm.common import WORD, free_name, stage

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MAX_EPOCHS = 2
SEED = "mix"
#: Hex digits of the draw that make a bucket: 256 sums per source lead to the one bucket that is looked into.
_BUCKET_DIGITS = 2


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str = SEED) -> F.Column:
    """32 hex digits that depend on nothing but the seed and the doc_id, or the text where that is null."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), "text"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), own))


def water_fill(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
               max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources: ``totals`` (source, source_size) with ``target``.

    Sources in code-point order, null last, weigh ``weights``, repeating. They share ``share`` of all sizes by weight;
    none gets more than ``max_epochs`` times its size, and the excess is shared again by weight until none is above.
    Clamping raises the rate of the rest, so sources are clamped in the order of cap over weight: one pass over the
    sources in that order finds the last clamped one. If all caps together are less than the share, all are clamped.
    The sources, not the documents, are ordered in one task.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.row_number().over(order) - 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    # cap / weight ascending, compared as whole numbers
    base = 1
    for w in set(weights):
        base *= w
    by_rate = Window.orderBy(F.expr(f"cap * {base} div weight"), F.col("source").isNull(), "source")
    before, everyone = by_rate.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = weighed.select(
        "source", "source_size", "weight", "cap",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
        (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open_weight"),
        (F.sum("source_size").over(everyone) * share.numerator).alias("budget"),
    )
    over = F.expr(f"(budget - {share.denominator} * capped) * double(weight) > {share.denominator} * cap * double(open_weight)")
    filled = filled.withColumn("clamped", over)
    # the first source in this order that is not above its cap shows the rate of all after it
    rest = F.first(F.when(~F.col("clamped"), F.struct(
        F.expr(f"budget - {share.denominator} * capped").alias("rest"), F.col("open_weight"))), ignorenulls=True)
    filled = filled.withColumn("open", rest.over(by_rate.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        (F.col("open.rest") * F.col("weight")).cast("double") / (F.col("open.open_weight") * share.denominator)
    )
    return filled.select("source", "source_size", target.alias("target"))


def _rates(docs: DataFrame, seed: str, weights: tuple[int, ...], share: Fraction, max_epochs: int) -> DataFrame:
    """``of, source_size, target, whole, last``: a source's whole repetitions, and the last draw that is taken again."""
    sized = stage(docs.select("doc_id", F.col("source").alias("source"), word_count().alias("size"), draw(seed).alias("draw")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(water_fill(totals, weights, share, max_epochs), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))

    bucket = F.substring("draw", 1, _BUCKET_DIGITS)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("size").over(upto) - F.col("size"))
    need = plan.filter("extra > 0").select(F.col("source").alias("of"), "extra")
    # the last bucket that begins below what is needed; the cut lies in it
    edge = (
        sums.join(need, F.col("source").eqNullSafe(F.col("of"))).filter("before < extra")
        .groupBy("of", "extra").agg(F.max("bucket").alias("edge"), F.max("before").alias("before"))
    )
    edge = stage(edge, "edges")
    inside = (
        sized.withColumn("bucket", bucket)
        .join(edge, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("edge")))
        .groupBy("of", "extra", "before", "draw").agg(F.sum("size").alias("size"))
    )
    here = F.sum("size").over(Window.partitionBy("of").orderBy("draw")) - F.col("size") + F.col("before")
    taken = inside.withColumn("here", here).filter("here + size / 2D <= extra")
    cuts = taken.groupBy("of").agg(F.max("draw").alias("last"))
    last = edge.join(cuts.withColumnRenamed("of", "of_"), F.col("of").eqNullSafe(F.col("of_")), "left").select(
        "of", F.coalesce("last", "edge").alias("last")
    )
    last = last.withColumnRenamed("of", "of_")
    rates = plan.join(last, F.col("source").eqNullSafe(F.col("of_")), "left")
    return stage(rates.select(F.col("source").alias("of"), "source_size", "target", "whole", "last"), "rates")


def mix(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix takes each document.

    ``size`` is the number of words (null text: 0). A source whose target is r times its size takes every document
    floor(r) times; the fraction that is left takes documents once more in the order of a seeded draw, up to the
    document that comes nearest to the target. The draw depends on the doc_id alone, so reruns agree, and rows that
    repeat a doc_id are taken alike; without a doc_id it depends on the text. The place where the extra copies end is
    found from sums of 256 buckets of the draw per source, and then inside one bucket, so that a source of any size is
    no single task's work. Null is a source of its own. An empty table gives an empty result. Extra columns are
    carried; those with the name of a new column are replaced.
    """
    rates = _rates(docs, seed, weights, share, max_epochs)
    inner = {name: free_name(docs, f"_{name}") for name in rates.columns}
    out = docs.join(rates.withColumnsRenamed(inner), F.col("source").eqNullSafe(F.col(inner["of"])))
    copies = F.col(inner["whole"]) + F.when(draw(seed) <= F.col(inner["last"]), 1).otherwise(0)
    new = {"size": word_count(), "source_size": F.col(inner["source_size"]), "target": F.col(inner["target"])}
    return out.withColumns(new | {"copies": copies}).drop(*inner.values())


def mixed(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
          max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mix` takes it, with the columns of ``docs``."""
    rates = _rates(docs, seed, weights, share, max_epochs)
    inner = {name: free_name(docs, f"_{name}") for name in rates.columns}
    out = docs.join(rates.withColumnsRenamed(inner), F.col("source").eqNullSafe(F.col(inner["of"])))
    copies = F.col(inner["whole"]) + F.when(draw(seed) <= F.col(inner["last"]), 1).otherwise(0)
    again = F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int"))))
    return out.withColumn(inner["whole"], again).select(*docs.columns)
