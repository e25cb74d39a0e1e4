"""Writing datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def compact(df: DataFrame, partition_by: Sequence[str] = (), target_files: int | None = None) -> DataFrame:
    """Even out output files before a write.

    Without ``target_files`` the rebalance hint lets AQE merge small and split large shuffle blocks to the
    advisory partition size, also when one partition value holds most of the rows. A fixed file count spreads
    rows round-robin.
    """
    if target_files is not None:
        return df.repartition(target_files)
    return df.hint("rebalance", *partition_by)


def materialize(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    *,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    catalog: bool = False,
) -> DataFrame:
    """Write ``df`` (append or overwrite) and return it as read back from ``target``.

    The target is a folder, or with ``catalog`` the name of a table, which may have a comment and properties. The schema is handed to the reader, so that reading back lists files but infers nothing.
    """
    spark = df.sparkSession
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not catalog:
        if comment or properties:
            raise ValueError("comment and properties need a catalog table")
        writer.save(target)
        return spark.read.format(fmt).schema(df.schema).load(target)
    writer.saveAsTable(target)
    _describe(spark, target, comment, properties or {})
    return spark.table(target)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _describe(spark: SparkSession, table: str, comment: str | None, properties: Mapping[str, str]) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_literal(comment)}")
    if properties:
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
