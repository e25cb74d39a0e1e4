"""Tables that change together, a batch at a time, by whole partitions.

Plain files have no row updates. A batch reads the partitions that its rows touch, and no others, merges its rows into
them, and puts new files in their place (dynamic partition overwrite). Several tables below one folder form a store and
move on together; what one batch does is prepared first and then published::

    tables/NAME/COLUMN=VALUE     the current rows
    feeds/NAME/version=V         the images of the rows that batch V changed
    pending/V                    what batch V has prepared; that of the last batch stays

Nothing that readers see changes before all of a batch is prepared, and publishing reads the prepared files only. So a
batch that fails while it prepares starts again, and one that fails while it publishes is published again by whoever
comes next; both give the same tables. A batch is known by its run (the id in a query's checkpoint) and its number: a
batch that is delivered twice is applied once, and a query that starts again with a new checkpoint begins a new run
that writes over the rows of the old one. Versions count the batches of all runs. A store has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campflow.operators.changes import CHANGE_TYPE
from campflow.sources.sinks import compact

VERSION = "version"
BUCKET = "_bucket"
_ROW_VERSION = "_version"
_KINDS = {"insert": (None, "new"), "delete": ("old", None), "update": ("old", "new")}


class Files:
    """The few questions and moves that concern folders as such, on whatever file system a path names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._path = spark, spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        """All of the text or nothing."""
        out = self._fs.create(self._path(f"{path}.new"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.rename(self._path(f"{path}.new"), self._path(path))

    def read(self, path: str) -> str:
        return self._spark.read.text(path, wholetext=True).first()[0]


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "money": T.DecimalType(25, 2),
}


def columns(**kinds: str) -> T.StructType:
    """A schema by name, for tables that are declared before there is a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in kinds.items()])


@dataclass(frozen=True, eq=False)
class Table:
    """One row per ``keys`` and partition, stored by the column ``by``, or by a hash of the keys in ``buckets``.

    Choose ``by`` so that a batch touches few of its values. ``schema`` names all columns; NULL keys form a key.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    by: str | None = None
    buckets: int = 1

    @property
    def partition(self) -> str:
        return self.by or BUCKET

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.keys and c != self.by]

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the column that the table is stored by."""
        if self.by:
            return df
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    @property
    def stored_schema(self) -> T.StructType:
        fields = [f for f in self.schema.fields if f.name != self.by]
        kind = self.schema[self.by].dataType if self.by else T.IntegerType()
        return T.StructType([*fields, T.StructField(_ROW_VERSION, T.LongType()), T.StructField(self.partition, kind)])


def within(column: str, values: Sequence[object]) -> Column:
    """Rows of one of ``values``, NULL among them: a filter that leaves out all other partitions."""
    known = [v for v in values if v is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if len(known) < len(values) else found


class Store:
    """The tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root, Files(spark, root)

    def _stored(self, table: Table) -> DataFrame:
        path = f"{self.root}/tables/{table.name}"
        if not self.files.exists(path):
            return self.spark.createDataFrame([], table.stored_schema)
        return self.spark.read.schema(table.stored_schema).parquet(path)

    def read(self, table: Table, with_version: bool = False) -> DataFrame:
        """The current rows; ``with_version`` adds the batch that last wrote each (``version``).

        A reader that a batch overtakes can find files gone, and has to read again.
        """
        rows = self._stored(table)
        extra = [F.col(_ROW_VERSION).alias(VERSION)] if with_version else []
        return rows.select(*table.schema.names, *extra)

    def feed(self, table: Table, streaming: bool = False) -> DataFrame:
        """The images of all changed rows, with ``_change_type`` and ``version``; also as a stream that follows them."""
        fields = [*table.schema.fields, T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(VERSION, T.LongType())]
        reader = self.spark.readStream if streaming else self.spark.read
        return reader.schema(T.StructType(fields)).parquet(f"{self.root}/feeds/{table.name}")

    def holds(self, table: Table, partitions: Sequence[object]) -> bool:
        """Whether any of the ``partitions`` is stored."""
        stored = set(self.files.names(f"{self.root}/tables/{table.name}"))
        return any(_folder(table.partition, value) in stored for value in partitions)

    def expire_feeds(self, keep: int) -> None:
        """Delete the images of all but the newest ``keep`` versions of each feed."""
        for name in self.files.names(f"{self.root}/feeds"):
            versions = sorted((n for n in self.files.names(f"{self.root}/feeds/{name}") if "=" in n), key=lambda n: int(n.split("=")[1]))
            for old in versions[: max(0, len(versions) - keep)]:
                self.files.delete(f"{self.root}/feeds/{name}/{old}")

    def version(self) -> int:
        """The number of batches that were applied."""
        self._recover()
        return max(self._pending(), default=0)

    def apply(self, run: str, batch_id: int, prepare: Callable[[Batch], None]) -> bool:
        """Apply one batch: ``prepare`` says what becomes of each table. False if it was applied before."""
        last = self._recover()
        if last and (last["run"], last["batch"]) == (run, batch_id):
            return False
        newest = max(self._pending(), default=0)
        batch = Batch(self, newest + 1)
        self.files.delete(batch.folder)  # of an attempt that did not get ready
        prepare(batch)
        self.files.write(f"{batch.folder}/ready", json.dumps({"run": run, "batch": batch_id, "steps": batch.steps}))
        self._publish(newest + 1, batch.steps)
        return True

    def _pending(self) -> list[int]:
        """The versions that are ready."""
        found = [int(n) for n in self.files.names(f"{self.root}/pending") if n.isdigit()]
        return [v for v in found if self.files.exists(f"{self.root}/pending/{v}/ready")]

    def _recover(self) -> dict | None:
        """What the last batch that got ready was, published now if its writer did not get that far."""
        newest = max(self._pending(), default=0)
        if not newest:
            return None
        folder = f"{self.root}/pending/{newest}"
        known = json.loads(self.files.read(f"{folder}/ready"))
        if not self.files.exists(f"{folder}/done"):
            self._publish(newest, known["steps"])
        return known

    def _publish(self, version: int, steps: Sequence[Mapping]) -> None:
        with ThreadPoolExecutor(max(1, len(steps))) as pool:
            list(pool.map(lambda step: self._publish_one(version, step), steps))
        folder = f"{self.root}/pending"
        self.files.write(f"{folder}/{version}/done", "")
        for name in self.files.names(folder):
            if name != str(version):
                self.files.delete(f"{folder}/{name}")

    def _publish_one(self, version: int, step: Mapping) -> None:
        name, partition = step["table"], step["partition"]
        prepared = self.spark.read.schema(T.StructType.fromJson(step["schema"])).parquet(f"{self.root}/pending/{version}/{name}")
        rows = prepared.filter("new IS NOT NULL").select(*step["keys"], "new.*", partition)
        target = f"{self.root}/tables/{name}"
        dealt = rows.coalesce(1) if step["one"] else compact(rows, [partition])
        sorted_rows = dealt.sortWithinPartitions(partition, *step["keys"])
        sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target)
        for folder in step["gone"]:
            self.files.delete(f"{target}/{folder}")
        if step["feed"]:
            out = f"{self.root}/feeds/{name}/{VERSION}={version}"
            if not self.files.exists(f"{out}/_SUCCESS"):  # files that a stream may have read already stay as they are
                _images(prepared, step["columns"], [*step["keys"], partition]).write.mode("overwrite").parquet(out)


def _changed() -> Column:
    """Whether a prepared row differs from the stored one; the version a row was written by does not count."""
    bare = [F.col(side).dropFields(_ROW_VERSION) for side in ("old", "new")]
    return ~bare[0].eqNullSafe(bare[1])


def _images(prepared: DataFrame, columns: Sequence[str], outside: Sequence[str]) -> DataFrame:
    """The feed of prepared rows: what was, and what is."""

    def entry(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    entries = (
        F.when(F.col("old").isNull(), F.array(entry("insert", "new")))
        .when(F.col("new").isNull(), F.array(entry("delete", "old")))
        .otherwise(F.array(entry("update_preimage", "old"), entry("update_postimage", "new")))
    )
    rows = prepared.filter(_changed()).select(*dict.fromkeys(outside), F.explode(entries).alias("_e"))
    picked = [F.col(c) if c in outside else F.col("_e.row")[c].alias(c) for c in columns]
    return rows.select(*picked, F.col("_e.kind").alias(CHANGE_TYPE))


@dataclass
class Batch:
    """One batch of a store while it is prepared."""

    store: Store
    version: int
    steps: list[dict] = field(default_factory=list)

    @property
    def folder(self) -> str:
        return f"{self.store.root}/pending/{self.version}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written beside what is prepared, and read again: a micro-batch is computed once."""
        path = f"{self.folder}/work-{name}"
        df.write.mode("overwrite").parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def merge(
        self,
        table: Table,
        changes: DataFrame,
        *,
        combine: Mapping[str, Column] | None = None,
        keep_row: Column | None = None,
        touched: Sequence[object] | None = None,
        whole: bool = False,
        feed: bool = True,
        unique: bool = False,
    ) -> DataFrame:
        """Merge ``changes``, one row per key, into ``table``; returns ``keys, old, new`` of the partitions touched.

        A row of ``changes`` replaces the stored one. With ``combine`` its columns are made of ``old`` and ``change``
        (structs of the value columns, either of them NULL where there is no such row). Rows for which ``keep_row`` (over
        ``new``) is not true are deleted. ``touched`` names the partitions where the caller knows them (more do no harm);
        with ``whole`` the changes are all rows of those partitions, and stored rows without one are deleted. Two rows
        for a key fail the batch. Where the caller knows that ``changes`` have one per key (``unique``) and no touched
        partition is stored, there is nothing to bring together, and the rows are not shuffled.
        """
        store, keys, partition = self.store, list(table.keys), table.partition
        outside = list(dict.fromkeys([*keys, partition]))
        placed = table.placed(changes)
        if touched is None and not table.by and table.buckets == 1:
            touched = [0]
        if touched is None:  # as many as a batch touches: days, or buckets
            touched = [row[0] for row in placed.select(partition).distinct().collect()]
        stored = store._stored(table).filter(within(partition, touched))
        old_row = F.struct(*table.values, _ROW_VERSION)
        sides = stored.select(*outside, old_row.alias("old"), F.lit(None).cast(_kind(placed, table.values)).alias("change"))
        news = placed.select(*outside, F.lit(None).cast(_kind(stored, [*table.values, _ROW_VERSION])).alias("old"),
                             F.struct(*table.values).alias("change"))
        grouped = news
        if not unique or store.holds(table, touched):
            grouped = sides.unionByName(news).groupBy(*outside).agg(
                F.first("old", ignorenulls=True).alias("old"), F.first("change", ignorenulls=True).alias("change"),
                F.count_if(F.col("change").isNotNull()).alias("_n"),
            )
            message = F.concat(F.lit("more than one row for key "), F.to_json(F.struct(*keys)))
            grouped = grouped.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        kinds = {f.name: f.dataType for f in table.schema.fields}
        made = [((combine or {}).get(c, F.col(f"change.{c}"))).cast(kinds[c]).alias(c) for c in table.values]
        merged = F.when(F.col("change").isNotNull(), F.struct(*made, F.lit(self.version).cast("long").alias(_ROW_VERSION)))
        if not whole:
            merged = merged.otherwise(F.col("old"))
        images = grouped.select(*outside, "old", merged.alias("new"))
        if keep_row is not None:
            images = images.withColumn("new", F.when(keep_row, F.col("new")))
        path = f"{self.folder}/{table.name}"
        images.write.mode("overwrite").parquet(path)
        images = store.spark.read.schema(images.schema).parquet(path)
        gone = []
        if keep_row is not None or whole:
            left = [row[0] for row in images.filter("new IS NOT NULL").select(partition).distinct().collect()]
            gone = [_folder(partition, value) for value in touched if value not in left]
        self.steps.append({
            "table": table.name, "partition": partition, "keys": [k for k in keys if k != partition], "schema": images.schema.jsonValue(),
            "columns": table.schema.names, "gone": gone, "feed": feed,
            "one": not table.by and table.buckets == 1,
        })
        return images

    def drop_partitions(self, table: Table, folders: Sequence[str]) -> None:
        """Delete whole partitions when the batch is published; the table must be merged in this batch."""
        next(s for s in self.steps if s["table"] == table.name)["gone"] += list(folders)


def changed_rows(images: DataFrame) -> DataFrame:
    """The prepared rows that differ from the stored ones."""
    return images.filter(_changed())


def _kind(df: DataFrame, columns: Sequence[str]) -> T.DataType:
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType


def _folder(partition: str, value: object) -> str:
    return f"{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def run_of(batch: DataFrame) -> str:
    """The id that the checkpoint of the running query holds."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
