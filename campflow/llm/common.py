"""What the operators share: words, written intermediate tables, free column names."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from campflow.session import work_dir

#: Fixed: a word is a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables that :func:`stage` writes within the block when it ends; those that stay are taken off the list
    that it gives. What is read afterwards must not depend on them."""
    folders: list[str] = []
    _scratch.append(folders)
    try:
        yield folders
    finally:
        _scratch.remove(folders)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def outlast(written: list[str]) -> None:
    """The table written last in this block of :func:`scratch` stays until the block around it ends, if there is one."""
    folder = written.pop()
    if len(_scratch) > 1:
        _scratch[-2].append(folder)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as a table below the shared folder and read again.

    Cuts lineage in a way that a lost executor cannot undo, and tells Spark the size of small tables.
    """
    folder = work_dir(df.sparkSession, purpose)
    if _scratch:
        _scratch[-1].append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """From now on Python workers of the session get so many rows at once, at most.

    A batch is held as Arrow buffers, as Python objects and as results; Spark's default of 10,000 rows makes that
    several hundred megabytes of long texts.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@cache
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def give_back() -> None:
    """Return freed memory to the machine. A Python worker waits for further tasks, and would keep what one task needed
    while others run beside it."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function of Arrow batches, that gives back its memory when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name if ``df`` has such a column (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def utf8_texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8; null is an empty text."""
    for text in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()):
        yield text.as_py() or b""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
