"""SimHash near-duplicates: fingerprints, multi-index Hamming search, groups.

Two texts are linked if their 64-bit fingerprints differ in at most two bits. Multi-index hashing enumerates, within
each of four 16-bit segments, the ball of values at distance 0 and 1, and looks up who else reaches the same value.
A key is the changed segment together with the three unchanged ones. Both sides enumerate, so two fingerprints at
distance two meet at a value one bit from each, and no bucket can hold more than the 65 fingerprints around its key,
however many near copies the corpus has: tables keyed by a segment alone would fetch the square of such a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campflow.llm.common import free_name, stage, utf8_texts
from campflow.llm.components import components

SEED = 42
SEGMENTS, SEGMENT_BITS = 4, 16
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """A bit is 1 if it is 1 in over half of the shingles' hashes. A-Z are lower-cased; no words give 0."""
    return majority(shingle_hashes(text, shingle_words))


def majority(batches: Iterable[np.ndarray]) -> int:
    """The fingerprint (as a signed long) of batches of hashes, repeats included."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in batches:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def shingle_hashes(text: bytes, shingle_words: int) -> Iterator[np.ndarray]:
    """The hashes of all shingles, in batches; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return
    joined, size = b" ".join(words), min(shingle_words, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    n = len(words) - size + 1
    for at in range(0, n, _AT_ONCE):
        to = min(at + _AT_ONCE, n)
        spans = zip(start[at:to].tolist(), end[at + size - 1 : to + size - 1].tolist())
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed long) of every row of ``docs`` (doc_id, text; null text is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle_words) for text in utf8_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """``a, b``: fingerprints that differ in one or two bits, as stars that connect what the links connect.

    ``prints`` has one column of distinct longs. Around every value that several fingerprints reach, each of them is
    linked to the smallest; every pair within two bits reaches a common value, so no connection is lost.
    """
    own = F.col(prints.columns[0])
    flips = F.array(F.lit(0).cast("long"), *(
        F.shiftleft(F.lit(1).cast("long"), segment * SEGMENT_BITS + bit)
        for segment in range(SEGMENTS) for bit in range(SEGMENT_BITS)
    ))
    probes = prints.select(own.alias("a"), F.explode(flips).alias("flip")).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("key"))
    met = probes.withColumn("b", F.min("a").over(Window.partitionBy("key")))
    return met.filter("a != b and bit_count(a ^ b) <= 2").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``: the group of texts linked to each other.

    ``component_id`` is the smallest doc_id of the group. Null and empty texts have fingerprint zero and are linked
    like any other. Rows that repeat a doc_id appear as often as they come. Rows without a doc_id take part; a group of
    only such rows has no component_id. Other columns are not read.
    """
    prints = stage(fingerprints(docs, shingle_words), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    linked = components(fingerprint_links(nodes.select("fingerprint"))).withColumnRenamed("node", "fingerprint")
    named = nodes.join(linked, "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = stage(named, "groups")
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    group = stage(named.join(first, "root").select("fingerprint", "component_id"), "group_of")
    return prints.join(group, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
