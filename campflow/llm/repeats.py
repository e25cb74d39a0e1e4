"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: every byte shifts it left by one bit and adds a fixed random number,
so it depends on the last sixteen bytes only. A place is a cut where the hash falls below a bound; the ends of the text
are cuts too. A chunk begins at every cut and ends at the first cut that is at least ``MIN_BYTES`` further. Cuts depend
on nothing but the bytes before them, so an insertion moves chunks without changing them, and a passage that two
documents share holds the same chunks in both, but for its first bytes. A text shorter than that is one chunk. Chunks are
compared by digest and length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.llm.common import free_name, utf8_texts

MIN_BYTES, EVERY, WINDOW = 96, 24, 16
_GEAR = np.random.default_rng(1).integers(0, 1 << WINDOW, 256, dtype=np.uint16)
_CHUNK = "doc_id long, crc long, at int, length int, digest long"


def cuts(text: bytes) -> np.ndarray:
    """The cuts of a text, its ends included."""
    rolled = _GEAR[np.frombuffer(text, np.uint8)]
    span = 1
    while span < WINDOW:  # from hashes over ``span`` bytes to hashes over twice as many
        rolled[span:] += rolled[:-span] << np.uint16(span)
        span *= 2
    places = np.flatnonzero(rolled < (1 << WINDOW) // EVERY) + 1
    places = places[(places > WINDOW) & (places < len(text))]
    places = places[np.frombuffer(text, np.uint8)[places] & 0xC0 != 0x80]  # not inside a character
    return np.concatenate([[0], places, [len(text)]])


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and digest (as a signed long) of every chunk; a text below ``MIN_BYTES`` is one, an empty one none."""
    if not text:
        return (np.zeros(0, np.int64),) * 3
    cut = cuts(text) if len(text) >= MIN_BYTES else np.array([0, len(text)])
    last = np.searchsorted(cut, cut + min(MIN_BYTES, len(text)))
    begin = cut[last < len(cut)]
    end = cut[last[last < len(cut)]]
    view = memoryview(text)
    digest = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
    return begin, end - begin, np.array(digest, "<u8").view("<i8")


def all_chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, crc, at, length, digest`` of the chunks of ``docs``; a digest that a text has again comes once more.

    ``crc`` tells apart different texts under one doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(zlib.crc32(text), *chunks(text)) for text in utf8_texts(batch.column(1))]
            n = np.array([len(p[1]) for p in parts])
            row = np.repeat(np.arange(len(parts)), n)
            crc = np.repeat(np.array([p[0] for p in parts], np.int64), n)
            at, length, digest = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in (1, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(crc), pa.array(at, pa.int32()), pa.array(length, pa.int32()),
                 pa.array(digest, pa.int64())], ["doc_id", "crc", "at", "length", "digest"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _CHUNK)


def _order(doc_id: str, crc: str) -> F.Column:
    """A number by which documents are ordered: by doc_id, those without one last, and by crc under one doc_id."""
    number = F.coalesce(F.col(doc_id).cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
    return number * F.lit(1 << 32).cast("decimal(10,0)") + F.col(crc).cast("decimal(10,0)")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, crc, n_rows, first_ids, spans`` of the documents that repeat what an earlier one has.

    Of all documents with a chunk, the first keeps it, at its first place; everywhere else the chunk is a repetition. The
    first one has the smallest doc_id (rows without a doc_id come last), and of several texts under one doc_id the smallest
    crc. ``spans`` are the repeated byte ranges (begin, end) in order, merged where they touch, and ``first_ids`` the
    documents which keep their content (without those that have no doc_id). ``n_rows`` rows are alike: of rows that have
    both doc_id and text in common, one is compared with the other documents, and a further line of the result stands for
    all others, which repeat it. Null and empty texts have no spans.

    Chunks are counted by digest within each task before they are shuffled, and only repeated digests reach the join, in
    which Spark splits digests that very many documents have. A document's spans come together in one row, as its text
    does.
    """
    return _repeated(docs).drop("further")


def _repeated(docs: DataFrame) -> DataFrame:
    """:func:`repeated_spans`, with ``further``: 0 for the first row with such doc_id and text, 1 for all others."""
    pieces = all_chunks(docs)
    kept = pieces.groupBy("digest", "length").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.min(_order("doc_id", "crc")).alias("first")
    ).filter("n > 1").drop("n")
    hit = pieces.join(kept, ["digest", "length"])
    of = F.struct("at", "length", "digest", "first_id", (F.col("first") == _order("doc_id", "crc")).alias("own"))
    own = hit.groupBy("doc_id", "crc").agg(F.collect_set(of).alias("hits"), F.count_if(F.col("at") == 0).alias("n_rows"))
    # a text that comes twice under one doc_id has all its chunks here, once per row, and each has one at its begin
    alike = F.when(F.col("n_rows") > 1, F.array(F.lit(1).cast("long"), F.col("n_rows") - 1)).otherwise(F.array(F.lit(1).cast("long")))
    own = own.select("doc_id", "crc", "hits", F.posexplode(alike).alias("further", "n_rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            doc_ids, crcs, hits, further, n_rows = batch.columns
            out = [_spans(own, again == 0)
                   for own, again in zip(hits.to_pylist(), further.to_pylist())]
            keep = pa.array([i for i, (spans, _) in enumerate(out) if spans], pa.int64())
            found = [out[i.as_py()] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(keep), crcs.take(keep), further.take(keep), n_rows.take(keep),
                 pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[0] for f in found], kind)],
                ["doc_id", "crc", "further", "n_rows", "first_ids", "spans"],
            )

    spans = "first_ids array<long>, spans array<struct<begin: int, end: int>>"
    return own.mapInArrow(run, f"doc_id long, crc long, further int, n_rows long, {spans}")


def _spans(hits: list[dict], keeps: bool) -> tuple[list[dict], list[int]]:
    """The merged ranges of the chunks that this row does not keep, and who keeps them."""
    spans: list[list[int]] = []
    first_ids, seen = set(), set()
    for hit in sorted(hits, key=lambda h: h["at"]):
        if keeps and hit["own"] and (hit["digest"], hit["length"]) not in seen:
            seen.add((hit["digest"], hit["length"]))
            continue
        first_ids.add(hit["first_id"])
        begin, end = hit["at"], hit["at"] + hit["length"]
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([begin, end])
    return [{"begin": b, "end": e} for b, e in spans], sorted(i for i in first_ids if i is not None)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with every repeated span cut out of ``text``; all rows and columns stay.

    Rows alike in doc_id and text are one document here, and all keep what the first of them keeps.
    """
    spans = _repeated(docs).filter("further = 0").select("doc_id", "crc", "spans")
    inner = {name: free_name(docs, f"_{name}") for name in spans.columns}
    doc_id, crc, ranges = inner.values()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.crc32(F.coalesce("text", F.lit(""))) == F.col(crc))
    out = docs.join(spans.withColumnsRenamed(inner), same, "left")

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(text, ranges) for text, ranges in zip(texts, spans)], dtype=object)

    left = F.when(F.col(ranges).isNull(), F.col("text")).otherwise(F.pandas_udf(cut, "string")("text", ranges))
    return out.withColumn("text", left).select(*docs.columns)


def _cut(text: str | None, ranges: list[dict] | None) -> str | None:
    if ranges is None or text is None:
        return text
    raw, at, kept = text.encode(), 0, []
    for span in ranges:
        kept.append(raw[at : span["begin"]])
        at = span["end"]
    return b"".join([*kept, raw[at:]]).decode()
