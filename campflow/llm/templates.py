"""Line deduplication by a tree of log templates.

The tree has a fixed depth: a line goes to the leaf of its number of tokens and its first ``LEADING`` tokens, with
fields (tokens that hold a digit) as ``<*>``. Within a leaf the support of a token at a place is the number of lines,
each counted once per document, that have it there. A line has a chain of templates: the most general one fixes the
``MIN_FIXED`` of its places with the most support (of equal ones those further left) and leaves the others as fields;
each further one fixes the next place. Fields are thus found by comparing places of one line with each other, never by a
number that a field's values reach when the corpus grows. A template that ``MIN_DOCS`` documents or more have is
boilerplate, and the lines that have it in their chain are dropped everywhere. Lines of one to three tokens leave no room
for a field: of these only equal ones are found.

The sequential form of such a parser decides line by line; here every decision is a count over all documents, so the
result does not depend on order and no leaf is one task's work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campflow.llm.common import free_name, stage, utf8_texts

LEADING, MIN_DOCS, MIN_FIXED = 2, 10, 0.7
FIELD = b"<*>"
_digit = re.compile(rb"[0-9]").search


def _fields(tokens: list[bytes]) -> list[bytes]:
    return [FIELD if _digit(token) else token for token in tokens]


def masked_line(line: bytes) -> bytes:
    """The tokens of a line, joined by spaces, with ``<*>`` for those that hold a digit."""
    tokens = line.split()
    return b" ".join(_fields(tokens) if _digit(line) else tokens)  # most lines have no digit


def masked(line: bytes) -> tuple[bytes, ...]:
    """The tokens of :func:`masked_line`."""
    return tuple(masked_line(line).split())


def _number(tokens: bytes) -> int:
    n = xxhash.xxh3_64_intdigest(tokens)
    return n - (1 << 64) if n >> 63 else n


def leaf_of(tokens: bytes) -> int:
    """The leaf of a masked line."""
    return _number(b" ".join((b"%d" % (tokens.count(b" ") + 1), *tokens.split(b" ", LEADING)[:LEADING])))


def _leaves(text: bytes) -> set[int]:
    """The leaves of a text's lines: only their leading tokens are masked."""
    heads = set()
    for line in set(text.split(b"\n")):
        if tokens := line.split():
            heads.add((len(tokens), *tokens[:LEADING]))
    return {_number(b" ".join((b"%d" % n, *_fields(leading)))) for n, *leading in heads}


def _lines(docs: DataFrame, with_tokens: bool) -> DataFrame:
    """Of every document its distinct leaves, or its distinct masked lines with their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for doc_id, text in zip(ids, utf8_texts(batch.column(1))):
                if with_tokens:
                    lines = {t for line in set(text.split(b"\n")) if (t := masked_line(line))}
                    rows += [(doc_id, leaf_of(t), _number(t), t) for t in lines]
                else:
                    rows += [(leaf,) for leaf in _leaves(text)]
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    names = ["doc_id", "leaf", "line", "tokens"] if with_tokens else ["leaf"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] if with_tokens else [pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary() if k == pa.string() else k).cast(k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, leaf long, line long, tokens string" if with_tokens else "leaf long"
    return docs.select(_key(), "text").mapInArrow(run, schema)


def _key() -> F.Column:
    """The doc_id, or a hash of the text where there is none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _leaf_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, line, tokens``: the different lines of each document, but for leaves which fewer than ``MIN_DOCS``
    rows have: these cannot hold a recurring template, and only their hashes are shuffled."""
    leaves = _lines(docs, False).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS)
    lines = _lines(docs, True).join(stage(leaves.select("leaf"), "leaves"), "leaf")
    return stage(lines.groupBy("doc_id", "leaf", "line").agg(F.first("tokens").alias("tokens")), "leaf_lines")


def _places(distinct: DataFrame) -> DataFrame:
    """``leaf, line, n, size, place, token, nth, template``: the fixed places of each different line, most support first,
    and the template that fixes the first ``nth`` of them, as a hash of places and tokens that no order changes."""
    tokens = F.split("tokens", " ")
    placed = distinct.select("leaf", "line", "n", F.size(tokens).alias("size"), F.posexplode(tokens).alias("place", "token"))
    placed = placed.filter(F.col("token") != FIELD.decode())
    support = placed.groupBy("leaf", "place", "token").agg(F.sum("n").alias("support")).filter(F.col("support") >= MIN_DOCS)
    by_support = Window.partitionBy("leaf", "line").orderBy(F.desc("support"), "place")
    return placed.join(support, ["leaf", "place", "token"]).select(
        "leaf", "line", "n", "size", "place", "token", F.row_number().over(by_support).alias("nth"),
        F.expr("bit_xor(xxhash64(place, token))").over(by_support.rowsBetween(Window.unboundedPreceding, 0)).alias("template"),
    )


def _recurring(lines: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The places of the different lines, and ``leaf, line, nth, template`` of those that have a recurring template: the
    most special one.

    Equal lines are counted before anything else, and a line that recurs as it is needs no further count. Documents are
    counted for those templates alone of which only several lines together can be in ``MIN_DOCS``.
    """
    places = _places(distinct)
    chain = stage(places.filter(F.col("nth") / F.col("size") >= MIN_FIXED).select("leaf", "line", "n", "nth", "template"), "chains")
    of = ["leaf", "nth", "template"]
    sums = chain.groupBy(of).agg(F.sum("n").alias("total"), F.max("n").alias("most")).filter(F.col("total") >= MIN_DOCS)
    sums = stage(sums, "template_sums")
    unsure = chain.join(sums.filter(F.col("most") < MIN_DOCS).select(of), of)
    counted = lines.select("doc_id", "leaf", "line").join(unsure, ["leaf", "line"]).select("doc_id", *of).distinct()
    counted = counted.groupBy(of).agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= MIN_DOCS)
    recurring = stage(sums.filter(F.col("most") >= MIN_DOCS).select(of).unionAll(counted.select(of)), "recurring")
    best = chain.join(recurring, of).groupBy("leaf", "line").agg(
        F.max("nth").alias("nth"), F.max_by("template", "nth").alias("template")
    )
    return places, stage(best, "line_templates")


def _lines_and_distinct(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = _leaf_lines(docs)
    distinct = lines.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"), F.first("tokens").alias("tokens"))
    return lines, stage(distinct, "distinct_lines")


def recurring_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line, template``: the lines of each document (as hashes of their masked form) that are boilerplate, and
    the hash of the most special template that recurs."""
    lines, distinct = _lines_and_distinct(docs)
    _, best = _recurring(lines, distinct)
    return lines.join(best, ["leaf", "line"]).select("doc_id", "line", "template")


def recurring_templates(docs: DataFrame) -> DataFrame:
    """``template, text, n_lines``: what :func:`recurring_lines` finds, with ``<*>`` for fields, and the number of different
    lines for which no more special template recurs."""
    lines, distinct = _lines_and_distinct(docs)
    places, best = _recurring(lines, distinct)
    one = best.groupBy("leaf", "nth", "template").agg(F.min("line").alias("line"), F.count(F.lit(1)).alias("n_lines"))
    fixed = places.drop("template", "n").withColumnRenamed("nth", "rank").join(one, ["leaf", "line"]).filter("rank <= nth")
    known = fixed.groupBy("leaf", "nth", "template", "n_lines", "size").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("known")
    )
    every = F.sequence(F.lit(0), F.col("size") - 1)
    text = F.array_join(F.transform(every, lambda i: F.coalesce(F.try_element_at("known", i), F.lit(FIELD.decode()))), " ")
    return known.select("template", text.alias("text"), "n_lines")


def without_templates(docs: DataFrame) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``, and with ``n_lines`` and ``n_dropped``.

    All other lines stay as they are, white space and order included. ``n_lines`` counts lines with a token. Null
    texts stay null and have none. A document counts once for a template however often it has it; rows that repeat a
    doc_id are one document for the counts, and so are rows without one that have the same text. Extra columns are carried; those with the name of a new column are replaced.
    """
    gone = recurring_lines(docs).groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    inner = {name: free_name(docs, f"_{name}") for name in gone.columns}
    doc_id, drop = inner.values()
    out = docs.join(gone.withColumnsRenamed(inner), _key() == F.col(doc_id), "left")
    result = free_name(docs, "_kept")

    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, g) for t, g in zip(texts, gone)], columns=["text", "n_lines", "n_dropped"])

    kept = F.pandas_udf(cut, "text string, n_lines long, n_dropped long")("text", drop)
    out = out.withColumn(result, kept)
    new = {name: F.col(f"{result}.{name}") for name in ("text", "n_lines", "n_dropped")}
    return out.withColumns(new).drop(result, *inner.values())


def _cut(text: str | None, gone: np.ndarray | None) -> tuple[str | None, int, int]:
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    n = sum(1 for line in lines if line.strip(" \t\x0b\x0c\r"))
    if gone is None:
        return text, n, 0
    drop = set(gone)
    stay = [line for line in lines if not (t := masked_line(line.encode())) or _number(t) not in drop]
    return "\n".join(stay), n, len(lines) - len(stay)
