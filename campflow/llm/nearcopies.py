"""Near copies: SimHash groups, verified by exact Jaccard similarity of word shingles; a prefix filter finds the rest.

The stage begins as operator 10 does: texts whose SimHash fingerprints differ in two bits at most are found by their
fingerprints (:func:`campflow.llm.simhash.fingerprint_links`), each such link is then checked exactly. A radius of two
bits alone would lose most edited copies, and no radius holds all texts that are similar enough. So an exact way follows
for the links that are missing between groups.

Put all shingles in one fixed order and look at the first of each text's only. Two sets that are similar enough share a
shingle within the first fifth of the larger one and the first ninth of the smaller one, or else too little is left for
them to share; nor may too little be left behind the first place where they meet. So each text is filed under its first
shingles, and only texts that meet there are compared. The order puts shingles of many texts last: what a template gives
to all texts of a site is in the first ninth of none, unless nearly all of the text is template, and then they are near
copies. How many texts have a shingle is counted over all documents, in a map of a fixed size; the order decides what it
costs, never what is found.

Texts that meet in buckets of several groups are first compared with one text each, the centre of most of its buckets,
in turns, as long as that brings groups together; large buckets are divided by a segment of the fingerprints for that; what is then left in buckets of several groups is compared pair by pair. So each
pair that meets is compared or connected anyway, and a large group of near copies is not compared pair by pair.

Before the sets of a pair are fetched, small bitmaps are compared in which each shingle of a text has turned over one
bit. They differ in no more bits than the sets do in shingles, so pairs that differ in too many are left out for certain.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campflow.llm.common import free_name, giving_back, outlast, scratch, stage, utf8_texts
from campflow.llm.components import components
from campflow.llm.simhash import SEED, fingerprint_links, majority, shingle_hashes

#: Texts are near copies from this Jaccard similarity of their shingle sets on, as a fraction.
SIMILARITY = (4, 5)
#: Places of the map of counts, and the numbers of texts that it tells apart: shingles of more texts come later.
MAP_PLACES, LEVELS = 1 << 27, (2, 16, 128, 1024)
#: Texts are compared with one centre each in so many turns at most, while more than so many pairs for each text are left
#: to compare pair by pair, and a turn leaves no more than this part of them; buckets of so many texts are large.
STARS, PAIRS_A_TEXT, ENOUGH, LARGE = 5, 1, 0.7, 16
#: Longs of the bitmap that is compared where texts meet.
SMALL = 4
_MAP_ROW = 1 << 15
_COUNTED_AT_ONCE = 1_000_000


def shingle_set(text: bytes, shingle_words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles; a text without words has the one of no word."""
    return _distinct(list(shingle_hashes(text, shingle_words)))


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(found)) if found else np.array([xxhash.xxh64_intdigest(b"", SEED)], "<u8")


def sketch(shingles: np.ndarray, width: int = 0) -> bytes:
    """A bitmap of two to four bits a shingle (or of ``width`` bits), in which each shingle has turned over one bit."""
    width = width or max(64, 2 << (len(shingles) - 1).bit_length())
    turned = np.bincount((shingles % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").tobytes()


def least_difference(one: bytes, other: bytes) -> int:
    """Shingles that are in one of two sets only are at least so many; a longer bitmap is folded to the shorter."""
    x, y = sorted((np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


class Counts:
    """Which places of the map are reached by as many texts as each of ``LEVELS``.

    The driver has the rows as tasks packed them, and hands them on like that; they are unpacked where the map is used.
    """

    def __init__(self, rows: list, places: int) -> None:
        self.places, self._packed = places, [(row.row, bytes(row.bits)) for row in rows]

    def __getstate__(self) -> tuple:
        return self.places, self._packed

    def __setstate__(self, state: tuple) -> None:
        self.places, packed = state
        self._bits = np.zeros((len(LEVELS), self.places // 8), np.uint8)
        for row, bits in packed:
            found = np.frombuffer(zstandard.decompress(bits), np.uint8).reshape(len(LEVELS), -1)
            for k in np.flatnonzero(found.any(axis=1)):  # pages that are never written take no memory
                self._bits[k, row * _MAP_ROW // 8 :][: _MAP_ROW // 8] = found[k]

    def _has(self, k: int, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(self.places)
        return (self._bits[k, (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def twice(self, hashes: np.ndarray) -> np.ndarray:
        return self._has(0, hashes)

    def level(self, hashes: np.ndarray) -> np.ndarray:
        return sum(self._has(k, hashes).astype(np.int8) for k in range(1, len(LEVELS)))


def _reports(places: np.ndarray) -> pa.RecordBatch:
    """How often a task has met each place, a row per row of the map; more than 255 times counts as 255."""
    places, counts = np.unique(places, return_counts=True)
    rows, begin = np.unique(places // _MAP_ROW, return_index=True)
    cuts = [*begin.tolist(), len(places)]
    inside, counts = (places % _MAP_ROW).astype("<u2"), np.minimum(counts, 255).astype("u1")
    spans = list(zip(cuts, cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array([inside[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary())], ["row", "places", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows of the map from reports sorted by row; one row of sums is held at a time."""
    last, sums = None, np.zeros(_MAP_ROW, np.int64)

    def full() -> pa.RecordBatch:
        bits = b"".join(np.packbits(sums >= least, bitorder="little").tobytes() for least in LEVELS)
        sums[:] = 0
        packed = pa.array([zstandard.compress(bits, 3)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), packed], ["row", "bits"])

    for batch in batches:
        for row, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
            if last is not None and row != last:
                yield full()
            last = row
            sums[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "u1")  # places of a report are distinct
    if last is not None:
        yield full()


def shingle_counts(docs: DataFrame, shingle_words: int, places: int = MAP_PLACES) -> Broadcast:
    """The map of all shingles of ``docs``: its bits, of a fixed number, are what reaches the driver (packed) and the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in utf8_texts(batch.column(0)):
                held.append((shingle_set(text, shingle_words) % np.uint64(places)).astype(np.int32))
                size += len(held[-1])
                if size >= _COUNTED_AT_ONCE:
                    yield _reports(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield _reports(np.concatenate(held))

    reports = docs.select("text").mapInArrow(giving_back(run), "row int, places binary, counts binary")
    rows = reports.repartition("row").sortWithinPartitions("row").mapInArrow(giving_back(_summed), "row int, bits binary")
    return docs.sparkSession.sparkContext.broadcast(Counts(rows.collect(), places))


def first_shingles(shingles: np.ndarray, counts: Counts) -> tuple[np.ndarray, np.ndarray, int]:
    """The shingles that a text is filed under, their places, and how many of them hold for texts that are no smaller."""
    ordered = shingles[np.argsort(counts.level(shingles), kind="stable")]  # those of a level stay sorted by hash
    n, (part, whole) = len(ordered), SIMILARITY
    filed = n + 1 - -(-part * n // whole)  # one more than what a similar set may lack
    short = n + 1 - -(-2 * part * n // (part + whole))
    meets = counts.twice(ordered[:filed])
    return ordered[:filed][meets], np.flatnonzero(meets), int(meets[:short].sum())


def _text_key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


_FILED = "doc_id long, node binary, n long, keys array<long>, places array<int>, short int, fingerprint long, sketch binary, small array<long>"


def _filed(docs: DataFrame, shingle_words: int, counts: Broadcast) -> DataFrame:
    def of_text(text: bytes) -> tuple:
        found = list(shingle_hashes(text, shingle_words))
        shingles = _distinct(found)
        keys, places, short = first_shingles(shingles, counts.value)
        small = np.frombuffer(sketch(shingles, 64 * SMALL), "<i8")
        return len(shingles), keys.view("<i8"), places, short, majority(found), sketch(shingles), small

    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _FILED.split(", ")]
        for batch in batches:
            if batch.num_rows:
                made = zip(*map(of_text, utf8_texts(batch.column(2))))
                arrays = [pa.array(values, kind) for values, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    rows = docs.select(F.col("doc_id").cast("long"), _text_key().alias("node"), "text")
    return rows.mapInArrow(giving_back(run), _FILED)


def _shingles(texts: DataFrame, shingle_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # the sets are larger than their texts
                part = batch.slice(at, 200)
                sets = [shingle_set(text, shingle_words).view("<i8") for text in utf8_texts(part.column(1))]
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["node", "shingles"])

    return texts.mapInArrow(giving_back(run), "node binary, shingles array<long>")


def _near(a: Column, b: Column) -> Column:
    """Sets of too different sizes cannot be similar enough."""
    high, low = SIMILARITY
    return F.least(a, b) * low >= F.greatest(a, b) * high


def _meet(x: str, y: str) -> Column:
    """Texts of two groups that may be similar enough: for their sizes, and for what is left behind the place (``at``)
    of the key. At the first key that two texts share, what is left is all that they can share besides."""
    part, whole = SIMILARITY
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    left = F.least(n - F.col(f"{x}.at"), m - F.col(f"{y}.at"))
    return (F.col(f"{x}.root") != F.col(f"{y}.root")) & _near(n, m) & (left * (part + whole) >= (n + m) * part)


def _sketched(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) without those whose bitmaps differ too much, or that are one text; in how many bits (``apart``)."""
    part, whole = SIMILARITY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, one, other = (batch.column(i).to_pylist() for i in range(2, 6))
            apart = [least_difference(x, y) for x, y in zip(one, other)]
            kept = [d * (whole + part) <= (x + y) * (whole - part) for d, x, y in zip(apart, n, m)]
            found = [batch.column(0), batch.column(1), pa.array(apart, pa.int64())]
            yield pa.RecordBatch.from_arrays(found, ["a", "b", "apart"]).filter(pa.array(kept, pa.bool_()))

    of = lambda side: nodes.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("sketch").alias(f"{side}_sketch"))
    both = pairs.filter("a != b").join(of("b"), "b").join(of("a"), "a")
    both = both.filter(_near(F.col("a_n"), F.col("b_n"))).select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch")
    return both.mapInArrow(giving_back(run), "a binary, b binary, apart long")


def _verified(docs: DataFrame, pairs: DataFrame, shingle_words: int) -> DataFrame:
    """Of ``pairs`` (a, b: text keys) those whose shingle sets have a Jaccard similarity of ``SIMILARITY`` or more."""
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    high, low = SIMILARITY
    with scratch(docs.sparkSession) as written:  # the sets are the largest tables here
        texts = docs.select(_text_key().alias("node"), F.coalesce("text", F.lit("")).alias("text"))
        texts = texts.join(stage(wanted, "wanted"), "node", "left_semi").dropDuplicates(["node"])
        sets = stage(_shingles(texts, shingle_words), "shingle_sets")
        of = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"))
        both, size = pairs.join(of("b"), "b").join(of("a"), "a"), lambda side: F.size(f"{side}_set")
        shared = F.size(F.array_intersect("a_set", "b_set"))
        found = stage(both.filter(shared * (high + low) >= (size("a") + size("b")) * high).select("a", "b"), "similar")
        outlast(written)
    return found


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """``a, b``: texts whose fingerprints differ in two bits at most, as stars that connect what those links connect."""
    prints = stage(nodes.groupBy("fingerprint").agg(F.min("node").alias("first")), "fingerprints")
    of = lambda side: prints.select(F.col("fingerprint").alias(f"{side}_print"), F.col("first").alias(side))
    links = fingerprint_links(prints.select("fingerprint")).toDF("a_print", "b_print")
    between = links.join(of("a"), "a_print").join(of("b"), "b_print").select("a", "b")
    return between.unionAll(nodes.join(prints, "fingerprint").select(F.col("node").alias("a"), F.col("first").alias("b")))


def _open(keys: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``keys`` in buckets of several groups, each with its group's ``root`` and the rows of the bucket."""
    columns = ["key", "node", "n", "at", "short", "fingerprint"]
    with scratch(keys.sparkSession) as written:
        rows = keys.select(columns).join(components(links), "node", "left").select(*columns, F.coalesce("root", "node").alias("root"))
        buckets = rows.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("all"))
        found = stage(rows.join(buckets.filter("r < s").drop("r", "s"), "key"), "open_buckets")
        outlast(written)
    return found


def _left(rows: DataFrame) -> int:
    """So many pairs of different groups would be compared in the buckets."""
    both = [F.count(F.lit(1)).alias("of"), F.count_if("short").alias("short")]
    pairs = F.sum("of") * F.sum("short") - F.sum(F.col("of") * F.col("short"))
    return rows.groupBy("key", "root").agg(*both).groupBy("key").agg(pairs.alias("pairs")).agg(F.sum("pairs")).first()[0] or 0


def _to_centres(rows: DataFrame, turn: int) -> DataFrame:
    """``a, b``: texts and the centres that they meet.

    In the first turn a bucket has one centre, and each text has the one that it meets most often. In later turns large
    buckets have a centre for each value of each segment of the fingerprints: texts that are alike share some of these.
    """
    if turn:
        values = [F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("fingerprint", 8 * k).bitwiseAND(F.lit(255)).alias("v")) for k in range(8)]
        rows = rows.filter(F.col("all") >= LARGE).withColumn("segment", F.explode(F.array(*values)))
    by = ["key", "segment"] if turn else ["key"]
    chosen = F.min_by(F.struct("node", "root", "n", "at"), F.xxhash64("node", F.lit(turn))).alias("c")
    met = rows.alias("x").join(rows.groupBy(*by).agg(chosen), by).filter(_meet("x", "c")).select(F.col("node").alias("a"), F.col("c.node").alias("b"))
    if turn:
        return met.distinct()
    times = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    return times.groupBy("a").agg(F.max_by("b", F.struct("times", F.xxhash64("b"))).alias("b"))


def _linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle_words: int, nearest: bool = False) -> DataFrame:
    """Of ``pairs`` those that are similar enough; of the others only few have their sets fetched. With ``nearest`` only
    one pair for each ``a`` is looked at, whose bitmaps differ least."""
    with scratch(docs.sparkSession) as written:
        pairs = _sketched(nodes, pairs)
        pairs = pairs.groupBy("a").agg(F.min_by("b", "apart").alias("b")) if nearest else pairs.select("a", "b")
        found = _verified(docs, stage(pairs, "pairs"), shingle_words)
        outlast(written)
    return found


def similar_groups(docs: DataFrame, shingle_words: int = 5, map_places: int = MAP_PLACES) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs``: groups of texts linked by a Jaccard similarity of 0.8.

    ``component_id`` is the smallest doc_id of the group. Null and empty texts are copies of each other. Rows that
    repeat a doc_id appear as often as they come; a group of only rows without a doc_id has no component_id. Other
    columns are not read.
    """
    counts = shingle_counts(docs, shingle_words, map_places)
    with scratch(docs.sparkSession) as written:
        filed = stage(_filed(docs, shingle_words, counts), "filed")
        each = [F.first(c).alias(c) for c in ("n", "keys", "places", "short", "fingerprint", "sketch", "small")]
        nodes = stage(filed.groupBy("node").agg(F.min("doc_id").alias("first_id"), *each), "texts")
        outlast(written)
        filed = stage(filed.select("doc_id", "node"), "text_of")
        outlast(written)
    n_texts = nodes.count()
    keys = nodes.select("node", "n", "short", "fingerprint", F.posexplode(F.arrays_zip("keys", "places")).alias("i", "k"))
    keys = keys.withColumns({"key": F.col("k.keys"), "at": F.col("k.places"), "short": F.col("i") < F.col("short")})

    links, before = _linked(docs, nodes, _fingerprint_pairs(nodes), shingle_words), None
    for turn in range(STARS + 1):
        keys = _open(keys, links)
        left = _left(keys)
        if turn == STARS or left <= PAIRS_A_TEXT * n_texts or turn > 1 and left > ENOUGH * before:
            break
        links, before = links.unionAll(_linked(docs, nodes, _to_centres(keys, turn), shingle_words, nearest=True)), left
    # only a text in whose first ninth the key lies has to meet those that are no smaller
    keys = keys.join(nodes.select("node", "small"), "node").select("key", "node", "n", "at", "short", "root", *[F.col("small")[i].alias(f"s{i}") for i in range(SMALL)])
    x, y = keys.filter("short").alias("x"), keys.alias("y")
    apart = reduce(add, [F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(SMALL)])
    part, whole = SIMILARITY
    few = apart * (whole + part) <= (F.col("x.n") + F.col("y.n")) * (whole - part)
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.n") <= F.col("y.n")) & _meet("x", "y") & few)
    pairs = pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
    links = links.unionAll(_linked(docs, nodes, pairs, shingle_words))

    named = nodes.select("node", "first_id").join(components(links), "node", "left")
    named = stage(named.select("node", "first_id", F.coalesce("root", "node").alias("root")), "groups")
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    group = stage(named.join(first, "root").select("node", "component_id"), "group_of")
    return filed.select("doc_id", "node").join(group, "node").select("doc_id", "component_id")


def keep_one_per_group(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """``docs`` without near copies: of each of ``similar_groups``, the document with the smallest doc_id stays.

    Of rows that repeat a doc_id the one with the smallest text stays. Rows without a doc_id cannot be named by a
    group; they stay, once per text.
    """
    gone, rank, nameless = (free_name(docs, name) for name in ("_gone", "_rank", "_nameless"))
    with scratch(docs.sparkSession) as written:  # the ids that go are all that is needed later
        groups = similar_groups(docs, shingle_words)
        removed = stage(groups.filter("doc_id != component_id").select(F.col("doc_id").alias(gone)).distinct(), "near_copies")
        written.pop()
    kept = docs.join(removed, F.col("doc_id").cast("long") == F.col(gone), "left_anti")
    kept = kept.withColumn(nameless, F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    best = Window.partitionBy("doc_id", nameless).orderBy("text")
    return kept.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) == 1).drop(rank, nameless)
