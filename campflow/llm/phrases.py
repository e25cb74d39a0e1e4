"""Phrases that occur often and whose parts belong together, mined by partitions.

The words are counted first. Then each shard of the texts is mined completely for phrases at a support lowered in
proportion to its share of the words, rounded up: a phrase that reaches the support in the whole must reach its share
in some shard. The phrases that do are united, and a second pass counts all of them in all shards, exactly. Phrases are
grown word by word inside a shard: a phrase is only looked at if its first words passed.

The share of a shard falls as the corpus grows, down to one occurrence. So the shards also report by how much a phrase
passed: a shard with the lowered support t that does not report a phrase holds t - 1 of it at most, which bounds the
whole count, and phrases whose bound is too low are not united. With t = 1 everywhere the bound is the count.

The united phrases are as many as the corpus is rich, so they are never sent whole to anyone: the pass that counts gets a
bit per hash, in a map of a fixed size. A phrase that shares its bit with another one is counted in every shard as well,
exactly, and falls to the support in the end; a crowded map costs time, not truth. The words that reach the support are
told from the others in the same way before either pass. A shard is what a task has read of a language; a
task reads about ``SHARD_WORDS``, and twice as many at most before it mines a shard, so its memory does not grow with the
input.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campflow.llm.common import bounded_batches, giving_back, stage, utf8_texts

#: Fixed: what ends a piece; phrases do not reach over it.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"
MAX_WORDS = 4
#: Words that a task holds at once, as numbers; texts are cut at piece ends into parts of about so many bytes.
SHARD_WORDS, TEXT_BYTES = 16_000_000, 1 << 20
#: Bits of the maps that tell which words and phrases may reach the support: 16 MB each, whatever the input.
MAP_BITS = 1 << 27
_MAP_ROW = 1 << 15  # bits of one row of Spark's bitmaps
_PARTS = 4
_COUNTED_AT_ONCE = 500_000
_ENDS = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
_END = b"."  # cannot be a word
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in parts, with ``_END`` where a piece ends. A-Z are lower-cased."""
    text = text.lower().translate(_ENDS)
    at = 0
    while at < len(text):
        to = text.find(b"\n", at + TEXT_BYTES) if len(text) - at > TEXT_BYTES else -1
        to = len(text) if to < 0 else to
        yield text[at:to].replace(b"\n", b" . ").split()
        at = to + 1


def _seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang)


def _longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hashes of phrases with one word more."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _GOLDEN + words
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return mixed ^ (mixed >> np.uint64(31))


class BitMap:
    """Which hashes are in a set, in a fixed number of bits: every member is, and few others."""

    def __init__(self, rows: list, bits: int) -> None:
        self.bits, self._bytes = bits, np.zeros(bits // 8, np.uint8)
        for row in rows:
            self._bytes[row.row * _MAP_ROW // 8 :][: _MAP_ROW // 8] = np.frombuffer(bytes(row.bits), np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(self.bits)
        return (self._bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def has_one(self, value: int) -> bool:
        at = value % self.bits
        return bool(self._bytes[at >> 3] >> (at & 7) & 1)


def _bit_map(places: DataFrame, bits: int) -> Broadcast:
    """A map of the column ``place``; at most ``bits`` bits reach the driver, and are sent to the tasks."""
    rows = places.groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("row"))
    rows = rows.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits"))
    found = rows.select((F.col("row") - 1).alias("row"), "bits").collect()
    # Spark numbers bits from 1 in a first row of its own
    return places.sparkSession.sparkContext.broadcast(BitMap(found, bits))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, phrase, a`` of every word of ``texts`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                own.pop(_END, None)
                if own:
                    words = pa.array(own.keys(), pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), words, pa.array(own.values(), pa.int64())],
                                                     ["lang", "phrase", "a"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), utf8_texts(batch.column(1))):
                for words in _words(text):
                    counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > _COUNTED_AT_ONCE:
                    yield from counted()
        yield from counted()

    rows = texts.mapInArrow(giving_back(run), "lang string, phrase string, a long")
    return rows.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


class _Ids(dict):
    """Numbers from 1 of the words that may reach the support; 0 for all others, which no phrase contains.

    The others are not kept: they are most of the different words, and few of all words.
    """

    def __init__(self, lang: str, frequent: BitMap) -> None:
        self._seed, self._frequent = _seed(lang), frequent
        self[_END] = 0
        self.words: list[bytes] = [b""]
        self.hashes: list[int] = [0]

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self._seed)
        if not self._frequent.has_one(value):
            return 0
        self[word] = found = len(self.words)
        self.words.append(word)
        self.hashes.append(value)
        return found


@dataclass
class _Found:
    """Phrases of one length in a shard: for each its words as numbers, its hash and its occurrences."""

    words: np.ndarray | None
    hashes: np.ndarray
    counts: np.ndarray


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, the number of its value at each place, and how often each occurs.

    As ``np.unique`` has it, in about half the memory.
    """
    order = np.argsort(values)
    values = values[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.empty(len(values), np.int32)
    number[order] = np.cumsum(first, dtype=np.int32) - 1
    del order
    begin = np.flatnonzero(first)
    return values[first], number, np.diff(begin, append=len(values))


def _mine(
    ids: np.ndarray, hashes: np.ndarray, passes: Callable[[np.ndarray, np.ndarray], np.ndarray], longest: int, with_words: bool
) -> Iterator[_Found]:
    """The phrases of two words and more in ``ids`` that pass, and whose first words passed.

    ``passes`` gets hashes and occurrences. A phrase is numbered by its first words' number and its last word, so equal
    numbers are equal phrases.
    """
    at = np.flatnonzero(ids > 0).astype(np.int32)
    label = ids[at]  # the number of the phrase that begins at each place
    known_words, known_hashes = np.arange(len(hashes), dtype=np.int32)[:, None], hashes
    for length in range(2, longest + 1):
        last = ids[np.minimum(at + (length - 1), len(ids) - 1)]  # a shard ends with a zero
        real = last > 0
        at, label, last = at[real], label[real], last[real]
        del real
        found, number, kept = [], np.full(len(at), -1, np.int32), 0
        for part in range(_PARTS):  # by first words, so that each phrase is whole in one part
            own = np.flatnonzero(label % _PARTS == part)
            if not len(own):
                continue
            pairs, own_label, counts = _numbered(label[own].astype(np.int64) * len(hashes) + last[own])
            before, word = pairs // len(hashes), pairs % len(hashes)
            longer = _longer(known_hashes[before], hashes[word])
            ok = passes(longer, counts)
            numbers = np.where(ok, np.cumsum(ok, dtype=np.int32) - 1 + kept, -1).astype(np.int32)
            number[own] = numbers[own_label]
            kept += int(ok.sum())
            words = np.concatenate([known_words[before[ok]], word[ok].astype(np.int32)[:, None]], axis=1) if with_words else None
            found.append(_Found(words, longer[ok], counts[ok]))
        if not kept:
            return
        known_hashes = np.concatenate([f.hashes for f in found])
        known_words = np.concatenate([f.words for f in found]) if with_words else known_words
        yield _Found(known_words if with_words else None, known_hashes, np.concatenate([f.counts for f in found]))
        keep = number >= 0
        at, label = at[keep], number[keep]


def _shards(batches: Iterator[pa.RecordBatch], frequent: BitMap) -> Iterator[tuple[str, int, np.ndarray, _Ids]]:
    """Shards of a task: language, all its words in the shard, the words as numbers with zeros where phrases end, and
    what the numbers mean."""
    held: dict[str, tuple[_Ids, list[np.ndarray]]] = {}
    sizes: Counter = Counter()

    def shard(lang: str) -> tuple[str, int, np.ndarray, _Ids]:
        (known, parts), n = held.pop(lang), sizes.pop(lang)
        return lang, n, np.concatenate(parts), known

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), utf8_texts(batch.column(1))):
            for words in _words(text):
                if lang not in held:
                    held[lang] = (_Ids(lang, frequent), [])
                known, parts = held[lang]
                parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                parts.append(np.zeros(1, np.int32))
                sizes[lang] += len(words) - words.count(_END)
                if sizes.total() >= 2 * SHARD_WORDS:  # only where the input's partitions are larger than asked for
                    yield shard(max(sizes, key=sizes.get))
    for lang in list(held):
        yield shard(lang)


def _report(lang: int, spare: int, places: np.ndarray, over: np.ndarray) -> pa.RecordBatch:
    """What a shard found, a row per row of the map; the first row holds what an unreported phrase may occur."""
    order = np.argsort(places)
    places, over = places[order], over[order]
    rows, begin = np.unique(places // _MAP_ROW, return_index=True)
    cuts = [*begin.tolist(), len(places)]
    packed = [(places[a:b] % _MAP_ROW).astype("<u2").tobytes() for a, b in zip(cuts, cuts[1:])]
    counts = [over[a:b].astype("<i8").tobytes() for a, b in zip(cuts, cuts[1:])]
    none = [0] * len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * (len(rows) + 1), pa.int32()), pa.array([spare, *none], pa.int64()), pa.array([None, *rows.tolist()], pa.int32()),
         pa.array([None, *packed], pa.binary()), pa.array([None, *counts], pa.binary())],
        ["lang", "spare", "row", "places", "over"],
    )


def _united(batches: Iterator[pa.RecordBatch], wanted: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """The rows of the map, from reports sorted by row and language: a bit where the bounds of all shards add up to what
    the language wants. One row of sums is held at a time."""
    row = lang = None
    sums, bits = np.zeros(_MAP_ROW, np.int64), np.zeros(_MAP_ROW, bool)

    def end_of_language() -> None:
        if lang is not None:
            bits[(sums > 0) & (sums >= wanted[lang])] = True
        sums[:] = 0

    def end_of_row() -> pa.RecordBatch:
        packed = np.packbits(bits, bitorder="little").tobytes()
        bits[:] = False
        return pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([packed], pa.binary())], ["row", "bits"])

    for batch in batches:
        for new_row, new_lang, places, over in zip(*(column.to_pylist() for column in batch.columns)):
            if (new_row, new_lang) != (row, lang):
                end_of_language()
                if row is not None and new_row != row:
                    yield end_of_row()
                row, lang = new_row, new_lang
            np.add.at(sums, np.frombuffer(places, "<u2"), np.frombuffer(over, "<i8"))
    if row is not None:
        end_of_language()
        yield end_of_row()


def _tasks(texts: DataFrame, words: int) -> DataFrame:
    """The input in fewer partitions where they hold few words, so that a shard is as large as a task can hold."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.coalesce(max(cores, -(-words // SHARD_WORDS)))


def phrase_counts(texts: DataFrame, support: int, longest: int = MAX_WORDS, map_bits: int = MAP_BITS) -> DataFrame:
    """``lang, phrase, words, a``: all words and phrases of up to ``longest`` words with ``support`` occurrences or more.

    ``texts`` has lang and text, without nulls. The occurrences are those inside pieces, overlaps included; a phrase is
    its words joined by spaces. Every language is mined on its own.
    """
    context = texts.sparkSession.sparkContext
    bounded_batches(texts.sparkSession)  # a row of reports has the places of thousands of phrases
    words = stage(word_counts(texts), "words")
    totals = {row.lang: row.n for row in words.groupBy("lang").agg(F.sum("a").alias("n")).collect()}
    often = stage(words.filter(F.col("a") >= support), "frequent_words")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), utf8_texts(batch.column(1)))
            found = [xxhash.xxh64_intdigest(word, _seed(lang)) % map_bits for lang, word in rows]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["place"])

    frequent = _bit_map(often.select("lang", "phrase").mapInArrow(places, "place long"), map_bits)
    dealt = _tasks(texts, sum(totals.values()))
    numbers = {lang: i for i, lang in enumerate(sorted(totals))}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, n, ids, known in _shards(batches, frequent.value):
            least = max(1, -(-support * n // totals[lang]))  # this shard's share of the support, rounded up
            mined = list(_mine(ids, np.array(known.hashes, np.uint64), lambda _, counts: counts >= least, longest, False))
            places = np.concatenate([f.hashes % np.uint64(map_bits) for f in mined] or [np.zeros(0, np.uint64)]).astype(np.int64)
            over = np.concatenate([f.counts - (least - 1) for f in mined] or [np.zeros(0, np.int64)])
            yield _report(numbers[lang], least - 1, places, over)

    reports = stage(dealt.mapInArrow(giving_back(local), "lang int, spare long, row int, places binary, over binary"), "local_phrases")
    spare = {row.lang: row.n for row in reports.groupBy("lang").agg(F.sum("spare").alias("n")).collect()}  # a row per language
    wanted = {lang: support - n for lang, n in spare.items()}
    by_row = reports.filter("places IS NOT NULL").repartition("row").sortWithinPartitions("row", "lang")
    rows = by_row.select("row", "lang", "places", "over").mapInArrow(giving_back(lambda batches: _united(batches, wanted)), "row int, bits binary")
    united = context.broadcast(BitMap(rows.collect(), map_bits))  # a bit per place

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, ids, known in _shards(batches, frequent.value):
            names = np.array(known.words, object)
            for found in _mine(ids, np.array(known.hashes, np.uint64), lambda hashes, _: united.value.has(hashes), longest, True):
                for at in range(0, len(found.counts), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    texts_of = [b" ".join(row) for row in names[found.words[some]].tolist()]
                    k = len(texts_of)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * k, pa.string()), pa.array(texts_of, pa.binary()).cast(pa.string()),
                         pa.array([found.words.shape[1]] * k, pa.int32()), pa.array(found.counts[some].astype(np.int64))],
                        ["lang", "phrase", "words", "a"],
                    )

    rows = dealt.mapInArrow(giving_back(counted), "lang string, phrase string, words int, a long")
    sums = rows.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= support)
    out = stage(sums.unionByName(often.select("lang", "phrase", F.lit(1).alias("words"), "a")), "phrases")
    for held in (frequent, united):
        held.unpersist()
    sizes = texts.sparkSession.createDataFrame(list(totals.items()), "lang string, n long")
    return out.join(F.broadcast(sizes), "lang")  # a row per language


def collocations(docs: DataFrame, support: int = 30, cover: int = 80, longest: int = MAX_WORDS) -> DataFrame:
    """``lang, phrase, a, l, r, n, score``: phrases of two words and more with ``support`` occurrences or more in a
    language, without those that a longer one explains.

    ``docs`` has text and lang; null text is empty, null lang is ``und``, other columns are not read. A-Z are
    lower-cased. ``a`` counts the phrase, ``n`` all words of the language. A phrase is cut in two in every way; with
    ``l`` and ``r`` occurrences of the parts a cut scores 2,000,000 * a / (l + r), rounded down, and the lowest-scoring cut
    counts (of equal ones that with the shorter first part). A phrase goes if its words lie side by side in a longer one
    that occurs ``cover`` percent as often or more. Repeated rows count as often as they come; empty tables give no rows.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known = phrase_counts(texts, support, longest)
    # a phrase without its first or last word is as frequent at least, so all parts are known
    long_ones = known.filter("words > 1")
    split = F.split("phrase", " ")
    cut = long_ones.withColumn("_w", split).select(
        "lang", "phrase", "words", "a", "n", "_w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cut = cut.select("lang", "phrase", "words", "a", "n", "k", F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("first"),
                     F.array_join(F.slice("_w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    of = lambda side, name: known.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cut = cut.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    score = F.expr("2000000BD * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cut.groupBy("lang", "phrase", "words", "a", "n").agg(best.alias("cut"))

    inner = long_ones.filter("words > 2").withColumn("_w", split).select("lang", "words", "a", "_w", F.explode(
        F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inner = inner.select("lang", "a", "_w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", "a", F.array_join(F.slice("_w", F.col("at"), F.col("size")), " ").alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    explained = F.expr(f"100BD * cast(longer as decimal(19,0)) >= {cover}BD * cast(a as decimal(19,0))")
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(explained, F.lit(False)))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                       F.col("cut.score").cast("long").alias("score"))


def best_phrases(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each language by score, then occurrences, then the phrase's bytes, with their ``rank``.

    Each task hands on its own first ``n`` of a language only.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("long"))
