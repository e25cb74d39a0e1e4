"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment.

A test item has tens of shingles, a document up to many thousands, so signatures of whole documents would have a
Jaccard similarity near zero to an item that they contain in full. The search therefore uses the containment form of
MinHash: only the small side is sketched. An item's signature is, for each of k permutations, the shingle that comes
first; a permutation is hit if the document has that shingle, which happens with the probability of the containment.
Items are partitioned by the power of two of their number of shingles. Each partition has its own k, and asks for so
many hits that an item at the threshold is missed with a probability below ``MISS``; documents that are too short to
contain a threshold's share of the partition's smallest item are not looked up.

Everything is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.llm.common import free_name, stage

WORDS, THRESHOLD, MISS = 5, 0.8, 1e-6
#: Fixed: words are runs of letters, marks and digits, in lower case; all else separates them.
_WORD = r"[\p{L}\p{M}\p{N}]+"
#: Permutations by partition, the power of two of the number of shingles; larger items have those of the last.
PERMUTATIONS = {0: 16, 1: 16, 2: 24, 3: 32, 4: 48, 5: 64, 6: 64}


def hits_needed(permutations: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """The most hits that a contained item reaches with a probability of at least 1 - ``miss``."""
    below, needed = 0.0, 0
    while needed < permutations:
        below += math.comb(permutations, needed) * threshold**needed * (1 - threshold) ** (permutations - needed)
        if below > miss:
            break
        needed += 1
    return max(needed, 1)


def _words(text: str) -> F.Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_WORD), F.lit(0))


def _sentences(words: F.Column) -> F.Column:
    """The distinct shingles as text; fewer than ``WORDS`` words have none."""
    n = F.size(words) - WORDS + 1
    runs = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(words, i, WORDS), " "))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _keys(hashes: F.Column) -> F.Column:
    """The distinct keys of the shingles of words with these hashes."""
    n = F.size(hashes) - WORDS + 1
    runs = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WORDS))))
    return F.array_distinct(F.slice(runs, F.lit(1), F.greatest(n, F.lit(0))))


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, n_shingles, shingle, key`` of all ``items`` (item_id, text).

    Items with under five words have no shingle and are never found. Rows that repeat an item_id are one item with the
    shingles of all of them; rows without one are left out.
    """
    words = items.filter("item_id is not null").select("item_id", _words("text").alias("words"))
    pieces = words.select("item_id", F.explode(_sentences(F.col("words"))).alias("shingle")).distinct()
    sizes = pieces.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    hashes = F.transform(F.split("shingle", " "), lambda word: F.xxhash64(word))
    key = F.xxhash64(*(F.get(hashes, F.lit(k)) for k in range(WORDS)))
    return pieces.join(sizes, "item_id").select("item_id", "n_shingles", "shingle", key.alias("key"))


def item_sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, key, weight, needed, least``: the keys of an item's signature and how many permutations chose each.

    ``needed`` hits make a document a candidate; it has at least ``least`` words, or it cannot contain enough.
    """
    last = max(PERMUTATIONS)
    partition = F.least(F.floor(F.log2("n_shingles")).cast("int"), F.lit(last))
    k = F.element_at(F.create_map(*(F.lit(x) for item in PERMUTATIONS.items() for x in item)), partition)
    needed = F.element_at(F.create_map(*(
        F.lit(x) for p, n in PERMUTATIONS.items() for x in (p, hits_needed(n, threshold))
    )), partition)
    drawn = shingles.select(
        "item_id", "key", needed.alias("needed"),
        F.ceil(F.pow(F.lit(2), partition) * threshold).cast("int").alias("least"),
        F.explode(F.sequence(F.lit(1), k)).alias("permutation"),
    )
    order = F.struct(F.xxhash64("key", "permutation"), "key")
    first = drawn.groupBy("item_id", "permutation", "needed", "least").agg(F.min_by("key", order).alias("key"))
    return first.groupBy("item_id", "key", "needed", "least").agg(F.count(F.lit(1)).alias("weight"))


def candidates(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``doc_id, item_id``: documents that have enough of an item's signature.

    The signatures come from a written table, so Spark broadcasts them if they are below its threshold; beyond that
    the keys are joined by a shuffle, in which it splits keys that very many documents share.
    """
    hashed = docs.select("doc_id", F.transform(_words("text"), lambda word: F.xxhash64(word)).alias("hashes"))
    keys = hashed.select("doc_id", F.size("hashes").alias("n_words"), F.explode(_keys(F.col("hashes"))).alias("key"))
    hits = keys.join(sketches, "key").filter("n_words >= least")
    found = hits.groupBy("doc_id", "item_id", "needed").agg(F.sum("weight").alias("hits"))
    return found.filter("hits >= needed").select("doc_id", "item_id")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` for every document that contains a benchmark item.

    ``containment`` is the share of the item's distinct five-word shingles that the document has, counted exactly by
    their text for the candidates of the search; it is ``threshold`` or more. Null and empty texts contain nothing.
    Rows that repeat a doc_id are one document; rows without a doc_id cannot be named and are left out. Without items,
    or without documents, the result is empty. Other columns are not read.
    """
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    shingles = stage(item_shingles(items), "item_shingles")
    sketches = stage(item_sketches(shingles, threshold), "item_sketches")
    pairs = stage(candidates(docs, sketches), "candidates")
    named = pairs.select("doc_id").distinct()
    words = docs.join(named, "doc_id", "left_semi").select("doc_id", _words("text").alias("words"))
    own = words.select("doc_id", F.explode(_sentences(F.col("words"))).alias("shingle"))
    held = own.join(shingles.select("item_id", "n_shingles", "shingle"), "shingle").distinct()
    found = held.groupBy("doc_id", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_found"))
    sure = found.join(pairs, ["doc_id", "item_id"], "left_semi")
    return sure.withColumn("containment", F.col("n_found") / F.col("n_shingles")).filter(F.col("containment") >= threshold)


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that contain a benchmark item; rows without a doc_id stay."""
    gone = free_name(docs, "_leak")
    leaks = contaminated(docs, items, threshold).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(stage(leaks, "leaks"), F.col("doc_id") == F.col(gone), "left_anti")
