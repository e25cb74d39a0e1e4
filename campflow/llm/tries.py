"""Prefix tries of conversations, packed as double arrays.

A node stands for a sequence of first turns; conversations that begin alike share nodes. Conversations that are alike
altogether count as one sequence with a number. A node with more than ``TOP_SEQUENCES`` sequences is an upper node; the
first node below the upper ones on a conversation's way is a top, and all that lies below a top is in one shard. A shard
is a bounded set of tops, so a prefix that a third of all conversations share is split at its continuations. Each
shard is packed into BASE and CHECK over dense ids of its turns and walked by all of its sequences at once. The sums of
the tops are then merged into the upper nodes, which several shards share, by joins and aggregations.

A conversation is a row with a short digest of each turn; the texts themselves take no part in the shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campflow.llm.common import WORD, stage

#: Sequences below one top at most; a shard holds about as many.
TOP_SEQUENCES = 4000
#: Numbers are hashed in pieces of text of about this size.
_PIECE = 1 << 16
_ROOT = b""
_TRIES = 256


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, key, words``: the turns of each conversation, counted from 1.

    They come in the order of ``turn``, null first; equal ones in that of role and text. Null role or text is empty, and
    repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. ``key`` is
    a digest of role and text, ``words`` the number of words in the text. Other columns are not read.
    """
    own = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    tagged = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return own.select(
        "conv_id", F.row_number().over(order).cast("long").alias("place"), "role", "text",
        F.unhex(F.substring(F.sha2(tagged, 256), 1, 32)).alias("key"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )


def conversation_trie(conversations: DataFrame, top_sequences: int = TOP_SEQUENCES) -> DataFrame:
    """The nodes of :func:`prefix_nodes` for conversations as they are (conv_id, turn, role, text)."""
    turns = stage(numbered(conversations).drop("role", "text"), "turns")
    return prefix_nodes(turns, turns.select("conv_id").distinct(), top_sequences)[0]


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of each one's last turn (null for the root); ``turns`` as :func:`numbered`."""
    own = turns.select("conv_id", F.col("place").alias("depth"), "role", "text")
    return nodes.join(own, ["conv_id", "depth"], "left")


def prefix_nodes(turns: DataFrame, ids: DataFrame, top_sequences: int = TOP_SEQUENCES) -> tuple[DataFrame, DataFrame]:
    """Every node of the trie, and the conversations that end at each.

    ``turns`` has conv_id, place (from 1, without gaps), key and words; ``ids`` one row (conv_id) per conversation, also
    for those without turns. Nodes have ``node`` and ``parent`` (digests; the root's is empty, its parent null),
    ``depth``, ``conv_id`` (the smallest of its conversations), ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes below it, or itself) and ``saved_tokens`` (the words that need not be stored again, of
    it and all below it). The second table has ``node, conv_id``. Without conversations there are no nodes.
    """
    whole = F.array_sort(F.collect_list(F.struct("place", "key", "words")))
    rows = ids.join(turns.groupBy("conv_id").agg(whole.alias("turns")), "conv_id", "left")
    rows = rows.select("conv_id", F.coalesce("turns.key", F.array().cast("array<binary>")).alias("keys"),
                       F.coalesce("turns.words", F.array().cast("array<bigint>")).alias("words"))
    kind = "conv_id long, keys array<binary>, words array<long>, path array<binary>, node binary"
    ways = stage(rows.mapInArrow(_paths, kind), "ways")
    members = ways.select("node", "conv_id")
    alike = ways.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                                     *[F.first(c).alias(c) for c in ("keys", "words", "path")])
    alike = stage(alike, "sequences")

    steps = alike.select(F.col("node").alias("way"), F.posexplode("path").alias("at", "node"))
    upper = steps.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > top_sequences).select("node")
    deepest = steps.join(stage(upper, "upper_ids"), "node", "left_semi").groupBy("way").agg(F.max("at").alias("at"))
    dealt = alike.join(deepest.withColumnRenamed("way", "node"), "node", "left")
    # the place of the top on the way, from 1
    dealt = stage(dealt.withColumn("top_at", F.coalesce(F.col("at") + 2, F.lit(1))).drop("at"), "dealt")

    shards = max(1, -(-alike.count() // top_sequences))
    below = dealt.filter(F.col("top_at") <= F.size("path"))
    top = F.element_at("path", F.col("top_at").cast("int"))
    below = below.withColumn("shard", F.pmod(F.xxhash64(top), F.lit(shards)))
    packed = stage(below.drop("node").groupBy("shard").applyInArrow(_shard_nodes, _NODE_KIND), "shard_nodes")

    upper = stage(_upper_nodes(dealt), "upper_nodes")
    tops = packed.filter("above IS NOT NULL")
    sums = stage(_merged(tops, upper), "upper_sums")
    finished = upper.join(sums, "node").select(
        "node", "parent", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"), "saved_tokens",
    )
    nodes = packed.drop("above").unionByName(finished)
    shared = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("_shared"))
    nodes = nodes.join(shared, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_shared"))
    return nodes.drop("_shared"), members


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the digest of every prefix of a row's keys, and that of the whole (of no key: the root's)."""
    for batch in batches:
        paths = []
        for keys in batch.column(1):
            so_far, path = hashlib.sha256(), []
            for key in keys.as_py():
                so_far.update(key)
                path.append(so_far.digest()[:16])
            paths.append(path)
        ends = [path[-1] if path else _ROOT for path in paths]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(paths, pa.list_(pa.binary())), pa.array(ends, pa.binary())],
            ["conv_id", "keys", "words", "path", "node"],
        )


def _upper_nodes(dealt: DataFrame) -> DataFrame:
    """The nodes above the tops, and the root, with what their own sequences give them."""
    sums = (F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    above = F.slice("path", 1, F.col("top_at").cast("int") - 1)
    steps = dealt.filter("top_at > 1").select("n", "conv_id", "path", "words", F.posexplode(above).alias("at", "node"))
    steps = steps.select("n", "conv_id", "node", (F.col("at") + 1).cast("long").alias("depth"),
                         F.get("words", F.col("at")).alias("words"), F.slice("path", F.lit(1), F.col("at")).alias("above"))
    own = steps.groupBy("node").agg(*sums, *[F.first(c).alias(c) for c in ("depth", "words", "above")])
    root = dealt.agg(*sums).filter("n_convs > 0").select(
        F.lit(_ROOT).alias("node"), "n_convs", "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("array<binary>").alias("above"),
    )
    parent = F.when(F.col("depth") > 0, F.coalesce(F.get("above", F.size("above") - 1), F.lit(_ROOT)))
    return own.unionByName(root).withColumn("parent", parent)


def _merged(tops: DataFrame, upper: DataFrame) -> DataFrame:
    """``node, n_children, n_leaves, saved_tokens`` of the upper nodes: each gets the sums of all tops and upper nodes
    below it, and counts those directly below. A top meets each node above it once, and each task adds up first."""
    saved = (F.col("n_convs") - 1) * F.col("words")
    line = F.concat(F.array(F.lit(_ROOT)), "above")
    given = tops.select(F.posexplode(line).alias("at", "node"), F.size("above").alias("last"), "n_leaves", "saved_tokens")
    lent = upper.filter("depth > 0").select(
        F.posexplode(line).alias("at", "node"), F.size("above").alias("last"), F.lit(0).cast("long").alias("n_leaves"), saved.alias("saved_tokens")
    )
    zero = F.lit(0).cast("long")
    kept = upper.select("node", zero.alias("n_children"), zero.alias("n_leaves"), saved.alias("saved_tokens"))
    both = given.unionByName(lent).select("node", (F.col("at") == F.col("last")).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    return both.unionByName(kept).groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


_NODE_KIND = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, above array<binary>"
)


class DoubleArray:
    """A trie over whole numbers from 1: the child of state ``s`` by symbol ``c`` is ``base[s] + c``, if ``check`` there
    names ``s``. State 0 is the root. A free place has -1 in ``check``."""

    def __init__(self) -> None:
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self.check[0] = 0
        self._low = 1  # all places before are taken

    def _reach(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free places."""
        while len(found := np.flatnonzero(self.check[self._low :] < 0)[:n]) < n:
            self._reach(len(self.check) + n)
        return found + self._low

    def add_level(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Children of states that have none yet: distinct pairs, sorted by state and symbol."""
        heads, first, counts = np.unique(states, return_index=True, return_counts=True)
        for k in np.flatnonzero(counts > 1).tolist():
            self._place(int(heads[k]), symbols[first[k] : first[k] + counts[k]])
        only = counts == 1
        if only.any():  # an only child can go to any free place
            parents, symbol = heads[only], symbols[first[only]]
            slots = self._free(len(parents))
            self.base[parents], self.check[slots] = slots - symbol, parents
            self._low = int(slots[-1]) + 1

    def _place(self, state: int, symbols: np.ndarray) -> None:
        """The first of the free places tried where all children fit, or beyond all that is taken."""
        tried = self._free(_TRIES) - symbols[0]
        self._reach(int(tried[-1] + symbols[-1]) + 1)
        fits = np.flatnonzero((self.check[tried[:, None] + symbols] < 0).all(axis=1))
        if len(fits):
            base = int(tried[fits[0]])
        else:
            base = int(np.flatnonzero(self.check >= 0)[-1]) + 1 - int(symbols[0])
            self._reach(base + int(symbols[-1]) + 1)
        self.base[state] = base
        self.check[base + symbols] = state

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of ``states`` by ``symbols``; all must exist."""
        children = self.base[states] + symbols
        if not (self.check[children] == states).all():
            raise KeyError("a sequence is not in the trie")
        return children


def _levels(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every depth the sequences that are so long, and the places of their symbols."""
    depth = 0
    while len(alive := np.flatnonzero(starts + depth < ends)):
        yield alive, starts[alive] + depth
        depth += 1


def pack(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> DoubleArray:
    """The double array of all sequences ``symbols[start:end]``, level by level."""
    trie, states = DoubleArray(), np.zeros(len(starts), np.int64)
    width = int(symbols.max(initial=0)) + 1
    for alive, at in _levels(symbols, starts, ends):
        pairs = np.unique(states[alive] * width + symbols[at])
        trie.add_level(pairs // width, pairs % width)
        states[alive] = trie.step(states[alive], symbols[at])
    return trie


def _shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes from each top of a shard on, with the sums over all that lies below them."""
    shard = shard.combine_chunks()
    n, conv_id = (shard.column(c).to_numpy() for c in ("n", "conv_id"))
    top_at = shard.column("top_at").to_numpy().astype(np.int64)
    keys, path, words = (shard.column(c).chunk(0) for c in ("keys", "path", "words"))
    begin = path.offsets.to_numpy().astype(np.int64)
    starts, ends = begin[:-1] + top_at - 1, begin[1:]
    # dense ids from 1: of the turns, and for the first step of each sequence of the tops
    symbols = keys.values.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    symbols[starts] = path.values.take(pa.array(starts)).dictionary_encode().indices.to_numpy() + 1

    trie = pack(symbols, starts, ends)
    size = len(trie.check)
    n_convs, first_flat = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    least = np.full(size, np.iinfo(np.int64).max)
    depth = np.zeros(size, np.int64)
    states, levels = np.zeros(len(starts), np.int64), []
    for alive, at in _levels(symbols, starts, ends):
        now = states[alive] = trie.step(states[alive], symbols[at])
        np.add.at(n_convs, now, n[alive])
        np.minimum.at(least, now, conv_id[alive])
        first_flat[now], depth[now] = at, at - begin[alive] + 1
        levels.append(np.unique(now))
    found = np.concatenate(levels)
    children = np.bincount(trie.check[found], minlength=size)
    leaves = (children == 0).astype(np.int64)
    saved = np.zeros(size, np.int64)
    saved[found] = (n_convs[found] - 1) * words.values.to_numpy()[first_flat[found]]
    for level in reversed(levels[1:]):  # what lies below a node is complete before the node is added to its parent
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    at, parent = first_flat[found], trie.check[found]
    is_top, at_start = parent == 0, begin[np.searchsorted(begin, first_flat[found], "right") - 1]
    ids = path.values
    before = pa.array(at - 1, mask=at == at_start)
    above = [ids.slice(a, b - a).to_pylist() if t else None for a, b, t in zip(at_start.tolist(), at.tolist(), is_top.tolist())]
    return pa.table({
        "node": ids.take(pa.array(at)), "parent": ids.take(before).fill_null(_ROOT), "depth": depth[found],
        "conv_id": least[found], "parent_conv_id": pa.array(least[parent], mask=is_top), "n_convs": n_convs[found],
        "n_children": children[found], "n_leaves": leaves[found], "saved_tokens": saved[found],
        "above": pa.array(above, pa.list_(pa.binary())),
    })


def member_digests(members: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the SHA-256, in hex, of each node's conv_ids in ascending order, joined by commas.

    A digest needs its numbers one after the other, and a node may have a third of them. They are sorted by node and
    number over all tasks and written into pieces of text; one task then reads the pieces of a node as a stream, and
    holds the state of the digest only.
    """
    ordered = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.select("node", "conv_id").mapInArrow(_id_pieces, "node binary, first long, ids string")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "first")
    return pieces.select("node", "ids").mapInArrow(_hash_pieces, "node binary, ends_sha256 string")


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, first, ids, size = None, 0, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array([last], pa.binary()), "first": [first], "ids": [",".join(ids)]})

    for batch in batches:
        for node, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (node != last or size > _PIECE):
                yield piece()
                ids, size = [], 0
            if not ids:
                last, first = node, conv_id
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, so_far = None, hashlib.sha256()
    for batch in batches:
        nodes, digests = [], []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != last:
                if last is not None:
                    nodes.append(last)
                    digests.append(so_far.hexdigest())
                last, so_far = node, hashlib.sha256()
            else:
                so_far.update(b",")
            so_far.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([last], pa.binary()), "ends_sha256": [so_far.hexdigest()]})
