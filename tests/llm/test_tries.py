from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from campflow.llm import queries, tries
from campflow.session import work_dir

KIND = "conv_id long, turn int, role string, text string, place string, words int, KEY string"


def brute(ways):
    """Nodes of ``{conv_id: [(role, text)]}`` as (conv_id, depth): the other columns."""
    members = defaultdict(list)
    for c, way in ways.items():
        for d in range(len(way) + 1):
            members[tuple(way[:d])].append(c)
    kids = defaultdict(int)
    for way in members:
        if way:
            kids[way[:-1]] += 1
    out, leaves, saved = {}, defaultdict(int), defaultdict(int)
    for way, own in members.items():
        words = len([w for w in way[-1][1].split(" ") if w]) if way else 0
        for d in range(len(way) + 1):
            leaves[way[:d]] += not kids[way]
            saved[way[:d]] += (len(own) - 1) * words
    for way, own in members.items():
        ends = sorted(c for c in own if len(ways[c]) == len(way))
        parent = min(members[way[:-1]]) if way else None
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out[min(own), len(way)] = (parent, len(own), kids[way], leaves[way], saved[way], digest)
    return out


def nodes_of(spark, rows, top, rebuild=False):
    turns = tries.numbered(spark.createDataFrame(rows, KIND)).drop("role", "text")
    whole = queries.rebuilt(turns) if rebuild else (turns, turns.select("conv_id").distinct())
    nodes, members = tries.prefix_nodes(*whole, top)
    nodes = nodes.join(tries.member_digests(members), "node", "left").na.fill({"ends_sha256": hashlib.sha256().hexdigest()})
    rows = nodes.collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def made(ways, extra=("p", 1, "k")):
    return [(c, t, role, text, *extra) for c, way in ways.items() for t, (role, text) in enumerate(way)]


@pytest.fixture(scope="module")
def ways():
    """A first turn that most share, copies by the hundred, one long conversation, and some that begin others."""
    dice = random.Random(3)
    out = {}
    for c in range(400):
        first = ("user", "hello there") if dice.random() < 0.7 else ("user", f"hi {dice.randrange(40)}")
        out[c] = [first, *[(dice.choice(["user", "assistant"]), f"a b {dice.randrange(3)}") for _ in range(dice.randrange(6))]]
    for c in range(400, 600):
        out[c] = [("system", "s"), ("user", "the same one")]
    out[-5] = [("user", f"long {i}") for i in range(300)]
    return out


@pytest.mark.parametrize("top", [1, 7, 4000])
def test_nodes_like_brute_force(spark, ways, top):
    assert nodes_of(spark, made(ways), top) == brute(ways)


def test_rebuilt_conversations(spark, ways):
    import zlib

    expected = {}
    for c, way in ways.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = ways.get(c - int(np.fmod(c, 20)), [])
        expected[c] = base[:h] + way[h:]
    assert nodes_of(spark, made(ways), 20, rebuild=True) == brute(expected)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "y z"), (2, 1, "", ""), (2, 5, "user", "x"),
        (None, 0, "user", "lost"), (3, 0, "a", "bc"), (4, 0, "ab", "c"), (5, 0, "user", "w " * 50_000),
    ]
    ways = {
        1: [("", ""), ("assistant", "y z"), ("user", "x"), ("user", "x")], 2: [("", ""), ("user", "x")],
        3: [("a", "bc")], 4: [("ab", "c")], 5: [("user", "w " * 50_000)],
    }
    assert nodes_of(spark, [(*row, "p", 1, None) for row in rows], 2) == brute(ways)


def test_no_conversations(spark):
    assert nodes_of(spark, [], 3) == {}


def test_a_conversation_without_turns_ends_at_the_root(spark):
    ids = spark.createDataFrame([(1,), (2,)], "conv_id long")
    turns = tries.numbered(spark.createDataFrame(made({1: [("u", "one two")]}), KIND)).drop("role", "text")
    nodes, members = tries.prefix_nodes(turns, ids)
    found = {r.depth: r for r in nodes.join(tries.member_digests(members), "node", "left").collect()}
    assert (found[0].n_convs, found[0].n_children, found[0].n_leaves) == (2, 1, 1)
    assert found[0].ends_sha256 == hashlib.sha256(b"2").hexdigest()
    alone = tries.prefix_nodes(turns.limit(0), ids)[0].collect()
    assert [(r.n_convs, r.n_children, r.n_leaves) for r in alone] == [(2, 0, 1)]


def test_last_turns(spark, ways):
    turns = tries.numbered(spark.createDataFrame(made(ways), KIND))
    nodes = tries.conversation_trie(spark.createDataFrame(made(ways), KIND), 50)
    for row in tries.last_turns(nodes, turns).collect():
        assert (row.role, row.text) == (ways[row.conv_id][row.depth - 1] if row.depth else (None, None))


def test_digests_of_many_members(spark, monkeypatch):
    """More numbers than one piece holds, and several nodes."""
    members = spark.range(60_000).select((F.col("id") % 3).cast("string").cast("binary").alias("node"), (F.col("id") * 7 - 1000).alias("conv_id"))
    found = {bytes(r.node): r.ends_sha256 for r in tries.member_digests(members).collect()}
    for node in range(3):
        text = ",".join(str(i * 7 - 1000) for i in range(node, 60_000, 3))
        assert found[str(node).encode()] == hashlib.sha256(text.encode()).hexdigest()


def test_double_array_against_a_dictionary():
    dice = np.random.default_rng(5)
    for width in (3, 40, 2000):
        lengths = dice.integers(1, 9, 700)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        symbols = dice.integers(1, width + 1, ends[-1])
        trie = tries.pack(symbols, starts, ends)
        seen = {(): 0}
        for a, b in zip(starts, ends):
            for d in range(a, b):
                way = tuple(symbols[a : d + 1].tolist())
                state = int(trie.step(np.array([seen[way[:-1]]]), symbols[d : d + 1])[0])
                assert seen.setdefault(way, state) == state
        assert len(set(seen.values())) == len(seen)
        with pytest.raises(KeyError):
            trie.step(np.zeros(1, np.int64), np.array([width + 5]))
