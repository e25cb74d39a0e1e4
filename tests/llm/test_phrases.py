from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from campflow.llm import phrases

KIND = "doc_id long, text string, lang string, phrase string, A long, words int"


def brute(rows, support, cover=80, longest=4):
    counts, n = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, own in counts.items():
        often = {g: a for g, a in own.items() if a >= support and len(g) > 1}
        for g, a in often.items():
            score, k = min((2000000 * a // (own[g[:k]] + own[g[k:]]), k) for k in range(1, len(g)))
            longer = [b for h, b in often.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if not any(100 * b >= cover * a for b in longer):
                out[lang, " ".join(g)] = (a, own[g[:k]], own[g[k:]], n[lang], score)
    return out


def found(df):
    rows = df.collect()
    out = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "straße", "a\u00a0b", "x\x1cy", "漢字"]
    out = []
    for i in range(300):
        words = [dice.choice(vocabulary) for _ in range(dice.randrange(40))]
        if i % 3 == 0:
            words += ["New", "York", "city", "hall"]
        if i % 4 == 0:
            words[:0] = ["in", "spite", "of"]
        seps = [dice.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in words]
        out.append(("".join(w + s for w, s in zip(words, seps)), dice.choice(["en", "de", None, ""])))
    return [*out, (None, "en"), ("", None), (None, None), ("go go go go go go go go", "en"), (" \t . ,", "de")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2) for i, (t, lang) in enumerate(rows)], KIND)


@pytest.mark.parametrize("support", [1, 3, 8])
@pytest.mark.parametrize("shard", [50, 1000, 3_000_000])
def test_like_brute_force(spark, rows, support, shard, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    assert found(phrases.collocations(frame(spark, rows), support)) == brute(rows, support)


def test_a_crowded_map_changes_nothing(spark, rows):
    texts = frame(spark, rows).na.fill({"lang": "und", "text": ""}).select("lang", "text")
    plenty = phrases.phrase_counts(texts, 3)
    crowded = phrases.phrase_counts(texts, 3, map_bits=1 << 15)
    assert sorted(map(tuple, plenty.collect())) == sorted(map(tuple, crowded.collect()))


def test_other_lengths(spark, rows):
    for longest in (2, 3, 5):
        assert found(phrases.collocations(frame(spark, rows), 4, longest=longest)) == brute(rows, 4, longest=longest)


def test_long_texts_are_cut_at_piece_ends_only(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TEXT_BYTES", 64)
    rows = [("one two three. four five, " * 3000 + "six " * 500, "en"), ("a b " * 5000, "en")]
    assert found(phrases.collocations(frame(spark, rows), 30)) == brute(rows, 30)


def test_no_rows(spark):
    empty = phrases.collocations(frame(spark, []).limit(0), 2)
    assert phrases.best_phrases(empty, 5).collect() == []


def test_rank_and_ties(spark):
    found = spark.createDataFrame(
        [("en", "b c", 5, 7), ("en", "a c", 5, 7), ("en", "z z", 9, 7), ("en", "y", 1, 8), ("de", "é", 1, 1), ("de", "z", 1, 1)],
        "lang string, phrase string, a long, score long",
    )
    best = phrases.best_phrases(found, 3).orderBy("lang", "rank").collect()
    assert [(r.lang, r.rank, r.phrase) for r in best] == [
        ("de", 1, "z"), ("de", 2, "é"), ("en", 1, "y"), ("en", 2, "z z"), ("en", 3, "a c")]


def test_bits_of_the_map(spark):
    places = spark.createDataFrame([(i * 7919 % (1 << 17),) for i in range(5000)] + [(0,), ((1 << 17) - 1,)], "place long")
    held = phrases._bit_map(places, 1 << 17).value
    everywhere = held.has(np.arange(1 << 17, dtype=np.uint64))
    assert set(np.flatnonzero(everywhere).tolist()) == {row.place for row in places.collect()}
    assert held.has_one((1 << 17) - 1) and held.has_one(1 << 17) == bool(everywhere[0])


def test_workers_get_reports_in_small_batches(spark, rows):
    """A row of reports has the places of thousands of phrases, so Spark's 10,000 rows a batch would be too many."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        assert found(phrases.collocations(frame(spark, rows), 5)) == brute([(t, lang) for t, lang in rows], 5)
        assert int(spark.conf.get(name)) <= 512
    finally:
        spark.conf.set(name, before)
