"""The pipeline against a brute-force version of its stages, each on the rows that the stage before it has written."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from campflow.llm.common import read_table, stage
from test_components import brute
from test_queries import SF


def five_words(text):
    import regex

    words = regex.findall(r"[\p{L}\p{M}\p{N}]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def word_shingles(text):
    """Five words between ASCII white space, A-Z lower-cased; a shorter text is one shingle."""
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    seen = [docs.collect()]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        seen.append(docs.collect())
        if name != "token_output":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    raw, good, single, clean, mixed, tokens = seen

    assert {r.doc_id for r in good} < {r.doc_id for r in raw}
    assert all(len(r.text.split()) >= 10 for r in good)

    sets = {r.doc_id: word_shingles(r.text) for r in good}
    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = {i: i for i in sets} | dict(brute(pairs))
    assert pairs and sorted(r.doc_id for r in single) == sorted(set(root.values()))

    items = [five_words(r.text) for r in read_table(spark, SF, "benchmark").collect()]
    leaks = {r.doc_id for r in single if any(i and len(i & five_words(r.text)) >= 0.8 * len(i) for i in items)}
    assert leaks and {r.doc_id for r in clean} == {r.doc_id for r in single} - leaks

    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= {r.doc_id for r in clean} and max(times.values()) <= 2
    size = {r.doc_id: len(r.text.encode().split()) for r in clean}
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * sum(size.values())) <= 0.1 * sum(size.values())

    assert Counter(r.doc_id for r in tokens) == times
    at = 0
    for row in sorted(tokens, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    """Each of the first four stages keeps the columns, and what it keeps it has been given."""
    for docs in (odd_docs, no_docs):
        given = {(r.doc_id, r.text) for r in docs.collect()}
        for name, function in corpus_pipeline.STAGES[:-1]:
            out = stage(function(spark, docs, SF), name)
            assert out.columns == docs.columns and {(r.doc_id, r.text) for r in out.collect()} <= given, name
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert sorted(r.doc_id or 0 for r in tokens.collect()) == sorted(doc_id or 0 for doc_id, *_ in docs.collect())
