"""Registered queries against their SQL, and against brute force where there is none."""

from __future__ import annotations

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from oracle import compare

from campflow.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "conversations"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.fixture(scope="module")
def docs(tables):
    return tables.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows_of(df):
    return {row.doc_id: row for row in df.collect()}


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, tables, name):
    assert compare(queries.QUERIES[name](spark, SF), tables, queries.ORACLES[name]) == []


def test_token_files_hold_the_tokenizers_ids(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    found, start = rows_of(queries.QUERIES["op4_token_files"](spark, SF)), 0
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        row = found[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_quality_counts(spark, docs):
    found = rows_of(queries.QUERIES["op6_quality_rules"](spark, SF))
    for doc_id, text in docs:
        words, row = text.encode().split(), found[doc_id]
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i : i + 5])].append(i)
        covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert row.n_words == len(words) and row.n_repeat_words == len(covered)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert row.n_dup_lines == sum(line in lines[:i] for i, line in enumerate(lines))
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)


def test_language_of_held_out_documents(spark, tables):
    found = rows_of(queries.QUERIES["op7_language_crf"](spark, SF))
    truth = dict(tables.sql("SELECT doc_id, lang FROM documents").fetchall())
    for doc_id, row in found.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    tested = [i for i in truth if found[i].held_out]
    assert sum(found[i].lang_pred == truth[i] for i in tested) >= 0.9 * len(tested)


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest id that each id reaches over fingerprints within two bits."""
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def test_simhash_groups(spark, docs):
    found = rows_of(queries.QUERIES["op10_simhash_groups"](spark, SF))
    prints = {doc_id: brute_fingerprint(text) for doc_id, text in docs}
    groups = brute_groups(prints)
    for doc_id in prints:
        assert (found[doc_id].fingerprint, found[doc_id].component_id) == (f"{prints[doc_id]:016x}", groups[doc_id])


def test_licences_of_lines(spark, docs):
    found = rows_of(queries.QUERIES["op2_licence_scan"](spark, SF))
    marks = {"Apache License, Version 2.0": "Apache-2.0", "under the MIT License": "MIT", "CC BY-NC 4.0": "CC-BY-NC-4.0",
             "GNU General Public License, version 3": "GPL-3.0"}
    for doc_id, text in docs:
        named = {name for mark, name in marks.items() if mark in text}
        assert found[doc_id].own_licence in (named or {None})
        if found[doc_id].own_licence is None and found[doc_id].licence:
            assert found[doc_id].path.startswith(found[doc_id].inherited_from + "/")


def test_line_templates(spark, docs):
    from campflow.llm.templates import MIN_DOCS, MIN_FIXED, masked

    found = rows_of(queries.QUERIES["op5_line_templates"](spark, SF))
    homes = defaultdict(set)
    for doc_id, text in docs:
        for line in text.split("\n"):
            homes[masked(line.encode())].add(doc_id)
    for doc_id, text in docs:  # lines that recur as they are need no template with more fields
        lines = [t for x in text.split("\n") if (t := masked(x.encode()))]
        recur = sum(sum(x != b"<*>" for x in t) / len(t) >= MIN_FIXED and len(homes[t]) >= MIN_DOCS for t in lines)
        assert found[doc_id].n_dropped >= recur
        assert found[doc_id].n_lines == sum(1 for x in text.split("\n") if x.encode().split())


def test_pseudonyms_leave_other_text(spark, docs):
    found = rows_of(queries.QUERIES["op8_pseudonyms"](spark, SF))
    for doc_id, text in docs:
        row = found[doc_id]
        assert (row.n_values == 0) == (row.text == text)
        assert row.text.count("\n") == text.count("\n")


def test_repeats_are_repeats(spark, docs):
    text_of = {doc_id: text.encode() for doc_id, text in docs}
    found = queries.QUERIES["op1_substring_repeats"](spark, SF).collect()
    assert found
    for row in found:
        own, others = text_of[row.doc_id], [text_of[i] for i in row.first_ids]
        for span in row.spans:
            piece = own[span.begin : span.end]
            assert len(piece) >= 96 or piece == own
            # a span is merged from chunks of which each is kept somewhere
            assert any(piece[:96] in other for other in others)
