"""Each operator on odd tables: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import gc
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campflow.llm import decontaminate, langid, licences, mixing, nearcopies, pseudonyms, quality, repeats, simhash, templates, tokens
from campflow.llm.queries import tokenizer_file

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 1), (7, 0, None)], LABELS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "two three four five six seven eight nine ten"), (1, "two three four five six seven eight nine ten"),
            (2, None), (3, ""), (4, "too short here"), (None, "one two three four five six"), (5, "nowhere at all is this text found")]
    return spark.createDataFrame(rows, "item_id long, text string")


# 1 ----------------------------------------------------------------------------------------------------------------


def test_chunks_resist_insertions():
    dice = random.Random(1)
    text = " ".join("".join(dice.choices("abcdefgh", k=dice.randint(2, 9))) for _ in range(600)).encode()
    before = set(repeats.chunks(text)[2].tolist())
    after = set(repeats.chunks(text[:1500] + b"an insertion" + text[1500:])[2].tolist())
    assert len(before & after) > 0.9 * len(before)


def test_cuts_stay_between_characters():
    text = ("Ñandú été größer — " * 50).encode()
    for cut in repeats.cuts(text):
        text[:cut].decode()


def test_passages_of_fifty_words_are_found(spark):
    dice = random.Random(2)

    def prose(n):
        return " ".join("".join(dice.choices("abcdefghij", k=dice.randint(1, 9))) for _ in range(n))

    rows, shared = [], []
    for i in range(0, 400, 2):
        passage = prose(55)
        shared.append(i + 1)
        rows += [(i, f"{prose(80)} {passage} {prose(80)}"), (i + 1, f"{prose(30)} {passage} {prose(130)}")]
    rows += [(1000 + i, prose(200)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.first_ids for r in repeats.repeated_spans(docs).collect()}
    assert not [i for i in found if i >= 1000 or i % 2 == 0]
    assert len(set(shared) & set(found)) >= 0.98 * len(shared)
    assert all(first == [i - 1] for i, first in found.items())


def test_short_copies_and_shared_ids_are_found(spark):
    short, passage = "a text that is shorter than a chunk, and comes again and again", " ".join(f"passage{i * i}" for i in range(60))
    rows = [(i, short) for i in range(100)] + [(500, f"{n} {passage} {n}") for n in ("one", "two", "three")]
    rows += [(600, passage[:300] + "x")] * 4 + [(None, f"{passage[-290:]} {n}") for n in "ab"] + [(700, ""), (701, None), (702, "")]
    found = {}
    for row in repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(row.doc_id, []).append(row)
    assert sorted(i for i in found if i is not None and i < 100) == list(range(1, 100))
    assert all(found[i][0].first_ids == [0] and found[i][0].spans == [(0, len(short))] for i in range(1, 100))
    assert len(found[500]) == 2 and all(r.n_rows == 1 and r.first_ids == [500] for r in found[500])
    assert sorted(r.n_rows for r in found[600]) == [1, 3] and len(found[None]) == 2 and not {700, 701, 702} & set(found)


def test_repeats_by_brute_force(spark):
    """Spans recomputed text by text, in the order of ids, from the chunks alone."""
    dice = random.Random(5)
    passages = [" ".join(f"w{dice.randrange(10**6)}" for _ in range(dice.choice([3, 12, 40, 90]))) for _ in range(25)]
    rows = [(i, " ".join(dice.choices(passages, k=dice.randint(0, 4)))) for i in range(150)]
    kept, expected = set(), {}
    for doc_id, text in rows:
        raw = text.encode()
        covered, first = np.zeros(len(raw), bool), {}
        for at, n, digest in zip(*(x.tolist() for x in repeats.chunks(raw))):
            if (n, digest) in kept or (n, digest) in first:
                covered[at : at + n] = True
            first.setdefault((n, digest), at)
        kept |= set(first)
        if covered.any():
            expected[doc_id] = covered
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(expected) and len(found) == len(expected)
    for row in found:
        covered = np.zeros(len(expected[row.doc_id]), bool)
        for span in row.spans:
            covered[span.begin : span.end] = True
        assert (covered == expected[row.doc_id]).all() and all(i <= row.doc_id for i in row.first_ids)


def test_repeats_on_odd_tables(odd_docs, no_docs):
    assert repeats.without_repeats(no_docs).count() == 0
    out = repeats.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    by_id = {}
    for row in out.collect():
        by_id.setdefault(row.doc_id, []).append(row.text)
    assert by_id[2] == [None] and by_id[3] == [""]
    assert len(by_id[5][0]) < 1000 and len(by_id[4][0]) > 400_000  # the long copy goes, the first one stays


# 2 ----------------------------------------------------------------------------------------------------------------


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = "x y\nReleased under the MIT License.\nz", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a/b/COPYING.txt", gpl), ("a/b/c/f.py", "code"), ("a/g.py", "code"), ("a/b/own.py", "# " + mit),
            ("a/bb/h.py", None), ("top.py", ""), (None, mit), (None, None), ("a/g.py", "code")]
    out = licences.scan(spark.createDataFrame(rows, "path string, text string"))
    found = {(r.path, r.own_licence, r.licence, r.inherited_from) for r in out.collect()}
    assert out.count() == len(rows)
    assert ("a/b/c/f.py", None, "GPL-3.0", "a/b") in found and ("a/g.py", None, "MIT", "") in found
    assert ("a/b/own.py", "MIT", "MIT", None) in found and ("a/bb/h.py", None, "MIT", "") in found
    assert ("top.py", None, "MIT", "") in found and (None, None, None, None) in found


def test_licence_scan_on_odd_tables(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        files = docs.withColumn("path", F.concat_ws("/", "source", F.col("doc_id"))).withColumn("Licence", F.lit(1))
        out = licences.scan(files)
        assert out.count() == docs.count() and out.columns.count("licence") + out.columns.count("Licence") == 1


def test_unrelated_lines_have_no_licence():
    matcher = licences._Matcher({None: 1000})
    assert matcher.best(["I lost my driving licence in the snow", "permission to come aboard was refused"])[0] is None
    assert matcher.best(["// Licensed under the Apache License, Version 2.0."])[0] == "Apache-2.0"


def test_wrapped_headers_and_licence_files_are_found():
    import textwrap

    matcher = licences._Matcher({None: 1000})
    assert len(licences.FULL) == 9
    for name, (full,) in licences.FULL.items():
        for width, mark in ((60, ""), (72, "# "), (78, " * "), (10_000, "")):
            lines = "\n".join(mark + line for line in textwrap.wrap("Copyright (c) 2020 A. Person. " + full, width))
            assert matcher.of_text(f"#!/bin/sh\n{lines}\n\nint main;\n".encode())[0] == name
    heads = {"The MIT License (MIT)": "MIT", "          GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "GPL-3.0"}
    long = "words before it " * 300 + "Licensed under the Apache License, Version 2.0." + " words after it" * 300
    for text, name in (heads | {long: "Apache-2.0"}).items():
        assert matcher.of_text(text.encode())[0] == name
    assert matcher.of_text(b"I lost my driving licence in the snow\npermission to come aboard was refused")[0] is None


# 3 ----------------------------------------------------------------------------------------------------------------


def test_contained_items(odd_docs, items):
    found = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontaminate.contaminated(odd_docs, items).collect()}
    assert found == {(1, 1, 5, 5), (-8, 1, 5, 5)}
    kept = decontaminate.clean_documents(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3


def test_nothing_to_find(odd_docs, no_docs, items):
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.clean_documents(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_search_misses_no_partial_copy(spark):
    """Recall of the search against exact containment, around the threshold."""
    dice = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [dice.choices(words, k=dice.randint(9, 120)) for _ in range(60)]
    rows, wanted = [], set()
    for i in range(400):
        item = dice.randrange(60)
        part = list(texts[item])
        for _ in range(dice.randint(0, max(1, len(part) // 25))):
            part[dice.randrange(len(part))] = "changed"
        rows.append((i, " ".join(dice.choices(words, k=1500) + part + dice.choices(words, k=1500))))
        grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if len(grams(texts[item]) & grams(part)) >= 0.8 * len(grams(texts[item])):
            wanted.add((i, item))
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert found == wanted and len(wanted) > 100


def test_decontamination_runs_no_python(spark, odd_docs, items):
    pairs = decontaminate.contaminated(odd_docs, items)
    plan = pairs._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# 4 ----------------------------------------------------------------------------------------------------------------


def test_token_round_trip(spark, odd_docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    tokens.write_tokens(odd_docs, str(tmp_path / "odd"), tokenizer_file())
    rows = tokens.read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, -8, 1, 1, 2, 3, 4, 5, 6, 7, 7]
    at, texts = 0, {}
    for row in odd_docs.collect():
        texts.setdefault(row.doc_id, []).append([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1])
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert (row.start, row.n_tokens) == (at, len(ids)) and ids in texts[row.doc_id]
        at += len(ids)
    assert sorted(tokens.read_document(spark, str(tmp_path / "odd"), 7)) == sorted(texts[7])
    assert tokens.read_document(spark, str(tmp_path / "odd"), 99) == []
    tokens.write_tokens(no_docs, str(tmp_path / "none"), tokenizer_file())
    assert tokens.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(tokenizer_file()), tokens.PieceIds(tokenizer_file())
    texts = ["Don't STOP, it's 12.5 o'clock... ÉTÉ. a.b, x.", "İstanbul ΣΑΣ.  end é ́x ., ..", "\x1c<|endoftext|> a<|startoftext|>b",
             "漢字, かな. 😀!", ""]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(pieces.of([text.encode()])), pieces.kind).tolist() == ids, text


def test_signs_behind_a_word_make_no_new_form():
    """A word is known once whatever signs follow it, and the ids are those of the tokenizer."""
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(tokenizer_file()), tokens.PieceIds(tokenizer_file())
    texts = [" Woord&&& woord,*** woord.%%%\twoord. woord\n", "woord$$$ 1&& woord's&& #woord# a.&b woord&-& it's. '&s", "  \n", "", "été.## été"]
    ids = [np.frombuffer(found, pieces.kind).tolist() for found in pieces.of([text.encode() for text in texts])]
    assert ids == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert {form for form in pieces if "woord" in form} == {"woord", "woord's", "#woord", "woord&-&"}
    assert list(tokens.PieceIds(tokenizer_file()).of([])) == []


def test_pieces_of_older_generations_are_small_and_found_again(monkeypatch):
    """Forms out of use for a while take little memory, are not encoded again, and have the right ids."""
    monkeypatch.setattr(tokens, "_CACHED_FORMS", 10_000)
    monkeypatch.setattr(tokens, "_GROUP_BYTES", 1 << 12)
    dice, learned = random.Random(3), []
    forms = list({"".join(dice.choices("abcdeéß", k=9)) for _ in range(30_000)})
    texts = [" ".join(forms[at : at + 100]).encode() for at in range(0, len(forms), 100)]
    fresh = tokens.PieceIds(tokenizer_file())
    encode = fresh._tokenizer.encode

    class Counting:
        def encode(self, text, **how):
            learned.append(text.count("\n") + 1)
            return encode(text, **how)

    fresh._tokenizer = Counting()
    gc.collect()
    tracemalloc.start()
    before, arrow = tracemalloc.get_traced_memory()[0], pa.total_allocated_bytes()
    ids = list(fresh.of(texts))
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] - before + pa.total_allocated_bytes() - arrow - sum(map(len, ids))
    tracemalloc.stop()
    assert held < 100 * len(forms), held / len(forms)
    assert list(fresh.of(texts)) == ids and sum(learned) == len(forms)
    assert ids[7] == np.array(encode(texts[7].decode(), add_special_tokens=False).ids, fresh.kind).tobytes()


# 5 ----------------------------------------------------------------------------------------------------------------


def test_templates_generalise_fields(spark):
    names = ["ann", "bob", "cy", "di", "eve", "flo", "gus", "hal", "ida", "jo", "kim", "lee"]
    rows = [(i, f"own words of number one\nPosted by {n} on 2020-01-{i + 10} at noon in the forum\nsmall {i}") for i, n in enumerate(names)]
    rows += [(100, "Posted by a stranger who wrote much more than the others did"), (101, None), (102, "Posted by zed on 2021-02-03 at noon in the forum")]
    out = {r.doc_id: r for r in templates.without_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].text == "small 0" and out[0].n_dropped == 2 and out[0].n_lines == 3
    assert out[100].n_dropped == 0 and out[102].text == "" and out[101].text is None


@pytest.mark.parametrize("n", [2_000, 20_000, 100_000])
def test_templates_do_not_fade_as_the_corpus_grows(spark, n):
    """Field values that recur in ten documents each and more stay fields."""
    dice = random.Random(n)
    name = [f"name{''.join(dice.choices('abcdefgh', k=6))}" for _ in range(2000)]
    rows = [(i, f"Posted by {dice.choice(name)} in the forum on topic{'abcdefghij'[i % 10]}{'klmnopqrstuvwxyzabcd'[i // 10 % 20]} today") for i in range(n)]
    out = templates.without_templates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.agg(F.sum("n_dropped")).first()[0] == n


def test_lines_are_masked_as_token_by_token():
    """Leaves and lines by way of whole lines are those of their tokens."""
    dice = random.Random(5)
    lines = ["", " \t ", "7", "a1", "x\x0b2 y", " a  b 3c\td ", "٣ drei", *(" ".join(dice.choices(["a", "b1", "22", "c", "é"], k=dice.randrange(9))) for _ in range(300))]
    plain = [tuple(b"<*>" if any(48 <= c < 58 for c in t) else t for t in line.encode().split()) for line in lines]
    assert [templates.masked_line(line.encode()) for line in lines] == [b" ".join(t) for t in plain]
    leaf = lambda t: templates._number(b" ".join((b"%d" % len(t), *t[: templates.LEADING])))
    assert [templates.leaf_of(b" ".join(t)) for t in plain if t] == [leaf(t) for t in plain if t]
    assert templates._leaves("\n".join(lines).encode()) == {leaf(t) for t in plain if t}


def test_short_lines_and_texts_of_templates(spark):
    rows = [(i, f"All rights reserved.\nmenu\nPage {i}\nsent from my {x} phone to you\nown line {x}") for i, x in enumerate("abcdefghijkl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = templates.without_templates(docs).collect()
    assert all(r.text == f"Page {r.doc_id}\nown line {rows[r.doc_id][1][-1]}" and r.n_dropped == 3 for r in out)
    texts = {(r.text, r.n_lines) for r in templates.recurring_templates(docs).collect()}
    assert texts == {("All rights reserved.", 1), ("menu", 1), ("sent from my <*> phone to you", 12)}


def test_templates_on_odd_tables(odd_docs, no_docs):
    assert templates.without_templates(no_docs).count() == 0
    out = templates.without_templates(odd_docs)
    assert out.count() == odd_docs.count() and out.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    assert out.agg(F.sum("n_dropped")).first()[0] == 0


# 6 ----------------------------------------------------------------------------------------------------------------


def test_binomial_tail_is_exact():
    from fractions import Fraction
    from math import comb

    for n, k, risk in ((40, 0, Fraction(1, 20)), (200, 3, Fraction(1, 50)), (57, 12, Fraction(1, 4))):
        exact = sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, float(risk)) == pytest.approx(float(exact), rel=1e-9)
    assert quality.binomial_tail(0, 0, 0.1) == quality.binomial_tail(5, 5, 0.1) == 1.0


def test_cutoffs_bound_false_rejections(spark):
    dice = random.Random(5)
    word = lambda: "".join(dice.choices("abcdefghij", k=5))
    rows, marks = [], []
    for i in range(2400):
        bad = i % 6 == 0
        share = 0.9 if bad else 0.12 if i % 100 == 1 else 0.0
        rows.append((i, " ".join(word() + ("#" if dice.random() < share else "") for _ in range(40)), "en"))
        marks.append((i, 0 if bad else 1, 0))
    rows += [(5000 + i, "### " * 30, "xx") for i in range(5)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, LABELS)
    cut = {r.stratum: r for r in quality.cutoffs(docs, labels).collect()}
    assert 0 < cut["en"].symbols < 0.2 and cut["en"].dup_lines is None and "xx" not in cut
    out = {r.doc_id: r for r in quality.judged(docs, labels).collect()}
    good = [i for i, q, _ in marks if q]
    assert sum(not out[i].kept for i in good) <= quality.RISK * len(good)
    assert sum(not out[i].kept for i, q, _ in marks if not q) > 380
    assert out[5000].base_failed  # no labels in its stratum: the base rule alone


def test_quality_on_odd_tables(odd_docs, no_docs, labels):
    assert quality.judged(no_docs, labels).count() == 0
    for marks in (labels, labels.limit(0)):
        out = quality.judged(odd_docs, marks)
        assert out.count() == odd_docs.count()
        assert {r.kept for r in out.filter("text is null").collect()} == {False}
    kept = quality.kept_documents(odd_docs.withColumn("kept", F.lit(7)).withColumn("n_words", F.lit(8)), labels)
    assert kept.columns == [*odd_docs.columns, "kept", "n_words"] and {r.kept for r in kept.collect()} == {7}


# 7 ----------------------------------------------------------------------------------------------------------------


def brute_chances(scores, steps):
    from itertools import product

    n, k = scores.shape
    out, total = np.zeros((n, k)), 0.0
    for path in product(range(k), repeat=n):
        weight = np.exp(sum(scores[i, s] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for i, s in enumerate(path):
            out[i, s] += weight
    return out / total


def test_forward_backward_against_all_paths():
    dice = np.random.default_rng(1)
    lengths, steps = np.array([3, 1, 5, 4]), dice.normal(size=(3, 3))
    scores = dice.normal(size=(lengths.sum(), 3))
    chances, expected = langid.forward_backward(scores, lengths, steps)
    begin = np.cumsum(lengths) - lengths
    for b, n in zip(begin, lengths):
        assert np.allclose(chances[b : b + n], brute_chances(scores[b : b + n], steps))
    assert expected.sum() == pytest.approx((lengths - 1).sum())


def test_code_switched_text():
    dice = random.Random(7)
    make = lambda letters: " ".join("".join(dice.choices(letters, k=dice.randint(2, 7))) for _ in range(150))
    model = langid.fit([("aa", make("abcde")) for _ in range(40)] + [("zz", make("vwxyé")) for _ in range(40)])
    assert [x[0] for x in model.label(["abba cede", "wyxé vvé", "123 --", None, ""])] == ["aa", "zz", "und", "und", "und"]
    mixed = langid.letters(make("abcde")[:200] + " " + make("vwxyé")[:200])
    chances = langid.forward_backward(model.emissions(mixed), np.array([len(langid.word_starts(mixed))]), model.transitions)[0]
    labels = chances.argmax(axis=1)
    assert labels[0] == 0 and labels[-1] == 1 and (np.diff(labels) != 0).sum() == 1
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_pieces_of_long_texts_score_alike(monkeypatch):
    model = langid.fit([("aa", "abc bca cab " * 30), ("zz", "xyz zyx yxz " * 30)])
    raw = langid.letters("abc xyz " * 4000)
    whole = model.emissions(raw)
    monkeypatch.setattr(langid, "_CHUNK_CELLS", 1)
    assert np.allclose(whole, model.emissions(raw)) and len(whole) == 8000


def test_language_on_odd_tables(odd_docs, no_docs):
    assert langid.identified(no_docs).count() == 0
    rows = langid.identified(odd_docs.withColumn("score", F.lit("x"))).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if not r.text or not r.text.strip()} == {"und"}
    assert {r.lang_pred for r in langid.identified(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# 8 ----------------------------------------------------------------------------------------------------------------


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_digits_are_permuted(spark):
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = [r.p for r in numbers.select(pseudonyms.permuted_digits(F.col("d"), "t", "k").alias("p")).collect()]
    assert len(set(out)) == 1000 and all(len(p) == 3 and p.isdigit() for p in out)


def test_dates_are_permuted(spark):
    days = spark.range(0, 146_097, 7).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    out = days.select(pseudonyms.pseudonym(F.col("d"), "k").alias("p")).select(F.count_distinct("p"), F.count("p"), F.min("p"), F.max("p")).first()
    assert out[0] == out[1] == 20_871 and out[2] >= "1800-01-01" and out[3] <= "2199-12-31"


def test_values_in_text(spark):
    rows = [(1, "card 4111 1111 1111 1111, 4111111111111111 12 and 4111111111111112; +1 (076) 555-8046."),
            (2, "4111111111111111 x ann.b@mail.example.com ann.b@mail.example.com. 10.0.0.256 10.0.0.25, 2021-02-29"),
            (3, None), (4, ""), (5, "29.02.2020 2/29/2020 2020-02-29 987-65-4321 123-45-6789 GB82WEST12345698765432"),
            (6, "a" * 200_000 + "@" + "1" * 200_000)]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    one, two, five = out[1].text, out[2].text, out[5].text
    assert one.endswith(".") and " 12 and 4111111111111112; +1 (" in one and "4111 1111" not in one
    new = two.split()[0]
    assert luhn(new) and len(new) == 16 and new in one and new == one[5:24].replace(" ", "")
    assert two.split()[2] + "." == two.split()[3] and "10.0.0.256" in two and "10.0.0.25," not in two and "2021-02-29" in two
    day, slash, iso = five.split()[:3]
    assert day.split(".")[::-1] == iso.split("-") and [int(x) for x in slash.split("/")] == [int(iso[5:7]), int(iso[8:]), int(iso[:4])]
    assert "987-65-4321" in five and "123-45-6789" not in five and "GB82WEST" not in five
    assert (out[3].text, out[4].text, out[3].n_values) == (None, "", 0) and out[6].n_values == 0
    other = pseudonyms.pseudonymised(spark.createDataFrame(rows[:1], "doc_id long, text string"), "k2").first()
    assert other.text != one


def test_printed_forms_of_numbers(spark):
    forms = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "+33 1 23 45 67 89", "+33 6 12 34 56 78", "555.123.4567",
             "+44 (0)20 7946 0958", "+4930123456", "+1 (017) 555-7713", "NO93 8601 1117 947"]
    rows = [(i, f"call {f} AND MORE, {f}.") for i, f in enumerate(forms)]
    rows += [(20, "DE89370400440532013000 or DE89 3704 0044 0532 0130 00"), (21, "DE88 3704 0044 0532 0130 00"),
             (22, "+1 (017) 555-7713 42 and +33 1 23 45 67 89 2021-01-01")]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    shape = lambda text: "".join("9" if c.isdigit() else c for c in text)
    for i, f in enumerate(forms):
        text = out[i].text
        assert out[i].n_values == 2 and f not in text and shape(text) == shape(rows[i][1])
        new = text[5 : 5 + len(f)]
        assert text == f"call {new} AND MORE, {new}."
        if f[0].isalpha():
            moved = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1
    packed, _, spaced = out[20].text.partition(" or ")
    assert spaced.replace(" ", "") == packed and packed[:2] == "DE" and out[20].n_values == 2
    assert (out[21].text, out[21].n_values) == (rows[-2][1], 0)
    assert "-7713" not in out[22].text and " 42 and +33 " in out[22].text and out[22].n_values == 3


def test_pseudonyms_on_odd_tables(odd_docs, no_docs):
    assert pseudonyms.pseudonymised(no_docs, "k").count() == 0
    out = pseudonyms.pseudonymised(odd_docs, "k")
    assert sorted(map(str, out.select(odd_docs.columns).collect())) == sorted(map(str, odd_docs.collect()))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 9 ----------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > epochs * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = epochs * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def test_water_filling(spark):
    dice = random.Random(9)
    for n in (1, 2, 7, 30):
        sizes = {(f"s{i}" if i else None): dice.choice([0, 5, 50, 1000, 9000]) for i in range(n)}
        totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.water_fill(totals).collect()}
        wanted = brute_targets(sizes)
        assert found.keys() == wanted.keys() and all(found[s] == pytest.approx(wanted[s]) for s in wanted)


def test_mix_is_near_its_targets(spark):
    dice = random.Random(4)
    rows = [(i, "w " * dice.randint(0, 60), "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    by_source = {}
    for r in out:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.copies <= 2
    for rows in by_source.values():
        assert abs(sum(r.size * r.copies for r in rows) - rows[0].target) <= 30
    again = mixing.mix(docs.repartition(7)).select("doc_id", "copies")
    assert sorted(map(tuple, again.collect())) == sorted((r.doc_id, r.copies) for r in out)
    assert mixing.mixed(docs).count() == sum(r.copies for r in out)


def test_mix_on_odd_tables(odd_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
    assert mixing.mix(odd_docs).count() == odd_docs.count()
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns and {r.SIZE for r in out.collect()} <= {r.SIZE for r in odd_docs.collect()}


# 10 ---------------------------------------------------------------------------------------------------------------


def test_links_of_all_close_pairs(spark):
    dice = random.Random(6)
    prints = {dice.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(8):
            for bit in dice.sample(range(64), dice.randint(1, 3)):
                p ^= 1 << bit
            prints.add(p)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    from test_components import brute

    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))
    found = [tuple(r) for r in links.collect()]
    assert brute(found) == brute(pairs) and len(found) < 70 * len(signed)


def test_near_duplicates_on_odd_tables(odd_docs, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and nearcopies.keep_one_per_group(no_docs).count() == 0
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    group = {r.doc_id: r.component_id for r in rows}
    assert group[1] == group[-8] == -8 and group[5] == group[4] == 4 and group[2] == group[3] == group[6] == 2
    kept = nearcopies.keep_one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-8, 2, 4, 7]


def test_edited_copies_leave_one_per_group(spark):
    dice = random.Random(11)
    texts = {}
    for group in range(40):
        words = [f"w{dice.randrange(5_000)}" for _ in range(200)]
        for _ in range(5):
            copy = list(words)
            for at in dice.sample(range(200), dice.choice((2, 4, 6, 8))):
                copy[at] = f"x{dice.randrange(5_000)}"
            texts[len(texts)] = " ".join(copy)
    for _ in range(300):  # many copies of one text: fewer comparisons than pairs
        at = dice.randrange(200)
        texts[len(texts)] = " ".join([*words[:at], f"y{dice.randrange(5_000)}", *words[at + 1 :]])
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [t.split()]}
    from test_components import brute

    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = {i: i for i in texts} | dict(brute(pairs))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in nearcopies.similar_groups(docs).collect()} == root
    kept = {r.doc_id for r in nearcopies.keep_one_per_group(docs).collect()}
    assert kept == set(root.values()) and len(kept) < len(texts) // 2


def test_texts_of_one_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Two thirds of every text are the same; none are near copies, but for one pair."""
    dice = random.Random(2)
    shared = [f"t{i}" for i in range(200)]
    texts = {i: " ".join([*shared[:100], *(f"u{dice.randrange(10**6)}" for _ in range(100)), *shared[100:]]) for i in range(600)}
    texts[600] = texts[77].replace("t150", "other")
    compared = []
    verified = nearcopies._verified

    def counting(docs, pairs, words):
        compared.append(pairs.count())
        return verified(docs, pairs, words)

    monkeypatch.setattr(nearcopies, "_verified", counting)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in nearcopies.similar_groups(docs).collect()}
    assert found == {i: 77 if i == 600 else i for i in texts}
    assert sum(compared) < 6000


def test_near_copies_with_a_crowded_map(spark):
    """The map of counts decides the order of the shingles only."""
    dice = random.Random(4)
    texts = []
    for _ in range(60):
        words = [f"w{dice.randrange(300)}" for _ in range(dice.randrange(5, 120))]
        texts += [" ".join(words), " ".join([*words[: len(words) // 2], "x", *words[len(words) // 2 :]]), " ".join(words[: 9 * len(words) // 10])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in enumerate(texts) for w in [t.split()]}
    from test_components import brute

    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = {i: i for i in sets} | dict(brute(pairs))
    for places in (1 << 15, 1 << 20):
        assert {r.doc_id: r.component_id for r in nearcopies.similar_groups(docs, map_places=places).collect()} == root


def test_map_of_counts_is_packed_until_it_is_used():
    """Its bits come to the driver packed and stay so; a task that gets the map has all places of all levels."""
    import pickle

    place = nearcopies.MAP_PLACES - 3
    reports = [nearcopies._reports(np.array([5] * times + [place] * (times > 20), np.int32)) for times in (1, 1, 14, 300, 900)]
    rows = pa.Table.from_batches(reports).sort_by("row").to_batches()
    packed = [type("Row", (), row) for batch in nearcopies._summed(iter(rows)) for row in batch.to_pylist()]
    assert sum(len(row.bits) for row in packed) < 1000
    counts = nearcopies.Counts(packed, nearcopies.MAP_PLACES)
    state = pickle.dumps(counts)
    assert len(state) < 2000 and not any(isinstance(v, np.ndarray) for v in vars(counts).values())
    there, hashes = pickle.loads(state), np.array([5, 6, place, 5 + nearcopies.MAP_PLACES], np.uint64)
    assert there.twice(hashes).tolist() == [True, False, True, True]
    assert there.level(hashes).tolist() == [2, 0, 0, 2]  # a report counts a place 255 times at most


def test_bitmaps_never_differ_more_than_the_sets():
    dice = np.random.default_rng(3)
    for size in (1, 5, 64, 300, 5_000):
        for gone in (0, 1, size // 9, size // 2, size):
            all_of = dice.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
            one, other = all_of[:size], np.concatenate([all_of[gone:size], all_of[size : size + gone // 3]])
            apart = len(np.setxor1d(one, other))
            assert nearcopies.least_difference(nearcopies.sketch(one), nearcopies.sketch(other)) <= apart
            assert nearcopies.least_difference(nearcopies.sketch(one, 256), nearcopies.sketch(other, 256)) <= apart


def test_near_copies_begin_with_simhash_links(spark, monkeypatch):
    """Texts within two bits are linked by their fingerprints, before any bucket of shingles is opened."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words).upper(), " ".join([*words[:399], "x"]), " ".join(f"v{i}" for i in range(400))]
    close = [(a, b) for a in range(4) for b in range(a) if (simhash.fingerprint(texts[a].encode(), 5) ^ simhash.fingerprint(texts[b].encode(), 5)).bit_count() <= 2]
    assert (1, 0) in close
    seen, opened = [], nearcopies._open

    def first_links(keys, links):
        seen.append(links.count())
        return opened(keys, links)

    monkeypatch.setattr(nearcopies, "_open", first_links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.component_id for r in sorted(nearcopies.similar_groups(docs).collect())] == [0, 0, 0, 3]
    assert seen[0] > 0
