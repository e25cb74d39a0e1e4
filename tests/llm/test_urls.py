from __future__ import annotations

import numpy as np
import pytest

from campflow.llm import queries, urls
from campflow.session import work_dir

ODD = [
    (1, "http://a.example.net/en/x", "k"), (1, "http://a.example.net/en/x", "k"), (2, None, None), (None, "http://net/", "n"),
    (3, "", ""), (4, "no scheme.net/", ""), (5, "x://EXAMPLE.Net/EN/", ""), (6, "http://net", ""), (7, "http://anet/", ""),
    (8, "http://www.example.com/de/?q=://b.net/", ""), (9, "https://deep.a.b.org/fr/1#x", ""), (10, "http://é.net/ß", ""),
    (11, "http://" + "a." * 3000 + "net/" + "p" * 5000, ""), (12, "://net/", ""), (13, "http://ORG/fr/", ""), (14, "http://net//", ""),
]


def brute(url, entries):
    text = url or ""
    at = text.find("://")
    rest = text[at + 3 :] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = []
    for entry, verdict in entries:
        name, slash, tail = entry.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append((len(entry.encode()), len(name.encode()), entry, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ODD, "page_id long, url string, verdict string")


def stored(spark, entries):
    return urls.write_list(spark.createDataFrame(entries, "entry string, verdict string"), work_dir(spark, "list"))


@pytest.mark.parametrize("limit", [urls.MAPPED_BYTES, 0])
def test_odd_urls_like_brute_force(spark, pages, limit):
    entries = [*queries.URL_RULES.items(), ("net/ß", "block"), ("b.org/fr/1", "block"), ("é.net", "block"), ("a.b.org/fr", "allow")]
    entries += [(f"host{i}.org/{'x' * (i % 9)}", "block") for i in range(500)]
    found = urls.judged(pages, [stored(spark, entries)], limit).collect()
    expected = [(page, *brute(url, entries)) for page, url, _ in ODD]
    assert sorted(map(repr, ((r.page_id, r.host, r.path, r.entry, r.verdict) for r in found))) == sorted(map(repr, expected))


@pytest.mark.parametrize("limit", [urls.MAPPED_BYTES, 0])
def test_the_first_list_with_an_entry_decides(spark, pages, limit):
    lists = [stored(spark, [("org/fr/", "allow")]), stored(spark, [("org", "block"), ("b.org/fr/1", "block"), ("net", "block")])]
    found = {r.page_id: (r.place, r.verdict) for r in urls.judged(pages, lists, limit).collect()}
    assert found[9] == (0, "allow") and found[6] == (1, "block") and found[7] == (None, "allow")


def test_no_entries_and_no_pages(spark, pages):
    empty = spark.createDataFrame([], "entry string, verdict string")
    nothing = urls.write_list(empty, work_dir(spark, "list"))
    assert nothing.files == ()
    assert {r.verdict for r in urls.judged(pages, [nothing]).collect()} == {"allow"}
    assert urls.judged(pages.limit(0), [stored(spark, [("net", "block")])]).count() == 0
    assert urls.judged(pages, []).count() == len(ODD)


def test_doubled_and_null_entries(spark, pages):
    one = stored(spark, [("net", "allow"), ("net", "block"), (None, "block"), ("net", None)])
    found = {r.page_id: r.verdict for r in urls.judged(pages, [one]).collect()}
    assert found[6] == "block" and found[9] == "allow"


def test_filtered_keeps_rows_and_columns(spark, pages):
    left = urls.filtered(pages, [stored(spark, [("net", "block")])])
    assert left.columns == pages.columns
    kept = [row for row in ODD if brute(row[1], [("net", "block")])[3] == "allow"]
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, kept))


def test_many_files(spark, pages, monkeypatch):
    monkeypatch.setattr(urls, "FILE_ENTRIES", 50)
    entries = [(f"h{i}.net/", "block") for i in range(600)]
    one = stored(spark, entries)
    assert len(one.files) > 5
    asked = spark.createDataFrame([(i, f"http://h{i}.net/") for i in range(700)], "page_id long, url string")
    assert {r.page_id for r in urls.judged(asked, [one]).filter("verdict = 'block'").collect()} == set(range(600))


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    """With all digests equal, the strings alone decide."""
    monkeypatch.setattr(urls, "digest_of", lambda entry: 7)
    entries = [b"a.net", b"b.net", b"c.net"]
    ends = np.cumsum([0, *map(len, entries)], dtype="<u8")
    raw = np.array([3, 0], "<u8").tobytes() + np.full(3, 7, "<u8").tobytes() + ends.tobytes() + bytes([1, 0, 1]) + b"".join(entries)
    file = tmp_path / "list"
    file.write_bytes(raw + b"\n")
    found = dict(urls.MappedList([str(file)]).find([b"c.net", b"x.net", b"b.net", b"a.ne"]))
    assert found == {0: True, 2: False}


def test_candidates_skip_hosts_longer_than_the_list_has():
    every = set(urls.candidates(b"a.bb.ccc.net", b"/x/", (0, 1), 99))
    for longest in range(15):
        assert set(urls.candidates(b"a.bb.ccc.net", b"/x/", (0, 1), longest)) == {(e, n) for e, n in every if n <= longest}
