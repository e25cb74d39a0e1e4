from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from campflow.operators import changes, sessions

SCHEMA = "k string, d date, v int, w string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


KEYS = ["k", "d"]
A, B = ("a", None, 1, "x"), ("b", None, 2, None)


def test_change_feed(spark):
    before = frame(spark, A, B, (None, None, 5, "n"), ("c", None, 1, "y"))
    after = frame(spark, A, ("b", None, 3, None), (None, None, 5, "n"), ("d", None, None, None))
    feed = {(r.k, r._change_type): r.v for r in changes.change_feed(before, after, KEYS).collect()}
    assert feed == {
        ("b", "update_preimage"): 2, ("b", "update_postimage"): 3, ("c", "delete"): 1, ("d", "insert"): None,
    }
    back = changes.apply_feed(before, changes.change_feed(before, after, KEYS), KEYS)
    assert back.exceptAll(after).count() == 0 and after.exceptAll(back).count() == 0


def test_no_change(spark):
    df = frame(spark, A, B, (None, None, None, None))
    assert changes.change_feed(df, df, KEYS).count() == 0


def test_upsert(spark):
    target = frame(spark, A, B, (None, None, 1, "n"))
    merged = changes.upsert(target, frame(spark, ("b", None, None, "new"), (None, None, 2, "n"), ("e", None, 9, "")), KEYS)
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(
        map(str, [A, ("b", None, None, "new"), (None, None, 2, "n"), ("e", None, 9, "")])
    )
    assert merged.columns == target.columns


def test_upsert_refuses_two_rows_for_a_key(spark):
    with pytest.raises(PySparkException, match="more than one row for key"):
        changes.upsert(frame(spark, A), frame(spark, B, B), KEYS).collect()
    with pytest.raises(PySparkException, match="more than one row for key"):
        changes.require_unique(frame(spark, B, B), KEYS).collect()
    assert changes.require_unique(frame(spark, A, B), KEYS).count() == 2


def test_latest(spark):
    log = spark.createDataFrame([("a", 1, "old"), ("a", 10, None), ("a", 2, "mid"), (None, 1, "n")], "k string, b int, v string")
    assert sorted(map(str, map(tuple, changes.latest(log, ["k"], "b").collect()))) == ["('a', None)", "(None, 'n')"]


def test_keys_only_table(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert changes.upsert(df, df, ["k"]).count() == 2
    assert changes.change_feed(df, df.filter("k = 'a'"), ["k"]).collect()[0]._change_type == "delete"


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (0, "e0", "s1", "2024-01-01T10:00:05", "click", "cust1"),
        (1, "e1", "s1", "2024-01-01T10:00:01", "impression", "cust1"),
        (2, "e2", "s2", "2024-01-01T10:00:02", "click", "cust2"),
        (3, "e3", "s1", "2024-01-01T10:30:00", "click", "cust9"),
    ]
    schema = "n bigint, event_id string, session_id string, event_timestamp string, action_type string, customer_id string"
    return spark.createDataFrame(rows, schema)


def test_sessions(events):
    rows = {r.session_id: r for r in sessions.sessions_from_events(events, arrival=["n"]).collect()}
    s1 = rows["s1"]
    assert (s1.session_start, s1.session_end) == ("2024-01-01T10:00:01", "2024-01-01T10:30:00")
    assert (s1.total_events, s1.total_clicks, s1.customer_id) == (3, 2, "cust1")
    assert rows["s2"].total_events == 1


def test_fragments_restart_and_merge_back(events):
    fragments = sessions.session_fragments(sessions.with_flush_number(events, "n", every=2), arrival=["n"])
    got = {(r.session_id, r.flush_number): (r.total_events, r.total_clicks) for r in fragments.collect()}
    assert got == {("s1", 0): (2, 1), ("s2", 1): (1, 1), ("s1", 1): (1, 1)}
    whole, merged = sessions.sessions_from_events(events, arrival=["n"]), sessions.merge_session_fragments(fragments)
    assert whole.dtypes == merged.dtypes
    assert whole.exceptAll(merged).count() == 0 and merged.exceptAll(whole).count() == 0
