"""Merges by whole partitions: what a batch touches, what it leaves, and what happens when it breaks off."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campflow.operators.changes import apply_feed
from campflow.session import work_dir
from campflow.streaming.store import Store, Table, columns, within

DAYS = Table("t", columns(k="string", event_date="date", v="bigint"), ("k", "event_date"), "event_date")
HASHED = Table("h", columns(k="string", v="bigint"), ("k",), buckets=4)
D = [dt.date(2024, 1, d) for d in range(1, 9)]


@pytest.fixture
def store(spark):
    return Store(spark, work_dir(spark, "store"))


def put(store, table, rows, run="r", batch_id=0, **options):
    changes = store.spark.createDataFrame(rows, table.schema)
    return store.apply(run, batch_id, lambda b: b.merge(table, changes, **options))


def rows_of(store, table):
    return sorted(map(tuple, store.read(table).collect()), key=repr)


def files(store, table):
    return {f.path: f.modificationTime for f in store.spark.read.format("binaryFile").load(f"{store.root}/tables/{table.name}").collect()}


def test_only_touched_days_are_written(store):
    put(store, DAYS, [("a", D[0], 1), ("b", D[1], 1), ("c", None, 1)])
    before = files(store, DAYS)
    put(store, DAYS, [("a", D[1], 2), ("d", None, 2)], batch_id=1)
    after = files(store, DAYS)
    assert {p for p in before if p in after} == {p for p in before if f"event_date={D[0]}" in p}
    assert rows_of(store, DAYS) == sorted([("a", D[0], 1), ("b", D[1], 1), ("c", None, 1), ("a", D[1], 2), ("d", None, 2)], key=repr)


def test_the_touched_days_alone_are_read(store, monkeypatch):
    put(store, DAYS, [(f"k{i}", day, 1) for i, day in enumerate(D)])
    plans = []
    merge = store._stored

    def watched(table):
        df = merge(table)
        plans.append(df.filter(within("event_date", [D[3]]))._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(store, "_stored", watched)
    put(store, DAYS, [("x", D[3], 2)], batch_id=1)
    assert plans and all("PartitionFilters: [isnotnull(event_date" in p or "PartitionFilters: [(event_date" in p for p in plans)


def test_a_batch_counts_once(store):
    assert put(store, HASHED, [("a", 1), (None, 1)])
    assert not put(store, HASHED, [("a", 5)])
    assert put(store, HASHED, [("a", 2)], batch_id=1)
    assert rows_of(store, HASHED) == sorted([("a", 2), (None, 1)], key=repr) and store.version() == 2


def test_a_new_run_writes_over_the_old_one(store):
    for batch_id in range(4):
        put(store, HASHED, [("a", batch_id), ("b", batch_id)], batch_id=batch_id)
    put(store, HASHED, [("a", 100)], run="second", batch_id=0)
    assert rows_of(store, HASHED) == [("a", 100), ("b", 3)] and store.version() == 5


def test_a_batch_that_fails_while_it_prepares_begins_again(store):
    put(store, HASHED, [("a", 1)])

    def broken(batch):
        batch.merge(HASHED, store.spark.createDataFrame([("a", 9)], HASHED.schema))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.apply("r", 1, broken)
    assert rows_of(store, HASHED) == [("a", 1)]
    assert put(store, HASHED, [("a", 2), ("b", 2)], batch_id=1)
    assert rows_of(store, HASHED) == [("a", 2), ("b", 2)]


def test_a_batch_that_fails_while_it_publishes_is_published_again(spark, store, monkeypatch):
    """Half of the tables are published, and the old files of another are gone already."""
    put(store, HASHED, [("a", 1)])
    put(store, DAYS, [("a", D[0], 1)], batch_id=1)
    publish = Store._publish_one

    def half(self, version, step):
        if step["table"] == "t":
            self.files.delete(f"{self.root}/tables/t/event_date={D[0]}")
            raise RuntimeError("lost")
        publish(self, version, step)

    def both(batch):
        batch.merge(HASHED, spark.createDataFrame([("b", 2)], HASHED.schema))
        batch.merge(DAYS, spark.createDataFrame([("b", D[0], 2)], DAYS.schema))

    monkeypatch.setattr(Store, "_publish_one", half)
    with pytest.raises(RuntimeError):
        store.apply("r", 2, both)
    monkeypatch.undo()
    again = Store(spark, store.root)  # another process, the same batch
    assert not again.apply("r", 2, lambda batch: pytest.fail("prepared twice"))
    assert rows_of(again, HASHED) == [("a", 1), ("b", 2)] and rows_of(again, DAYS) == [("a", D[0], 1), ("b", D[0], 2)]


def test_two_rows_for_a_key_fail(store):
    with pytest.raises(Exception, match="more than one row for key"):
        put(store, HASHED, [("a", 1), ("a", 2)])


def test_combine_and_delete(store):
    put(store, HASHED, [("a", 5), ("b", 5)])
    added = {"v": F.coalesce("old.v", F.lit(0)) + F.col("change.v")}
    put(store, HASHED, [("a", -5), ("c", 3), ("b", 1)], batch_id=1, combine=added, keep_row=F.col("new.v") > 0)
    assert rows_of(store, HASHED) == [("b", 6), ("c", 3)]


def test_whole_partitions_replace_what_was_there(store):
    put(store, DAYS, [("a", D[0], 1), ("b", D[0], 1), ("a", D[1], 1), ("z", D[2], 1)])
    put(store, DAYS, [("b", D[0], 2), ("c", D[0], 2)], batch_id=1, touched=[D[0], D[1]], whole=True)
    assert rows_of(store, DAYS) == [("b", D[0], 2), ("c", D[0], 2), ("z", D[2], 1)]


def test_no_rows(store):
    assert rows_of(store, DAYS) == []
    put(store, DAYS, [])
    put(store, DAYS, [("a", D[0], 1)], batch_id=1)
    put(store, DAYS, [], batch_id=2)
    assert rows_of(store, DAYS) == [("a", D[0], 1)]


def test_the_feed_gives_the_table(spark, store):
    batches = [[("a", 1), ("b", 1)], [("b", 2), (None, 2)], [("b", 2), ("c", 3)], [("a", 4)]]
    for batch_id, rows in enumerate(batches):
        put(store, HASHED, rows, batch_id=batch_id)
    feed, state = store.feed(HASHED), spark.createDataFrame([], HASHED.schema)
    for version in range(1, 5):
        state = apply_feed(state, feed.filter(F.col("version") == version).drop("version"), ["k"])
    assert sorted(map(tuple, state.collect()), key=repr) == rows_of(store, HASHED)
    kinds = sorted((r.version, r.k, r._change_type) for r in feed.collect() if r.k == "b")
    assert kinds == [(1, "b", "insert"), (2, "b", "update_postimage"), (2, "b", "update_preimage")]  # none for version 3
    store.expire_feeds(2)
    assert {r.version for r in store.feed(HASHED).collect()} == {3, 4}
