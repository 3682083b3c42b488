"""Bucketed tables: what a batch reads and replaces, and batches that come again."""

from __future__ import annotations

import pytest
from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens import schemas
from visitlens.sinks.buckets import (
    BucketTable, Ledger, Notes, adding, inserting, replacing, replacing_group, together,
)

KEYS = ["date", "userid", "adid"]


@pytest.fixture
def table(spark, scratch):
    return BucketTable(spark, f"{scratch}/t", schemas.AD_USER_CLICK_COUNT, ["userid"], day="date")


@pytest.fixture
def counts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), schemas.AD_USER_CLICK_COUNT)


def scanned(frame):
    """The files a scan opens, not those its plan lists."""
    return {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}


def test_rules(table, counts):
    assert tuples(table.rows()) == []
    table.apply(0, counts(("d1", 1, 1, 5), ("d1", 2, 1, 1), ("d2", 1, 1, 9)), adding(KEYS, "clickCount"))
    table.apply(1, counts(("d1", 1, 1, 7), ("d1", 3, 1, 2)), adding(KEYS, "clickCount"))
    expected = [("d1", 1, 1, 12), ("d1", 2, 1, 1), ("d1", 3, 1, 2), ("d2", 1, 1, 9)]
    assert tuples(table.rows()) == expected
    table.apply(2, counts(("d1", 2, 1, 100)), replacing(KEYS))
    table.apply(3, counts(("d1", 2, 1, 5), ("d3", 1, 1, 1)), inserting(KEYS))
    assert tuples(table.rows()) == [
        ("d1", 1, 1, 12), ("d1", 2, 1, 100), ("d1", 3, 1, 2), ("d2", 1, 1, 9), ("d3", 1, 1, 1),
    ]
    table.apply(4, counts(("d1", 1, 7, 3)), replacing_group(["date", "userid"]))
    assert ("d1", 1, 7, 3) in tuples(table.rows()) and ("d1", 1, 1, 12) not in tuples(table.rows())
    table.apply(5, counts(), adding(KEYS, "clickCount"))
    assert len(tuples(table.rows())) == 5


def test_a_batch_that_comes_again_is_not_added_again(table, counts):
    for batch in (0, 0, 1, 1, 1):
        table.apply(batch, counts(("d1", 1, 1, 5)), adding(KEYS, "clickCount"))
    assert tuples(table.rows()) == [("d1", 1, 1, 10)]


@pytest.mark.parametrize("broken", ["stage", "note", "publish"])
def test_a_batch_cut_short_is_finished(table, counts, monkeypatch, broken):
    table.apply(0, counts(("d1", 1, 1, 5), ("d1", 2, 1, 5)), adding(KEYS, "clickCount"))

    class Failure(Exception):
        pass

    kind = Ledger if broken == "note" else BucketTable
    whole = getattr(kind, broken)

    def fail(self, *given, **named):
        if broken != "note":
            whole(self, *given, **named)  # the write went through, what follows didn't
        raise Failure

    with monkeypatch.context() as cut_short:
        cut_short.setattr(kind, broken, fail)
        with pytest.raises(Failure):
            table.apply(1, counts(("d1", 1, 1, 2)), adding(KEYS, "clickCount"))
    table.apply(1, counts(("d1", 1, 1, 2)), adding(KEYS, "clickCount"))
    assert tuples(table.rows()) == [("d1", 1, 1, 7), ("d1", 2, 1, 5)]


def test_only_touched_buckets_are_read_and_replaced(table, counts):
    days = [f"d{d}" for d in range(5)]
    for batch, day in enumerate(days):
        table.apply(batch, counts(*((day, u, 1, 1) for u in range(100))), adding(KEYS, "clickCount"))
    before = set(table.rows().inputFiles())
    delta = counts(("d2", 7, 1, 1), ("d2", 7, 2, 1))
    assert len(scanned(table.lookup(delta))) == 1
    table.apply(9, delta, adding(KEYS, "clickCount"))
    assert len(before - set(table.rows().inputFiles())) == 1
    plan = table.lookup(delta)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_files_per_batch_do_not_grow(table, counts):
    seen = []
    for batch in range(8):
        delta = counts(*(("d1", u, batch, 1) for u in range(10)))
        seen.append(len(scanned(table.lookup(delta))))
        table.apply(batch, delta, adding(KEYS, "clickCount"))
    assert seen[0] == 0 and len(set(seen[1:])) == 1


def test_null_days_and_null_keys(table, counts):
    for batch in range(2):
        table.apply(
            batch, counts((None, 1, 1, 2), ("d1", None, None, 3)), adding(KEYS, "clickCount")
        )
    assert tuples(table.rows()) == [("d1", None, None, 6), (None, 1, 1, 4)]


def test_table_without_days(spark, scratch, counts):
    table = BucketTable(spark, f"{scratch}/u", schemas.AD_USER_CLICK_COUNT, ["userid"], buckets=3)
    for batch in range(2):
        table.apply(batch, counts(*((f"d{u % 2}", u, 1, 1) for u in range(9))), adding(KEYS, "clickCount"))
    assert [r[-1] for r in tuples(table.rows())] == [2] * 9
    assert len(table.rows().inputFiles()) <= 3


def test_notes_keep_the_last_two(spark, scratch):
    notes = Notes(spark, f"{scratch}/n", spark.createDataFrame([], "v long").schema)
    assert notes.newest() == []
    for batch in range(5):
        notes.put(batch, batch * 10 if batch != 3 else None)
    assert [tuple(r) for r in notes.newest()] == [(4, 40), (3, None)]
    notes.put(4, 41)
    assert [tuple(r) for r in notes.newest()] == [(4, 41), (3, None)]


def test_together_passes_on_failures(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        together(lambda: done.append(1), lambda: 1 / 0)
    assert done == [1]
