from __future__ import annotations

import pytest
from frame_rows import tuples

from visitlens import schemas
from visitlens.session import Intermediates, materialize, shared_dir
from visitlens.sinks import merge, tables
from visitlens.sinks.batches import BatchTable
from visitlens.sources import tables as sources


@pytest.fixture
def kv(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "g string, k bigint, v bigint")


def test_merges(kv):
    current = kv(("a", 1, 10), ("a", 2, 20), ("b", 1, 30))
    delta = kv(("a", 2, 5), ("c", 9, 1))
    assert tuples(merge.upsert_add(current, delta, ["g", "k"], "v")) == [
        ("a", 1, 10),
        ("a", 2, 25),
        ("b", 1, 30),
        ("c", 9, 1),
    ]
    assert tuples(merge.upsert_replace(current, delta, ["g", "k"])) == [
        ("a", 1, 10),
        ("a", 2, 5),
        ("b", 1, 30),
        ("c", 9, 1),
    ]
    assert tuples(merge.replace_group(current, delta, ["g"])) == [
        ("a", 2, 5),
        ("b", 1, 30),
        ("c", 9, 1),
    ]
    assert tuples(merge.insert_new(current, delta, ["g", "k"])) == [
        ("a", 1, 10),
        ("a", 2, 20),
        ("b", 1, 30),
        ("c", 9, 1),
    ]


@pytest.fixture
def table(spark, scratch):
    return BatchTable(spark, f"{scratch}/t", schemas.AD_USER_CLICK_COUNT)


@pytest.fixture
def counts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), schemas.AD_USER_CLICK_COUNT)


KEYS = ["date", "userid", "adid"]


def test_batches_add_up_or_replace(table, counts):
    assert tuples(table.rows()) == []
    assert tuples(table.newest(KEYS)) == []
    table.append(0, counts(("d1", 1, 1, 5), ("d1", 2, 1, 1)))
    table.append(1, counts(("d1", 1, 1, 7)))
    assert tuples(table.added(KEYS, "clickCount")) == [("d1", 1, 1, 12), ("d1", 2, 1, 1)]
    assert tuples(table.newest(KEYS)) == [("d1", 1, 1, 7), ("d1", 2, 1, 1)]
    assert tuples(table.newest(KEYS, before=1)) == [("d1", 1, 1, 5), ("d1", 2, 1, 1)]


def test_newest_batch_of_a_group(table, counts):
    table.append(0, counts(("d1", 1, 1, 5), ("d1", 2, 1, 1), ("d2", 9, 9, 9)))
    table.append(1, counts(("d1", 3, 3, 3)))
    assert tuples(table.newest_group(["date"])) == [("d1", 3, 3, 3), ("d2", 9, 9, 9)]


def test_repeat_replaces_its_own_rows_only(table, counts):
    table.append(0, counts(("d1", 1, 1, 5)))
    table.append(1, counts(("d1", 2, 1, 2), ("d1", 3, 1, 3)))
    table.append(1, counts(("d1", 2, 1, 4)))
    assert tuples(table.rows()) == [("d1", 1, 1, 5, 0), ("d1", 2, 1, 4, 1)]


def test_batches_prune(table, counts):
    table.append(0, counts(("d1", 1, 1, 5)))
    plan = table.rows(before=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_task_id_comes_first(kv):
    assert tables.with_task_id(kv(("a", 1, 2)), "t1").first() == ("t1", "a", 1, 2)


def test_append_files(spark, kv, scratch):
    for _ in range(2):
        tables.append_files(kv(("a", 1, 2)), f"{scratch}/out")
    assert spark.read.parquet(f"{scratch}/out").count() == 2


def test_managed_table_is_replaced_and_pruned(spark, actions):
    rows = actions([{"date": f"2018-06-{d:02d}", "page_id": d} for d in range(1, 11)])
    for _ in range(2):
        tables.overwrite_table(rows, "user_visit_action", ["date"])
    stored = sources.read_actions(spark)
    assert stored.count() == 10
    some = sources.in_date_range(stored, "2018-06-03", "2018-06-04")
    assert sorted(r.page_id for r in some.collect()) == [3, 4]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    spark.sql("DROP TABLE user_visit_action")


def test_jdbc_writer_settings(kv, monkeypatch):
    """No database here: only what is handed to Spark's writer is checked."""
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **given):
            seen.update(given)
            return self

        def mode(self, name):
            seen["mode"] = name
            return self

        def save(self):
            seen["saved"] = True

    frame = kv(("a", 1, 2))
    monkeypatch.setattr(type(frame), "write", property(lambda self: Writer()))
    tables.append_jdbc(frame, "jdbc:x", "t", "u", "p", connections=3)
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p",
        "numPartitions": "3", "mode": "append", "saved": True,
    }


def test_materialize_reads_back_from_the_named_folder(spark, kv):
    stored = materialize(kv(("a", 1, 2)), "x")
    assert tuples(stored) == [("a", 1, 2)]
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert stored.inputFiles()[0].startswith(f"file://{shared_dir(spark)}/x-")


def test_intermediates_go_with_their_folder(spark, kv, tmp_path):
    other = materialize(kv(("b", 1, 2)), "other", str(tmp_path))
    with Intermediates(spark, str(tmp_path)) as work:
        stored = materialize(kv(("a", 1, 2)), "x", work.path)
        assert stored.count() == 1 and len(list(tmp_path.iterdir())) == 2
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["other"]
    assert other.count() == 1
    with pytest.raises(ValueError, match="on the way"), Intermediates(spark, str(tmp_path)) as work:
        materialize(kv(("a", 1, 2)), "x", work.path)
        raise ValueError("on the way")
    assert len(list(tmp_path.iterdir())) == 1
    Intermediates(spark, str(tmp_path)).remove()
