from __future__ import annotations

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens import schemas
from visitlens.operators import ads
from visitlens.sinks.batches import BatchTable
from visitlens.sinks.buckets import BucketTable
from visitlens.sources import adlog
from visitlens.streaming import native
from visitlens.streaming.pipeline import (
    AdTables,
    process_batch,
    start_ad_pipeline,
    start_blacklist_query,
    store_user_counts,
    trailing_trend,
)

START = datetime(2018, 6, 29, 8, 30, tzinfo=timezone.utc)


def line(seconds, place, user, ad):
    millis = int((START + timedelta(seconds=seconds)).timestamp() * 1000)
    return f"{millis} {place} {place} {user} {ad}"


def many_lines():
    """Several days and places, no user near the threshold."""
    seconds = (i % 3 * 86_400 + i * 37 % 7200 for i in range(400))
    clicks = [line(s, i % 4, i % 29, i % 7) for i, s in enumerate(seconds)]
    return clicks + ["abc 1 1", ""]


@pytest.fixture
def tables(spark, scratch):
    return AdTables.under(spark, f"{scratch}/tables")


@pytest.fixture
def lines(spark):
    return lambda given: spark.createDataFrame([(text,) for text in given], "value string")


@pytest.fixture
def folder(scratch):
    def fill(batches):
        where = Path(scratch) / "in"
        where.mkdir()
        for n, batch in enumerate(batches):
            (where / f"{n:03d}.txt").write_text("\n".join(batch) + "\n")
        return str(where)

    return fill


def contents(tables):
    return {
        name: tuples(getattr(tables, name)())
        for name in ("blacklist", "user_click_count", "stat", "province_top3", "click_trend")
    }


def test_pipeline_equals_batch(spark, tables, lines, folder):
    given = many_lines()
    where = folder([given[i::4] for i in range(4)])
    stream = adlog.text_ad_lines(spark, where, files_per_batch=1)
    start_ad_pipeline(stream, tables, every=None).awaitTermination()

    clicks = adlog.parse_ad_log(lines(given))
    stat = ads.ad_realtime_stat(clicks)
    assert contents(tables) == {
        "blacklist": [],
        "user_click_count": tuples(ads.ad_user_daily_clicks(clicks)),
        "stat": tuples(stat),
        "province_top3": tuples(ads.ad_province_top3(stat)),
        "click_trend": tuples(ads.ad_minute_counts(clicks)),
    }
    assert tuples(trailing_trend(tables)) == tuples(ads.ad_click_trend(clicks))
    assert tuples(tables.rejected()) == [("",), ("abc 1 1",)]


def test_restart_goes_on_from_the_checkpoint(spark, tables, lines, folder):
    given = many_lines()
    where = folder([given[:200]])
    for _ in range(2):
        stream = adlog.text_ad_lines(spark, where, files_per_batch=1)
        start_ad_pipeline(stream, tables, every=None).awaitTermination()
        (Path(where) / "later.txt").write_text("\n".join(given[200:]))
    clicks = adlog.parse_ad_log(lines(given))
    assert tuples(tables.stat()) == tuples(ads.ad_realtime_stat(clicks))


def test_listed_user_is_dropped_from_the_next_batch(tables, lines):
    process_batch(lines([line(i, 1, 7, 3) for i in range(4)]), 0, tables, threshold=5)
    assert tuples(tables.blacklist()) == []
    process_batch(lines([line(10, 1, 7, 3), line(11, 1, 7, 4)]), 1, tables, threshold=5)
    assert tuples(tables.blacklist()) == [("2018-06-29", 7)]
    process_batch(lines([line(20, 1, 7, 3), line(21, 1, 8, 3)]), 2, tables, threshold=5)
    assert tuples(tables.user_click_count()) == [
        ("2018-06-29", 7, 3, 5),
        ("2018-06-29", 7, 4, 1),
        ("2018-06-29", 8, 3, 1),
    ]
    assert tuples(tables.stat()) == [
        ("20180629", "1", "1", 3, 6),
        ("20180629", "1", "1", 4, 1),
    ]


def test_repeated_batch_changes_nothing(tables, lines):
    first = [line(i, i % 3, i % 5, 1) for i in range(50)]
    second = [line(100 + i, i % 3, i % 5, 1) for i in range(50)]
    process_batch(lines(first), 0, tables, threshold=15)
    process_batch(lines(second), 1, tables, threshold=15)
    before = contents(tables)
    assert len(before["blacklist"]) == 5
    process_batch(lines(second), 1, tables, threshold=15)
    assert contents(tables) == before


def test_batch_cut_short_is_completed(spark, scratch, tables, lines):
    """A failure between two tables leaves the first written, the others not."""
    first = [line(i, i % 3, i % 5, 1) for i in range(50)]
    second = [line(100 + i, i % 3, i % 5, 1) for i in range(50)]
    whole = AdTables.under(spark, f"{scratch}/whole")
    for batch_id, batch in enumerate([first, second]):
        process_batch(lines(batch), batch_id, whole, threshold=15)

    class Failure(Exception):
        pass

    def fail(*_):
        raise Failure

    process_batch(lines(first), 0, tables, threshold=15)
    stage, tables.trend_rows.stage = tables.trend_rows.stage, fail
    with pytest.raises(Failure):
        process_batch(lines(second), 1, tables, threshold=15)
    tables.trend_rows.stage = stage
    process_batch(lines(second), 1, tables, threshold=15)
    assert contents(tables) == contents(whole)


def test_counts_from_the_state_store_list_the_same_users(spark, scratch, lines):
    """Raw running counts against the pipeline's filtered ones, batch by batch."""
    batches = [
        [line(b * 60 + i, 1, (i * (b + 3)) % 6, i % 2) for i in range(20 + 7 * b)]
        for b in range(4)
    ]
    whole = AdTables.under(spark, f"{scratch}/whole")
    split = AdTables.under(spark, f"{scratch}/split")
    seen = []
    for batch_id, batch in enumerate(batches):
        process_batch(lines(batch), batch_id, whole, threshold=12)
        seen += batch
        running = ads.ad_user_daily_clicks(adlog.parse_ad_log(lines(seen)))
        now = ads.ad_user_daily_clicks(adlog.parse_ad_log(lines(batch)))
        keys = ["date", "userid", "adid"]
        updates = running.join(now.select(*keys), keys, "left_semi")
        store_user_counts(updates, batch_id, split, threshold=12)
        assert tuples(split.blacklist()) == tuples(whole.blacklist())
    assert 0 < len(tuples(whole.blacklist())) < 6
    assert tuples(split.user_click_count()) == tuples(whole.user_click_count())


def test_blacklist_query_and_pipeline_without_user_counts(spark, tables, folder):
    given = [line(i, 1, i % 3, 1) for i in range(60)] + [line(99, 2, 9, 1)]
    where = folder([given])
    stream = adlog.text_ad_lines(spark, where)
    start_blacklist_query(stream, tables, threshold=20, every=None).awaitTermination()
    assert tuples(tables.blacklist(), "userid") == [(0,), (1,), (2,)]
    start_ad_pipeline(stream, tables, every=None, count_users=False).awaitTermination()
    assert tuples(tables.stat()) == [("20180629", "2", "2", 1, 1)]
    assert tuples(tables.user_click_count()) == [
        ("2018-06-29", 0, 1, 20), ("2018-06-29", 1, 1, 20), ("2018-06-29", 2, 1, 20),
        ("2018-06-29", 9, 1, 1),
    ]


def test_repeat_uses_the_blacklist_of_the_first_try(tables, lines, monkeypatch):
    """Another stream lists a user between a batch's first try and its repeat."""
    clicks = lines([line(0, 1, 7, 3), line(1, 1, 7, 3)])

    class Failure(Exception):
        pass

    def fail(*_):
        raise Failure

    with monkeypatch.context() as cut_short:
        cut_short.setattr(tables.trend_rows, "stage", fail)
        with pytest.raises(Failure):
            process_batch(clicks, 0, tables, count_users=False)
    store_user_counts(
        ads.ad_user_daily_clicks(adlog.parse_ad_log(clicks)), 0, tables, threshold=2
    )
    assert len(tuples(tables.blacklist())) == 1
    process_batch(clicks, 0, tables, count_users=False)
    assert [r[-1] for r in tuples(tables.stat())] == [2]
    assert sum(r[-1] for r in tuples(tables.click_trend())) == 2
    process_batch(clicks, 1, tables, count_users=False)
    assert [r[-1] for r in tuples(tables.stat())] == [2]


def test_batch_writes_only_what_it_changes(tables, lines):
    process_batch(lines([line(i, i % 9, i, i % 5) for i in range(300)]), 0, tables)
    running = (tables.user_rows, tables.stat_rows, tables.trend_rows, tables.top3_rows)
    for batch_id in range(1, 4):
        early = [set(table.rows().inputFiles()) for table in running]
        process_batch(lines([line(900 + batch_id, 1, 1, 1)]), batch_id, tables)
        for table, files in zip(running, early):
            assert len(table.staged().inputFiles()) == 1
            assert len(files - set(table.rows().inputFiles())) <= 1


def test_batch_reads_no_more_than_the_first_ones_did(tables, lines, monkeypatch):
    """Two batches a day: the second reads the files of its day's buckets, the first none."""
    read = []
    lookup = BucketTable.lookup

    def noted(self, keys):
        found = lookup(self, keys)  # its plan names all files, its scan opens these
        read.append(found.select(F.input_file_name()).distinct().count())
        return found

    monkeypatch.setattr(BucketTable, "lookup", noted)
    per_batch = []
    for batch_id in range(6):
        read.clear()
        day = 86_400 * (batch_id // 2)
        batch = [line(day + 60 * batch_id + i, i % 3, i % 4, 1) for i in range(20)]
        process_batch(lines(batch), batch_id, tables)
        per_batch.append(sum(read))
    assert per_batch[1] > 0 and set(per_batch[1::2]) == {per_batch[1]} and set(per_batch[::2]) == {0}
    running = (tables.user_rows, tables.stat_rows, tables.trend_rows, tables.top3_rows)
    assert sum(len(t.rows().inputFiles()) for t in running) == 3 * per_batch[1]  # of three days


def test_trend_reads_only_the_last_hours(tables, lines):
    process_batch(lines([line(h * 3600, 1, 1, 1) for h in range(100)]), 0, tables)
    trend = trailing_trend(tables)
    assert [r[-1] for r in tuples(trend)] == [1]
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan.split("Subquery")[0]


def test_batch_without_clicks(tables, lines):
    process_batch(lines(["abc"]), 0, tables)
    process_batch(lines([]), 1, tables)
    assert contents(tables) == dict.fromkeys(contents(tables), [])


def run_native(spark, scratch, query, schema, keys):
    table = BatchTable(spark, f"{scratch}/native", schema)
    native.start_updates(
        query, table, f"{scratch}/native-checkpoint", every=None
    ).awaitTermination()
    return tuples(table.newest(keys))


def test_native_stat_equals_batch(spark, scratch, lines, folder):
    given = many_lines()
    where = folder([given[i::3] for i in range(3)])
    clicks = adlog.parse_ad_log(adlog.text_ad_lines(spark, where, files_per_batch=1))
    got = run_native(
        spark, scratch, native.realtime_stat_stream(clicks), schemas.AD_STAT,
        ["date", "province", "city", "adid"],
    )
    assert got == tuples(ads.ad_realtime_stat(adlog.parse_ad_log(lines(given))))


def test_native_trend_equals_batch(spark, scratch, lines, folder):
    given = many_lines()
    where = folder([given[:150], given[150:]])
    clicks = adlog.parse_ad_log(adlog.text_ad_lines(spark, where, files_per_batch=1))
    got = run_native(
        spark, scratch, native.click_trend_stream(clicks), schemas.AD_CLICK_TREND,
        ["date", "hour", "minute", "adid"],
    )
    assert got == tuples(ads.ad_minute_counts(adlog.parse_ad_log(lines(given))))


def test_native_sliding_windows_hold_late_clicks(spark, scratch, lines, folder):
    given = [line(i * 20, 1, 1, i % 2) for i in range(30)]
    later, late = line(3 * 3600, 1, 1, 0), line(5, 1, 1, 1)
    where = folder([given, [later], [late]])
    clicks = adlog.parse_ad_log(adlog.text_ad_lines(spark, where, files_per_batch=1))
    batch = ads.ad_trend_windows(adlog.parse_ad_log(lines([*given, later, late])))
    got = run_native(
        spark, scratch, native.trend_windows_stream(clicks), batch.schema,
        ["window_end", "date", "hour", "minute", "adid"],
    )
    assert got == tuples(batch)
