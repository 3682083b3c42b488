"""Units that close behind a watermark: every click is counted once or kept as late."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from frame_rows import tuples
from pyspark.errors import StreamingQueryException

from visitlens import schemas
from visitlens.sources import adlog
from visitlens.streaming import closing

START = datetime(2018, 6, 29, 8, 30, tzinfo=timezone.utc)
DELAY = "10 minutes"


def line(seconds, user=1, ad=1):
    millis = int((START + timedelta(seconds=seconds)).timestamp() * 1000)
    return f"{millis} 1 1 {user} {ad}"


@pytest.fixture
def put(scratch):
    where = Path(scratch) / "in"
    where.mkdir()

    def write(n, batch):
        file = where / f"{n:03d}.txt"
        file.write_text("\n".join(batch) + "\n")
        os.utime(file, (1_600_000_000 + n, 1_600_000_000 + n))  # streams take the oldest first
        return str(where)

    return write


def run(spark, scratch, where, counts=closing.closed_minutes, unit=closing.MINUTE, fail=None, **how):
    clicks = adlog.parse_ad_log(adlog.text_ad_lines(spark, where, files_per_batch=1))
    closed = counts(clicks, DELAY, **how)
    table = closing.ClosedTable(spark, f"{scratch}/closed", closed.schema)
    query = closing.start_closing(clicks, closed, table, unit, DELAY, every=None)
    query.awaitTermination()
    return table, query


BATCHES = [
    [line(i * 7, i, i % 3) for i in range(60)],
    [line(3000 + i, i, 1) for i in range(20)],
    [line(30), line(2990), line(10_000)],  # the first is late by the newest click, not by Spark's rule
    [line(31), line(9_000), line(9_990), line(12_000)],  # the first is late
    [line(11_990), line(32), line(33), line(20_000)],
]


def minutes_of(lines):
    seen = Counter()
    for text in lines:
        ts = datetime.fromtimestamp(int(text.split()[0]) / 1000, timezone.utc)
        seen[(ts.strftime("%Y%m%d"), ts.strftime("%H"), ts.strftime("%M"), int(text.split()[4]))] += 1
    return seen


def accounted(table, given, newest):
    """Closed counts, late clicks and open minutes together are all clicks."""
    late = [
        f"{int(r['ts'].timestamp() * 1000)} {r['province']} {r['city']} {r['user_id']} {r['ad_id']}"
        for r in table.late().collect()
    ]
    rows = tuples(table.closed())
    counted = Counter({row[:-1]: row[-1] for row in rows})
    assert len(counted) == len(rows)  # each minute once
    given, late = minutes_of(given), minutes_of(late)
    end = START + timedelta(seconds=newest) - timedelta(minutes=10)
    last = (end - timedelta(minutes=1)).strftime("%Y%m%d%H%M")  # the last minute that has closed
    still_open = Counter({k: n - late[k] for k, n in given.items() if "".join(k[:3]) > last})
    assert counted + late + still_open == given
    return sum(late.values())


def test_every_click_is_closed_late_or_open(spark, scratch, put):
    for n, batch in enumerate(BATCHES):
        where = put(n, batch)
    table, query = run(spark, scratch, where)
    n_late = accounted(table, sum(BATCHES, []), 20_000)
    assert n_late == 3  # 31, 32 and 33; 9_000 is before the newest click, but not late by the rule
    dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert dropped == 2  # Spark counts rows after combining: 32 and 33 are one


def test_restarts_and_repeated_batches_change_nothing(spark, scratch, put, monkeypatch):
    store = closing.store_closed
    broken = set()

    def fail_after(both, batch, *rest):
        store(both, batch, *rest)
        if batch % 2 and batch not in broken:  # all is written, the checkpoint doesn't know
            broken.add(batch)
            raise RuntimeError

    monkeypatch.setattr(closing, "store_closed", fail_after)
    for n, batch in enumerate(BATCHES):
        where = put(n, batch)
        for _ in range(3):
            try:
                table, _ = run(spark, scratch, where)
                break
            except StreamingQueryException:
                pass
    assert len(broken) > 2
    accounted(table, sum(BATCHES, []), 20_000)


def test_sliding_windows_are_given_out_once(spark, scratch, put):
    for n, batch in enumerate(BATCHES):
        where = put(n, batch)
    table, _ = run(spark, scratch, where, closing.closed_trend_windows, minutes=5)
    rows = tuples(table.closed())
    assert len({r[:-1] for r in rows}) == len(rows)
    by_minute = Counter()
    for _, *minute, n in rows:
        by_minute[tuple(minute)] += n
    counted = minutes_of(
        sum(BATCHES[:3], []) + [line(9_000), line(9_990), line(12_000), line(11_990)]
    )
    whole = {k: 5 * n for k, n in counted.items() if "".join(k[:3]) <= "201806291348"}
    assert {k: n for k, n in by_minute.items() if k in whole} == whole
    assert {r[-2] for r in rows} == {0, 1, 2}


def test_days_close_and_their_state_goes(spark, scratch, put):
    day = 86_400
    given = [[line(0), line(5, 2, 2), line(6, 2, 2)], [line(day)], [line(2 * day)], [line(7)], [line(4 * day)]]
    for n, batch in enumerate(given):
        where = put(n, batch)
    table, query = run(spark, scratch, where, closing.closed_days, closing.DAY)
    assert tuples(table.closed()) == [
        ("20180629", "1", "1", 1, 1), ("20180629", "1", "1", 2, 2), ("20180630", "1", "1", 1, 1),
        ("20180701", "1", "1", 1, 1),
    ]
    assert [r["user_id"] for r in table.late().collect()] == [1]
    assert query.lastProgress.stateOperators[0].numRowsTotal == 1


def test_batches_without_clicks(spark, scratch, put):
    where = put(0, ["abc"])
    table, _ = run(spark, scratch, where)
    put(1, [line(0)])
    table, _ = run(spark, scratch, where)
    assert tuples(table.closed()) == tuples(table.late()) == []
    assert table.clock.newest()[0]["newest"] == int(START.timestamp() * 1000)


def test_clock(spark, scratch):
    table = closing.ClosedTable(spark, f"{scratch}/c", schemas.AD_CLICK_TREND)
    told = [table.tick(batch, newest) for batch, newest in enumerate([5, 9, None, 7, 20, 1])]
    assert told == [None, None, 5, 9, 9, 9]
    assert table.tick(5, 1) == 9 and table.tick(6, None) == 20
