from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from frame_rows import tuples

from visitlens.operators import funnel

DAYS = ("2018-06-25", "2018-06-25")


def visits(actions, *sequences):
    return actions(
        [
            {
                "session_id": f"s{n}",
                "page_id": page,
                "action_time": f"2018-06-25 10:{10 * i:02d}:00",
            }
            for n, pages in enumerate(sequences)
            for i, page in enumerate(pages)
        ]
    )


def test_rates(actions):
    rows = visits(actions, [1, 2, 3], [1, 2, 1], [2, 3])
    steps = funnel.page_flow_steps(rows, *DAYS, [1, 2, 3])
    assert tuples(steps) == [(1, "1_2", 2, 2 / 3), (2, "2_3", 2, 1.0)]
    text = funnel.page_flow_conversion(steps).first().rate_str
    assert text == "1_2=0.6666666666666666|2_3=1.0"


def test_unseen_pair(actions):
    rows = visits(actions, [1, 2, 3], [1, 2, 1], [2, 3])
    steps = funnel.page_flow_steps(rows, *DAYS, [1, 9, 2])
    assert tuples(steps) == [(1, "1_9", 0, 0.0), (2, "9_2", 0, None)]
    assert funnel.page_flow_conversion(steps).first().rate_str == "1_9=0.0|9_2=null"


def test_repeated_pair_keeps_both_steps(actions):
    rows = visits(actions, [1, 2, 1, 2])
    steps = funnel.page_flow_steps(rows, *DAYS, [1, 2, 1, 2])
    assert tuples(steps) == [(1, "1_2", 2, 1.0), (2, "2_1", 1, 0.5), (3, "1_2", 2, 2.0)]


def test_order_is_by_time_not_text(actions):
    rows = actions(
        [
            {"page_id": 2, "action_time": "2018-06-25 15:00:00"},
            {"page_id": 1, "action_time": "2018-06-25 5:03:04"},
        ]
    )
    assert tuples(funnel.page_flow_steps(rows, *DAYS, [1, 2])) == [(1, "1_2", 1, 1.0)]


def test_date_range_and_empty_input(actions):
    rows = visits(actions, [1, 2])
    steps = funnel.page_flow_steps(rows, "2018-06-26", "2018-06-30", [1, 2])
    assert tuples(steps) == [(1, "1_2", 0, None)]
    with pytest.raises(ValueError):
        funnel.page_flow_steps(rows, *DAYS, [1])


@pytest.mark.parametrize("slot", [1, 60, 600, 86_400])
def test_slots_do_not_change_the_result(spark, slot):
    """One session with a third of all rows, many equal times, any slot width."""
    chance = random.Random(3)
    start = datetime(2018, 6, 25)
    rows = []
    for i in range(3000):
        session = "hot" if chance.random() < 0.34 else f"s{chance.randrange(40)}"
        when = start + timedelta(seconds=chance.randrange(2000))
        rows.append(("2018-06-25", session, chance.randrange(4), str(when), i))
    frame = spark.createDataFrame(
        rows, "date string, session_id string, page_id bigint, action_time string, event_id bigint"
    )
    flow = [1, 2, 3, 1]
    counts = {pair: 0 for pair in zip(flow, flow[1:])}
    paths: dict[str, list] = {}
    for _, session, page, when, i in rows:
        paths.setdefault(session, []).append((when, i, page))
    for path in paths.values():
        pages = [page for *_, page in sorted(path)]
        for pair in zip(pages, pages[1:]):
            if pair in counts:
                counts[pair] += 1
    first = sum(1 for row in rows if row[2] == 1)
    a, b, c = (counts[p] for p in zip(flow, flow[1:]))
    steps = funnel.page_flow_steps(frame, *DAYS, flow, ("event_id",), slot)
    assert tuples(steps) == [
        (1, "1_2", a, a / first),
        (2, "2_3", b, b / a),
        (3, "3_1", c, c / b),
    ]
