from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from frame_rows import tuples

from visitlens.operators import sessions
from visitlens.params import TaskParams

BASE = datetime(2018, 6, 25, 5, 0, 0)


def at(seconds):
    return (BASE + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def params(**given):
    return TaskParams.from_dict({"startDate": "2018-06-01", "endDate": "2018-06-30", **given})


@pytest.fixture
def two_users(users):
    return users((1, 30, "p1", "city1", "male"), (2, 60, "p2", "city2", "female"))


def test_aggregate(actions, two_users):
    rows = actions(
        [
            {"action_time": "2018-06-25 15:00:00", "search_keyword": "新辣道鱼火锅"},
            {"action_time": "2018-06-25 5:03:04", "search_keyword": "火锅"},
            {"search_keyword": "火锅"},
            {"search_keyword": ""},
            {"click_category_id": 50},
            {"click_category_id": 44},
            {"click_category_id": 44},
            {"click_category_id": None},
            {"session_id": "unknown", "user_id": 9},
        ]
    )
    (row,) = sessions.session_aggregate(rows, two_users).collect()
    assert row.session_id == "s"
    assert row.start_time == datetime(2018, 6, 25, 5, 3, 4)
    assert row.visit_length == 9 * 3600 + 56 * 60 + 56
    assert row.step_length == 8
    assert row.search_keywords == sorted(["火锅", "新辣道鱼火锅"])
    assert row.click_category_ids == [44, 50]
    assert (row.age, row.professional, row.city, row.sex) == (30, "p1", "city1", "male")


def test_facts_agree_with_aggregate(actions, two_users):
    rows = actions(
        [
            {"session_id": f"s{i % 7}", "user_id": 1 + i % 7 % 2, "action_time": at(i * i)}
            for i in range(60)
        ]
    )
    full = sessions.session_aggregate(rows, two_users)
    lean = sessions.user_sessions(rows, two_users)
    assert tuples(full.select(*lean.columns)) == tuples(lean)


@pytest.fixture
def varied(actions):
    return actions(
        [
            {"session_id": "a", "user_id": 1, "search_keyword": "kw1"},
            {"session_id": "a", "user_id": 1, "click_category_id": 15},
            {"session_id": "b", "user_id": 2, "search_keyword": "kw2"},
            {"session_id": "b", "user_id": 2, "click_category_id": 5},
            {"session_id": "c", "user_id": 3, "search_keyword": "kw1"},
            {"session_id": "d", "user_id": 1},
        ]
    )


@pytest.mark.parametrize(
    ("given", "kept"),
    [
        ({}, "abcd"),
        (dict.fromkeys(["startAge", "endAge", "sex", "keywords", "categoryIds"], ""), "abcd"),
        ({"startAge": "99", "endAge": ""}, "abcd"),
        ({"startAge": "30", "endAge": "60"}, "abd"),
        ({"startAge": "31", "endAge": "60"}, "b"),
        ({"professionals": "p2,p3"}, "bc"),
        ({"cities": "city1"}, "ad"),
        ({"sex": "female"}, "b"),
        ({"keywords": "kw1,other"}, "ac"),
        ({"categoryIds": "5"}, "b"),
        ({"categoryIds": "5,15", "sex": "male"}, "a"),
    ],
)
def test_filter_and_its_lean_form(actions, users, varied, given, kept):
    people = users(
        (1, 30, "p1", "city1", "male"),
        (2, 60, "p2", "city2", "female"),
        (3, None, "p3", "city3", None),
    )
    chosen = params(**given)
    full = sessions.session_filter(sessions.session_aggregate(varied, people), chosen)
    lean = sessions.matching_sessions(varied, people, chosen)
    assert "".join(sorted(r.session_id for r in full.collect())) == kept
    assert "".join(sorted(r.session_id for r in lean.collect())) == kept


def test_detail(spark, varied):
    wanted = spark.createDataFrame([("a",), ("a",), ("d",)], "session_id string")
    detail = sessions.filtered_session_detail(varied, wanted)
    assert detail.columns == varied.columns
    assert sorted(r.session_id for r in detail.collect()) == ["a", "a", "d"]


def shares(spark, lengths, steps):
    rows = spark.createDataFrame(
        list(zip(lengths, steps)), "visit_length bigint, step_length bigint"
    )
    return sessions.session_bucket_ratios(rows).first().asDict()


def test_visit_length_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    got = shares(spark, lengths, [1] * len(lengths))
    assert got["session_count"] == 18
    for name, *_ in sessions.VISIT_LENGTHS[:-1]:
        assert got[f"{name}_ratio"] == 0.11  # 2 of 18
    assert got["visit_length_30m_ratio"] == 0.06  # 1 of 18


def test_step_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    got = shares(spark, [0] * len(steps), steps)
    for name, *_ in sessions.STEP_LENGTHS[:-1]:
        assert got[f"{name}_ratio"] == 0.18  # 2 of 11
    assert got["step_length_60_ratio"] == 0.09


@pytest.mark.parametrize(("n", "total", "share"), [(1, 8, 0.13), (29, 200, 0.15)])
def test_share_rounds_half_up(spark, n, total, share):
    got = shares(spark, [1] * n + [0] * (total - n), [1] * total)
    assert got["visit_length_1s_3s_ratio"] == share


def test_no_session(spark):
    got = shares(spark, [], [])
    assert got.pop("session_count") == 0
    assert set(got.values()) == {None}


def test_words_and_categories_do_not_multiply(spark, actions, users):
    rows = actions(
        [{"search_keyword": f"w{i}", "click_category_id": j} for i in range(12) for j in range(9)]
    )
    items = sessions._items(rows).select("kind", "word", "category").distinct()
    assert items.count() == 12 + 9
    (row,) = sessions.session_aggregate(rows, users((1, 30, "p", "c", "male"))).collect()
    assert row.step_length == 108
    assert len(row.search_keywords) == 12 and row.click_category_ids == list(range(9))
    long = sessions.session_terms_long(rows)
    assert long.count() == 21 and set(long.columns) == {"session_id", "kind", "value"}
