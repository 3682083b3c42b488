"""The jobs give the same result tables as their operators one by one."""

from __future__ import annotations

import pytest
from frame_rows import tuples

import __spark_entry__ as registered
from visitlens.operators import sampling, sessions
from visitlens.plans import jobs
from visitlens.sources import derived

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "session_random_extract": "taskid sessionid startTime searchKeywords clickCategoryIds",
    "top10_category": "taskid categoryid clickCount orderCount payCount",
    "top10_session": "taskid categoryid sessionid clickCount",
    "page_split_convert_rate": "taskid rateStr",
    "area_top3_product": (
        "taskid area areaLevel productid cityInfos clickCount productName productStatus"
    ),
}


@pytest.fixture(scope="module")
def inputs(spark):
    return derived.visit_actions(spark, FOLDER), derived.user_info(spark, FOLDER)


@pytest.mark.parametrize("params", [registered.PARAMS, registered.SEARCHERS])
def test_session_job(spark, inputs, params):
    actions, users = inputs
    got = jobs.run_session_job(actions, users, params, "task-1", 300, seed=7)
    matching = sessions.matching_sessions(actions, users, params)
    ratios = sessions.session_bucket_ratios(matching)
    assert tuples(got["session_aggr_stat"]) == [("task-1", *ratios.first())]
    assert got["session_aggr_stat"].columns[:2] == ["taskid", "session_count"]
    assert len(got["session_aggr_stat"].columns) == 17

    sample = sampling.session_stratified_sample(
        sessions.user_sessions(actions, users), 300, seed=7
    )
    drawn = tuples(got["session_random_extract"], "sessionid")
    assert drawn and drawn == tuples(sample, "session_id")

    counts = {}
    kept = {r.session_id for r in matching.collect()}
    for row in actions.collect():
        if row.session_id in kept:
            for kind, ids in enumerate(
                (
                    str(row.click_category_id) if row.click_category_id != -1 else None,
                    row.order_category_ids,
                    row.pay_category_ids,
                )
            ):
                for category in (ids or "").split(",") if ids else []:
                    total = counts.setdefault(int(category), [0, 0, 0])
                    total[kind] += 1
    top = sorted(counts.items(), key=lambda c: ([-n for n in c[1]], c[0]))[:10]
    assert tuples(got["top10_category"]) == sorted(
        (("task-1", category, *n) for category, n in top), key=repr
    )
    for name in ("session_random_extract", "top10_category", "top10_session"):
        assert got[name].columns == COLUMNS[name].split()


def test_top_sessions_of_the_job(spark, inputs):
    actions, users = inputs
    got = jobs.run_session_job(actions, users, registered.PARAMS, "task-1")
    assert tuples(got["top10_session"]) == tuples(
        registered.queries()["top_sessions_per_category"](spark, FOLDER)
    )


def test_page_and_area_jobs(spark, inputs):
    actions, _ = inputs
    page = jobs.run_page_job(actions, registered.PARAMS, "task-1", ("event_id",))
    area = jobs.run_area_job(
        spark, actions, derived.product_info(spark, FOLDER), registered.PARAMS, "task-1"
    )
    queries = registered.queries()
    for got, name, query in (
        (page, "page_split_convert_rate", "page_flow_conversion"),
        (area, "area_top3_product", "area_top3_product_result"),
    ):
        assert got[name].columns == COLUMNS[name].split()
        assert tuples(got[name]) == tuples(queries[query](spark, FOLDER))
