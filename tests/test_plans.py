"""What the planner makes of the queries: the properties that hold at scale."""

from __future__ import annotations

import random
import re
from contextlib import contextmanager

import pytest

import __spark_entry__ as registered
from visitlens import schemas
from visitlens.operators import ads, categories, sessions
from visitlens.sources import tables

FOLDER = "/root/testdata/sf0.001"
# The corpus queries have tests of their own; what streams return is a plain read.
CORE = [q.__name__ for q in registered._QUERIES if not q.__name__.startswith("stream_")]


def plan(df, final=False):
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **given):
    given = {k.replace("__", "."): v for k, v in given.items()}
    before = {k: spark.conf.get(k, None) for k in given}
    for key, value in given.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", CORE)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(registered.queries()[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize(
    "name",
    ["area_top3_products", "top_sessions_per_category", "ad_province_top3", "area_top3_sql"],
)
def test_ranking_cuts_groups_before_the_shuffle(spark, name):
    text = plan(registered.queries()[name](spark, FOLDER))
    assert re.search(r"WindowGroupLimit .* Final(.|\n)*Exchange(.|\n)*WindowGroupLimit .* Partial", text)


def test_session_ranking_shuffles_the_actions_once(spark):
    text = plan(registered.queries()["top_sessions_per_category"](spark, FOLDER), final=True)
    final = text.split("Initial Plan")[0]
    assert "ReusedExchange" in final
    # Once for the category counts and once for the session filter.
    assert final.count("events.parquet") == 2


def test_global_top_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(registered.queries()["top_categories"](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark, actions, scratch):
    actions([{}]).write.parquet(f"{scratch}/actions")
    stored = tables.read_actions(spark, f"{scratch}/actions")
    text = plan(tables.in_date_range(stored, "2018-06-01", "2018-06-30").select("user_id"))
    assert "GreaterThanOrEqual(date,2018-06-01), LessThanOrEqual(date,2018-06-30)" in text
    assert "ReadSchema: struct<date:string,user_id:bigint>" in text


def test_bucket_shares_read_neither_lists_nor_unused_columns(spark, actions, users, scratch):
    actions([{}]).write.parquet(f"{scratch}/actions")
    stored = tables.read_actions(spark, f"{scratch}/actions")
    found = sessions.user_sessions(stored, users((1, 30, "p", "c", "male")))
    text = plan(sessions.session_bucket_ratios(found))
    assert "collect_set" not in text
    assert "ReadSchema: struct<user_id:bigint,session_id:string,action_time:string>" in text


def skewed(spark):
    """Rows of which a third share one session and user."""
    chance = random.Random(1)
    keys = [1 if chance.random() < 0.34 else 2 + chance.randrange(5000) for _ in range(30_000)]
    return spark.createDataFrame(
        [(f"s{k}", k, f"{chance.random()}") for k in keys],
        "session_id string, user_id bigint, payload string",
    )


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def test_hot_session_is_split_in_the_detail_join(spark):
    rows = skewed(spark)
    wanted = rows.groupBy("session_id").count()
    with settings(spark, **SMALL):
        detail = sessions.filtered_session_detail(rows, wanted)
        assert detail.count() == rows.count()
        assert "skew=true" in plan(detail, final=True)


def test_hot_user_is_split_in_the_session_join(spark, users):
    rows = skewed(spark)
    people = users(*[(k, 30, "p", "c", "male") for k in range(5003)])
    with settings(spark, **SMALL):
        joined = sessions.with_user(rows, people)
        assert joined.count() == rows.count()
        assert "skew=true" in plan(joined, final=True)


def test_hot_user_is_split_in_the_blacklist_join(spark):
    rows = skewed(spark)
    counts = spark.createDataFrame(
        [("2018-06-01", 5, 1, 100), ("2018-06-01", 1, 1, 99)], schemas.AD_USER_CLICK_COUNT
    )
    listed = ads.ad_blacklist_update(counts)
    with settings(spark, **SMALL):
        kept = ads.ad_blacklist_filter(rows, listed)
        assert kept.count() == rows.where("user_id <> 5").count()
        assert "skew=true" in plan(kept, final=True)


def test_hot_category_shrinks_before_any_join(spark, actions):
    counts = categories.session_category_counts(actions([{"click_category_id": 1}] * 50))
    kept = categories.counts_of_sessions(
        counts, spark.createDataFrame([("s",)], "session_id string")
    )
    text = plan(kept)
    assert text.index("LeftSemi") < text.index("partial_count")
    assert kept.first().click_count == 50
