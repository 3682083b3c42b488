"""Catalog tables by date and by bucket, chunked lists, counts that come along."""

from __future__ import annotations

import uuid

import pytest
from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens.operators import lists, sessions
from visitlens.session import materialize
from visitlens.sinks import tables
from visitlens.sources import tables as sources


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_replaced_table_at_a_path(spark, actions, scratch, name):
    rows = actions([{"date": f"2018-06-{d:02d}", "page_id": d} for d in range(1, 11)])
    for given in (rows.where("page_id < 4"), rows):
        tables.overwrite_table(given, name, ["date"], f"{scratch}/t")
    some = sources.in_date_range(sources.read_actions(spark, name), "2018-06-03", "2018-06-04")
    assert sorted(r.page_id for r in some.collect()) == [3, 4]
    assert "PartitionFilters: [isnotnull(date" in plan(some)
    scanned = some.select(F.input_file_name()).distinct().collect()
    assert {r[0].split("date=")[1][:10] for r in scanned} == {"2018-06-03", "2018-06-04"}


@pytest.fixture
def bucketed(spark, scratch):
    def store(rows, n=8):
        stored = f"b_{uuid.uuid4().hex}"
        tables.overwrite_bucketed(rows, stored, "user_id", n, f"{scratch}/{stored}")
        return spark.table(stored)

    return store


def test_bucketed_tables_join_without_a_shuffle(spark, users, bucketed):
    known = users(*((i, 20 + i % 40, "p", "c", "male") for i in range(300)))
    visits = spark.range(900).selectExpr("id % 300 AS user_id", "id AS session_id")
    left, right = bucketed(visits), bucketed(known)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sessions.with_user(left, right)
        assert joined.count() == 900
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "Exchange" in plan(sessions.with_user(visits, known))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_opens_the_buckets_of_its_keys(spark, bucketed):
    stored = bucketed(spark.range(400).withColumnRenamed("id", "user_id"))
    assert tuples(sources.lookup(stored, "user_id", [7])) == [(7,)]
    assert len(stored.inputFiles()) == 8
    # Without a join the scan packs small files, prunes alike, but doesn't show it.
    conf = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(conf, "false")
    try:
        found = sources.lookup(stored, "user_id", [7])
        assert tuples(found) == [(7,)]
        assert "SelectedBucketsCount: 1 out of 8" in plan(found)
    finally:
        spark.conf.unset(conf)
    assert tuples(sources.lookup(stored, "user_id", [3, 7, 5000])) == [(3,), (7,)]


def chunks(rows, size):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, set()).add(v)
    return sorted(
        (
            (g, i // size, len(vs[i : i + size]), ",".join(map(str, vs[i : i + size])))
            for g, vs in ((g, sorted(values)) for g, values in groups.items())
            for i in range(0, len(vs), size)
        ),
        key=repr,
    )


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_of_distinct_values(spark, size):
    rows = [(None if i % 11 == 0 else "ab"[i % 5 > 1], i * 7 % 90 if i % 13 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    assert tuples(lists.concat_distinct_chunks(df, ["g"], "v", size)) == chunks(rows, size)
    assert tuples(lists.concat_distinct_chunks(df.limit(0), ["g"], "v", size)) == []


def test_a_group_spreads_over_ranges(spark):
    conf, before = "spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(conf, "false")  # else small ranges are joined
    try:
        df = spark.range(4000).selectExpr("'one' AS g", "id % 3000 AS v")
        got = tuples(lists.concat_distinct_chunks(df, ["g"], "v", 100))
    finally:
        spark.conf.set(conf, before)
    assert got == chunks([("one", v) for v in range(3000)], 100)


def test_counts_come_along_with_the_write(spark, actions, users):
    rows = actions([
        {"session_id": f"s{i}", "action_time": f"2018-06-25 10:00:{t:02d}"}
        for i in range(40) for t in range(0, i % 25 + 1, 3)
    ])
    found = sessions.user_sessions(rows, users((1, 30, "p", "c", "male")))
    observed, counts = sessions.observed_sessions(found)
    stored = materialize(observed, "observed")
    assert tuples(stored) == tuples(found)
    assert tuples(sessions.observed_bucket_ratios(spark, counts)) == tuples(
        sessions.session_bucket_ratios(found)
    )


def test_counts_are_taken_in_the_last_stage(spark, actions, users):
    """Only there each task counts once: every shuffle lies below."""
    found = sessions.user_sessions(actions([{}]), users((1, 30, "p", "c", "male")))
    observed, _ = sessions.observed_sessions(found)
    text = plan(observed)
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_counts_without_sessions(spark, actions, users):
    found = sessions.user_sessions(actions([]), users((1, 30, "p", "c", "male")))
    observed, counts = sessions.observed_sessions(found)
    materialize(observed, "observed")
    assert tuples(sessions.observed_bucket_ratios(spark, counts)) == tuples(
        sessions.session_bucket_ratios(found)
    )
