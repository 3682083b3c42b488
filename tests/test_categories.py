from __future__ import annotations

from frame_rows import tuples

from visitlens.operators import categories


def test_counts_from_clicks_and_lists(actions):
    rows = actions(
        [
            {"click_category_id": 3},
            {"click_category_id": 3},
            {"click_category_id": None},
            {"order_category_ids": "3,8"},
            {"order_category_ids": ""},
            {"pay_category_ids": "8"},
            {"pay_category_ids": "8,9,8,"},
            {"click_category_id": 4, "order_category_ids": "4"},
        ]
    )
    assert tuples(categories.category_click_count(rows)) == [(3, 2), (4, 1)]
    assert tuples(categories.category_order_count(rows)) == [(3, 1), (4, 1), (8, 1)]
    assert tuples(categories.category_pay_count(rows)) == [(8, 3), (9, 1)]
    full = categories.category_full_counts(categories.session_category_counts(rows))
    assert tuples(full) == [(3, 2, 1, 0), (4, 1, 1, 0), (8, 0, 1, 3), (9, 0, 0, 1)]


def counts(spark, rows):
    return spark.createDataFrame(
        rows,
        "session_id string, category_id bigint, click_count bigint, order_count bigint,"
        " pay_count bigint",
    )


def test_top_order(spark):
    rows = counts(
        spark,
        [("a", 1, 2, 1, 9), ("b", 1, 3, 0, 0), ("a", 2, 5, 2, 0), ("a", 3, 6, 0, 0)]
        + [("z", 10 + i, 1, 0, 0) for i in range(20)],
    )
    top = [tuple(r) for r in categories.top_categories(rows).collect()]
    assert top[:3] == [(3, 6, 0, 0), (2, 5, 2, 0), (1, 5, 1, 9)]
    assert [r[0] for r in top[3:]] == list(range(10, 17))  # ties: lowest ids


def test_differences_beyond_32_bits(spark):
    rows = counts(spark, [("a", 1, 2**33, 0, 0), ("a", 2, 1, 0, 0)])
    assert [r.category_id for r in categories.top_categories(rows).collect()] == [1, 2]


def test_top_sessions(spark):
    rows = counts(
        spark,
        [(f"s{i:02d}", 1, 5, 0, 0) for i in range(12)]
        + [("big", 1, 9, 0, 0), ("none", 1, 0, 3, 0), ("x", 2, 1, 0, 0), ("y", 3, 1, 0, 0)],
    )
    wanted = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    got = tuples(categories.top_sessions_per_category(rows, wanted))
    assert got == sorted(
        [(1, "big", 9), (2, "x", 1)] + [(1, f"s{i:02d}", 5) for i in range(9)], key=repr
    )


def test_only_given_sessions_count(spark):
    rows = counts(spark, [("a", 1, 1, 0, 0), ("b", 1, 5, 0, 0)])
    kept = spark.createDataFrame([("a",)], "session_id string")
    got = categories.category_full_counts(categories.counts_of_sessions(rows, kept))
    assert tuples(got) == [(1, 1, 0, 0)]


def test_many_categories_are_not_forced_into_a_broadcast(spark):
    counts = spark.range(3).selectExpr(
        "'s' AS session_id", "id AS category_id", "id + 1 AS click_count", "0L AS order_count",
        "0L AS pay_count",
    )
    wanted = spark.range(200_000).withColumnRenamed("id", "category_id")
    top = categories.top_sessions_per_category(counts, wanted)
    assert top.count() == 3
    assert "broadcast" not in top._jdf.queryExecution().analyzed().toString().lower()
