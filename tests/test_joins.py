from __future__ import annotations

from frame_rows import tuples

from visitlens.operators.joins import rows_with_key, rows_without_key


def test_null_keys_match_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert tuples(rows_with_key(rows, keys, "k"), "v") == [("a",), ("b",)]
    assert tuples(rows_without_key(rows, keys, "k"), "v") == [("c",), ("d",)]
    assert rows_with_key(rows, keys, "k").columns == ["k", "v"]
