"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import hard_negatives
from visitlens.llm.suffix_index import Rows, SuffixIndex

SCHEMA = "vec_id long, label int, vector array<double>, anchor boolean"


def brute(rows, wanted=5, window=10):
    """All pairs in Python integers; rows as (id, label, vector, anchor)."""
    rows = [
        r for r in rows
        if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[2])
    ]
    out = []

    def inner(a, b):
        return sum(int(x) * int(y) for x, y in zip(a, b))

    for ident, label, vector, anchor in rows:
        if not anchor:
            continue
        scored = sorted(
            ((-inner(vector, v), i, lab) for i, lab, v, _ in rows), key=lambda s: (s[0], s[1])
        )
        for p, pid, lab in [s for s in scored if s[2] == label and s[1] != ident][:wanted]:
            fit = [s for s in scored if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p]
            out += [
                (ident, pid, k, nid, -p, -n) for k, (n, nid, _) in enumerate(fit[:window], 1)
            ]
    return sorted(out)


def mined(spark, rows, **how):
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted(tuple(r) for r in found.collect())


def random_rows(n, dims, seed, labels=4, spread=60):
    draw = np.random.default_rng(seed)
    values = np.floor(draw.normal(size=(n, dims)) * spread)
    return [(i, int(draw.integers(labels)), values[i].tolist(), i % 20 == 0) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 8, 24, 64])
@pytest.mark.parametrize("share", [-0.5, 0.0, 0.3, 0.7])
def test_pairs_that_reach_their_floor(dims, share):
    draw = np.random.default_rng(dims)
    # columns of falling weight, so that rows are listed to different depths
    rows = np.floor(draw.normal(size=(400, dims)) * 50 * 0.8 ** np.arange(dims))
    asking = rows[::9]
    exact = asking @ rows.T
    floors = share * np.sqrt((asking**2).sum(axis=1)) * 60
    a, r, score = SuffixIndex(rows).pairs(asking, floors)
    assert sorted(zip(a, r)) == sorted(zip(*(exact >= floors[:, None]).nonzero()))
    assert (score == exact[a, r]).all()


def test_rows_are_left_out_of_the_index():
    """High floors keep rows from being multiplied in full."""
    draw = np.random.default_rng(1)
    rows = np.floor(draw.normal(size=(500, 64)) * 100 * 0.9 ** np.arange(64))
    index, asking = SuffixIndex(rows), rows[:10]
    reach = np.sqrt((asking**2).sum(axis=1))
    finished = []
    index._finish = lambda *a: finished.append(len(a[1])) or SuffixIndex._finish(index, *a)
    index.pairs(asking, 0.9 * reach**2)
    assert sum(finished) < 0.1 * 10 * 500


def test_against_all_pairs(spark, monkeypatch):
    rows = random_rows(400, 12, 3)
    assert mined(spark, rows) == brute(rows)
    # many slices and blocks, dealt by place
    monkeypatch.setattr(hard_negatives, "SLICE_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    assert mined(spark, rows) == brute(rows)


def test_ties_and_equal_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, i % 3, [float(x) for x in draw.integers(0, 3, 4)], i % 10 == 0) for i in range(120)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = random_rows(60, 5, 8) + [
        (None, 1, [1.0] * 5, True), (100, None, [1.0] * 5, True), (101, 1, None, True),
        (102, 1, [1.0, None, 1.0, 1.0, 1.0], True), (103, 1, [math.nan] * 5, True),
        (104, 1, [math.inf] * 5, True), (105, 1, [0.0] * 5, True), (106, 9, [50.0] * 5, True),
        (107, 1, [], True), (108, 1, [70.0, 60.0], True),
    ]
    rows[3] = (*rows[3][:3], None)
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [], True), (1, 1, [], False), (2, 2, [], False)]) == brute(
        [(0, 1, [], True), (1, 1, [], False), (2, 2, [], False)]
    )


def test_repeated_rows_each_count_but_never_for_their_own_id(spark):
    rows = random_rows(80, 6, 11)
    rows += rows[:30]
    ours = mined(spark, rows)
    assert ours == brute(rows)
    assert all(a != p for a, p, *_ in ours)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, i % 2, [float(2**28 + 3 * i), float(i - 9)], i < 4) for i in range(30)]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_a_long_become_its_bound(spark):
    rows = [(0, 1, [1e30], True), (1, 1, [2e30], False), (2, 2, [3e30], False), (3, 2, [1e-0], False)]
    limit = (1 << 63) - 1
    assert mined(spark, rows) == []  # 3e60 is as large as the positive's, 1e30 too
    assert Rows(np.array([[2e30]])).pairs(np.array([[1e30]]), np.array([0.0]))[2].tolist() == [limit]


def test_other_columns_and_whole_numbers(spark):
    frame = spark.sql(
        "SELECT array(0.5f, -0.001f, 1e30f) AS v UNION ALL SELECT array(1f, CAST('NaN' AS FLOAT), 0f)"
        " UNION ALL SELECT array(1f, NULL, 0f) UNION ALL SELECT NULL"
    )
    got = [r[0] for r in frame.select(hard_negatives.whole_numbers(F.col("v"), 256)).collect()]
    assert got[0] == [128.0, -1.0, 256 * float(np.float32(1e30))] and got[1:] == [None] * 3
    rows = random_rows(60, 5, 8)
    extra = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"slice": F.lit("x"), "block": F.lit(1), "rank": F.lit(2), "anchor_no": F.lit(5)}
    )
    assert sorted(tuple(r) for r in hard_negatives.mine(extra).collect()) == brute(rows)
