import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import embed_dup, queries
from visitlens.llm.lattice import nearest


def by_force(rows):
    """[(vec_id, vector)] -> {vec_id: (links, component)}."""
    usable = [
        (i, np.array(v, dtype=float)) for i, v in rows
        if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and np.any(v)
    ]
    links = {i: set() for i, _ in rows}
    for (i, a), (j, b) in itertools.combinations(usable, 2):
        if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
            links[i].add(j)
            links[j].add(i)
    label = {i: i for i in links}
    for _ in links:
        for i, others in links.items():
            label[i] = min([label[i], *(label[j] for j in others)])
    return {i: (len(links[i]), label[i]) for i in links}


def told(rows):
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def clusters(rng, groups, size, noise):
    for g in range(groups):
        centre = rng.standard_normal(64)
        for _ in range(size):
            yield (centre + noise * rng.standard_normal(64)).astype(np.float32).tolist()


def test_nearest_lattice_point():
    whole = [v for v in itertools.product([-1, 0, 1], repeat=8) if sum(v) % 2 == 0]
    half = [v for v in itertools.product([-0.5, 0.5], repeat=8) if sum(v) % 2 == 0]
    points = np.array([*whole, *half])
    x = np.random.default_rng(1).uniform(-0.5, 0.5, (200, 8))
    best = ((x[:, None] - points[None]) ** 2).sum(axis=2).min(axis=1)
    found = nearest(x, 2)
    assert np.allclose(((found[0] / 2 - x) ** 2).sum(axis=1), best)
    assert (found[0] != found[1]).any(axis=1).all()


def test_query_against_all_pairs(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = queries.op10_lattice(spark, "/root/testdata/sf0.001").collect()
    assert told(rows) == by_force([(r.vec_id, r.embedding) for r in vectors])


def test_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = list(enumerate([*clusters(rng, 3, 60, 0.1), *clusters(rng, 40, 2, 0.2)]))
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = embed_dup.near_duplicate_vectors(frame.withColumn("node", F.lit(1))).collect()
    assert told(got) == by_force(rows)


def test_recall_near_the_threshold(spark):
    """Pairs of cosine 0.9 to 0.93: at least nine of ten links are found."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        a = rng.standard_normal(64)
        b = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        c = rng.uniform(0.902, 0.93)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = told(embed_dup.near_duplicate_vectors(frame).collect())
    want = by_force(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())


@pytest.mark.parametrize("size", [4, 8, 24, 32, 48, 64, 256])
def test_cells_find_pairs_of_any_dimension(size):
    rng = np.random.default_rng(size)
    one, other = rng.standard_normal((2, 400, size))
    one /= np.linalg.norm(one, axis=1)[:, None]
    other -= (other * one).sum(axis=1)[:, None] * one
    two = 0.9 * one + np.sqrt(1 - 0.81) * other / np.linalg.norm(other, axis=1)[:, None]
    a, b = embed_dup.cells(one), embed_dup.cells(two)
    met = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
    assert met.any(axis=1).mean() >= 0.93


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 0.0]), (10, [1.0, 2.0])]
    frame = spark.createDataFrame([*rows, (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = embed_dup.near_duplicate_vectors(frame).collect()
    assert {k: v for k, v in told(got).items() if k is not None} == by_force(rows)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    assert embed_dup.near_duplicate_vectors(frame.where("false")).count() == 0


def by_rows(rows):
    """The same for rows whose ids may repeat: [(id, links, component)]."""
    unit = []
    for _, v in rows:
        v = np.array(v, dtype=np.longdouble)
        unit.append(v / np.abs(v).max() / np.sqrt(((v / np.abs(v).max()) ** 2).sum()))
    near = [
        {j for j in range(len(rows)) if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9}
        for i in range(len(rows))
    ]
    label = [i for i, _ in rows]
    for _ in rows:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
    return sorted((r[0], len(near[i]), label[i]) for i, r in enumerate(rows))


def test_ids_that_repeat_lose_no_link(spark):
    a, b = [1.0, 0.0, 0.5], [0.0, 1.0, -0.5]
    rows = [(1, a), (1, b), (2, b), (3, b)]
    rng = np.random.default_rng(3)
    many = [(int(rng.integers(0, 60)), v) for v in clusters(rng, 12, 9, 0.05)] + [(7, b), (7, b), (8, a)]
    for given in (rows, many):
        frame = spark.createDataFrame(given, "vec_id long, embedding array<float>")
        got = embed_dup.near_duplicate_vectors(frame).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == by_rows(given)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_very_large_and_very_small_vectors(spark):
    rows = [(1, [1e200, 2e200]), (2, [1.0, 2.0]), (3, [1e-200, 2.1e-200]), (4, [5e-324, 0.0]), (5, [1e308, 1.0]),
            (6, [0.0, -0.0]), (7, [3.0, -0.0]), (8, [3.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = told(embed_dup.near_duplicate_vectors(frame).collect())
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (3, 4), 5: (3, 4), 6: (0, 6), 7: (3, 4), 8: (3, 4)}
