from collections import defaultdict

import duckdb
import pytest

from visitlens.llm import mixing, queries
from visitlens.llm.sql import SQL

SF = "/root/testdata/sf0.001"


def shared(sizes):
    """Targets by repeated resharing; sizes in order of the sources."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    limited, total = set(), sum(sizes)
    while True:
        left = total - sum(3 * sizes[i] for i in limited)
        open_ = [i for i in range(len(sizes)) if i not in limited]
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > 3 * sizes[i]]
        if not over:
            return [
                3 * sizes[i] if i in limited else left * weights[i] / weight
                for i in range(len(sizes))
            ]
        limited.update(over)


@pytest.mark.parametrize("sizes", [[5], [1, 100, 1000], [10, 10, 10, 10], [1, 1, 1, 997], [50, 0]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    for (name, _), want in zip(rows, shared(sizes), strict=True):
        assert got[name] == pytest.approx(want)


def test_mix_reaches_its_targets(spark):
    rows = queries.op4_mixing(spark, SF).collect()
    again = queries.op4_mixing(spark, SF).collect()
    assert sorted(rows) == sorted(again)
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        source = docs[r.doc_id]
        assert r.size * 3 >= r.taken and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        target[source] = r.target
    for source, words in taken.items():
        assert abs(words - target[source]) <= largest[source] / 2


def test_same_as_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    theirs = sorted(db.execute(SQL["op4_mixing"]).fetchall())
    ours = queries.op4_mixing(spark, SF)
    assert sorted(map(tuple, ours.collect())) == theirs


def test_nulls_repeats_and_empty(spark, documents):
    docs = documents(
        (1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "d e", None),
        (5, " \t\n", "y"),
    )
    rows = mixing.mix(docs).collect()
    assert len(rows) == 6
    sizes = {(r.doc_id, r.source): r.mix.size for r in rows}
    assert sizes[(1, "x")] == 3 and sizes[(2, "x")] == 0 and sizes[(None, None)] == 2
    twice = [r.mix.copies for r in rows if r.doc_id == 1]
    assert twice[0] == twice[1]
    assert mixing.mix(documents()).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_hot_source_is_cut_into_slices(spark, documents):
    docs = documents(*((i, "w " * (1 + i % 5), "hot") for i in range(2000)), (9999, "x", "z"))
    keyed = mixing._keyed(docs, "doc_id", "text", "source", mixing.SEED)
    counts = [r["count"] for r in keyed.groupBy("place.slice").count().collect()]
    assert len(counts) > 1000 and max(counts) < 20
