"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from visitlens.llm import queries
from visitlens.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    answer = db.execute(SQL[name])
    names = [c[0] for c in answer.description]
    frame = queries.queries()[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(names)
    ours = sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)
    assert ours == sorted(answer.fetchall(), key=repr)


def test_numbers_of_the_queries():
    found = [name.split("_")[0] for name in queries.queries()]
    assert found == [f"op{n}" for n in range(1, 14)]
