"""Every registered query against its SQL equivalent, at the smallest scale."""

from __future__ import annotations

import functools
import os

import duckdb
import pytest

import __spark_entry__ as registered
from check import KINDS, TABLES, normal

FOLDER = "/root/testdata/sf0.001"
# The corpus queries have tests of their own.
CORE = [query.__name__ for query in registered._QUERIES]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def pipelines_run_once():
    """Queries that show different tables of the same run share it here."""
    with pytest.MonkeyPatch.context() as patched:
        for name in ("_after_pipeline", "_after_feedback", "_after_restarts", "_session_job"):
            patched.setattr(registered, name, functools.cache(getattr(registered, name)))
        yield


def test_every_query_has_sql():
    assert set(CORE) <= set(registered.queries()) & set(registered.oracle_sql())


@pytest.mark.parametrize("name", CORE)
def test_query(spark, db, name):
    df = registered.queries()[name](spark, FOLDER)
    answer = db.execute(registered.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    kinds = {c[0]: KINDS.get(str(c[1]), str(c[1])) for c in answer.description}
    assert dict(df.dtypes) == kinds
    assert normal(df.collect(), df.columns) == normal(answer.fetchall(), names)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
