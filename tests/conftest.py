from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from visitlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/shared",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def actions(spark):
    """Build user_visit_action rows from partial ones."""
    from visitlens import schemas

    def build(rows):
        blank = dict.fromkeys(schemas.USER_VISIT_ACTION.names)
        usual = {
            "date": "2018-06-25",
            "user_id": 1,
            "session_id": "s",
            "page_id": 1,
            "action_time": "2018-06-25 10:00:00",
            "click_category_id": -1,
            "click_product_id": -1,
            "city_id": 0,
        }
        full = [{**blank, **usual, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(r[c] for c in schemas.USER_VISIT_ACTION.names) for r in full],
            schemas.USER_VISIT_ACTION,
        )

    return build


@pytest.fixture
def users(spark):
    from visitlens import schemas

    def build(*rows):
        return spark.createDataFrame(
            [
                (uid, f"user{uid}", f"name{uid}", age, prof, city, sex)
                for uid, age, prof, city, sex in rows
            ],
            schemas.USER_INFO,
        )

    return build
