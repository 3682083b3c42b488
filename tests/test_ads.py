from __future__ import annotations

from datetime import datetime

import pytest
from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens import schemas
from visitlens.operators import ads
from visitlens.sources import adlog


@pytest.fixture
def clicks(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(datetime.fromisoformat(ts), p, p, u, a) for ts, p, u, a in rows],
            schemas.AD_CLICK,
        )

    return build


LINES = [
    ("1530262617000 3 4 42 7", True),
    ("1530262617000 3 4 42 7 more", True),
    ("abc 1 1", False),
    ("", False),
    (None, False),
    ("x 3 3 42 7", False),
    ("1530262617000 3 3 u 7", False),
    ("1530262617000 3 3 42", False),
    ("1530262617000 3 3 42 a", False),
    ("9223372036854775807 3 3 42 7", False),
    ("99999999999999999999 3 3 42 7", False),
]


def test_parse_and_reject(spark):
    lines = spark.createDataFrame([(line,) for line, _ in LINES], "value string")
    good = adlog.parse_ad_log(lines)
    assert good.schema.names == schemas.AD_CLICK.names
    assert tuples(good) == [(datetime(2018, 6, 29, 8, 56, 57), "3", "4", 42, 7)] * 2
    rejected = sorted(str(r.value) for r in adlog.rejected_ad_lines(lines).collect())
    assert rejected == sorted(str(line) for line, ok in LINES if not ok)


def test_kafka_options():
    assert adlog.kafka_options("a:9092,b:9092", "clicks") == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "subscribe": "clicks",
        "startingOffsets": "latest",
    }


def test_threshold_boundary(spark):
    counts = spark.createDataFrame(
        [("2018-06-01", 1, 1, 99), ("2018-06-01", 2, 1, 100), ("2018-06-03", 3, 1, 150)]
        + [("2018-06-02", 3, 2, 101), ("2018-06-01", 4, 1, 60), ("2018-06-01", 4, 2, 60)],
        schemas.AD_USER_CLICK_COUNT,
    )
    assert tuples(ads.ad_blacklist_update(counts)) == [("2018-06-01", 2), ("2018-06-02", 3)]
    listed = spark.createDataFrame([("2018-05-01", 3)], schemas.AD_BLACKLIST)
    assert tuples(ads.ad_blacklist_update(counts, listed)) == [("2018-06-01", 2)]


def test_filter_and_counts(spark, clicks):
    rows = clicks(
        ("2018-06-29T10:00:00", "a", 1, 5),
        ("2018-06-29T10:00:30", "a", 1, 5),
        ("2018-06-30T10:00:30", "a", 1, 5),
        ("2018-06-29T10:00:00", "b", 2, 5),
    )
    listed = spark.createDataFrame([("2018-06-01", 2)], schemas.AD_BLACKLIST)
    kept = ads.ad_blacklist_filter(rows, listed)
    assert kept.columns == rows.columns
    assert tuples(ads.ad_user_daily_clicks(kept)) == [
        ("2018-06-29", 1, 5, 2),
        ("2018-06-30", 1, 5, 1),
    ]
    assert tuples(ads.ad_realtime_stat(rows)) == [
        ("20180629", "a", "a", 5, 2),
        ("20180629", "b", "b", 5, 1),
        ("20180630", "a", "a", 5, 1),
    ]


def test_province_ties_take_lowest_ads(spark):
    stat = spark.createDataFrame(
        [("20180629", "p", "c1", 9, 2), ("20180629", "p", "c2", 9, 2)]
        + [("20180629", "p", "c1", ad, 3) for ad in (5, 3, 4)]
        + [("20180630", "p", "c1", 1, 1)],
        schemas.AD_STAT,
    )
    assert tuples(ads.ad_province_top3(stat)) == [
        ("20180629", "p", 3, 3),
        ("20180629", "p", 4, 3),
        ("20180629", "p", 9, 4),
        ("20180630", "p", 1, 1),
    ]
    overall = ads.ad_province_top3(stat, partition_by=("province",))
    assert "20180630" not in [row[0] for row in tuples(overall)]


def test_trend(clicks):
    rows = clicks(
        ("2018-06-29T10:00:10", "a", 1, 5),
        ("2018-06-29T10:00:50", "a", 1, 5),
        ("2018-06-29T10:01:00", "a", 1, 5),
        ("2018-06-29T09:00:59", "a", 1, 5),
    )
    recent = [("20180629", "10", "00", 5, 2), ("20180629", "10", "01", 5, 1)]
    old = ("20180629", "09", "00", 5, 1)
    assert tuples(ads.ad_click_trend(rows)) == recent
    earlier = F.lit("2018-06-29 09:59:59").cast("timestamp")
    assert tuples(ads.ad_click_trend(rows, as_of=earlier)) == [old]
    assert tuples(ads.ad_minute_counts(rows)) == sorted([*recent, old], key=repr)


def test_trend_windows_see_each_minute_for_an_hour(clicks):
    rows = clicks(("2018-06-29T10:00:10", "a", 1, 5), ("2018-06-29T10:00:40", "a", 1, 5))
    seen = tuples(ads.ad_trend_windows(rows))
    assert len(seen) == 60
    assert (seen[0][0], seen[-1][0]) == ("201806291001", "201806291100")
    assert {row[1:] for row in seen} == {("20180629", "10", "00", 5, 2)}
