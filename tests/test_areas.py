from __future__ import annotations

from frame_rows import tuples
from pyspark.sql import functions as F

from visitlens import schemas
from visitlens.operators import areas
from visitlens.plans.area_sql import area_top3_by_sql
from visitlens.sources.dimensions import CITIES, area_level, city_dimension


def test_click_actions(actions):
    rows = actions(
        [
            {"click_product_id": 5, "city_id": 2},
            {"click_product_id": -1},
            {"click_product_id": None},
            {"click_product_id": 6, "date": "2018-07-01"},
        ]
    )
    assert tuples(areas.area_click_actions(rows, "2018-06-25", "2018-06-30")) == [(2, 5)]


def test_counts_with_and_without_pre_counting(spark):
    clicks = spark.createDataFrame(
        [(1, 7), (2, 7), (2, 7), (3, 7), (99, 7)], "city_id bigint, click_product_id bigint"
    )
    cities = city_dimension(spark)
    direct = areas.area_product_click_count(areas.area_product_basic(clicks, cities))
    counted = areas.area_product_basic(areas.city_product_clicks(clicks), cities)
    expected = [("华东", 7, 3, "1:上海,2:南京"), ("华南", 7, 1, "3:广州")]
    columns = ["area", "product_id", "click_count", "city_infos"]
    assert tuples(direct, *columns) == expected
    assert tuples(areas.area_product_click_count(counted), *columns) == expected


def test_product_status(spark):
    counts = spark.createDataFrame(
        [("华北", i, i, "0:北京") for i in range(4)],
        "area string, product_id bigint, click_count bigint, city_infos string",
    )
    products = spark.createDataFrame(
        [(0, "a", '{"product_status": 0}'), (1, "b", '{"product_status": 1}'), (2, "c", "{}")],
        schemas.PRODUCT_INFO,
    )
    got = areas.area_product_info(counts, products)
    assert tuples(got, "product_id", "product_status") == [
        (0, "Self"),
        (1, "Third Party"),
        (2, "Third Party"),
    ]


def test_ties_share_a_rank(spark):
    info = spark.createDataFrame(
        [("华北", i, n, "x", "p", "Self") for i, n in enumerate([9, 7, 7, 5, 5])],
        "area string, product_id bigint, click_count bigint, city_infos string,"
        " product_name string, product_status string",
    )
    assert tuples(areas.area_top3_products(info), "product_id", "area_level") == [
        (0, "A Level"),
        (1, "A Level"),
        (2, "A Level"),
    ]


def test_levels(spark):
    rows = city_dimension(spark).select("area", area_level(F.col("area")).alias("level"))
    assert dict(tuples(rows)) == {
        "华北": "A Level",
        "华东": "A Level",
        "华南": "B Level",
        "华中": "B Level",
        "西南": "C Level",
        "西北": "C Level",
        "东北": "D Level",
    }
    assert len(CITIES) == 10


def test_sql_form_agrees(spark):
    clicks = spark.createDataFrame(
        [(c, p) for c in range(10) for p in range(9) for _ in range((c * p) % 5)],
        "city_id bigint, click_product_id bigint",
    )
    products = spark.createDataFrame(
        [(p, f"p{p}", f'{{"product_status": {p % 2}}}') for p in range(8)],
        schemas.PRODUCT_INFO,
    )
    basic = areas.area_product_basic(clicks, city_dimension(spark))
    native = areas.area_top3_products(
        areas.area_product_info(areas.area_product_click_count(basic), products)
    )
    by_sql = area_top3_by_sql(spark, basic, products)
    assert by_sql.columns == native.columns
    assert tuples(by_sql) == tuples(native)


def test_sql_ranking_leaves_the_session_views_alone(spark):
    from visitlens.sources.tables import read_products

    shop = spark.createDataFrame(
        [(i, f"p{i}", "{}") for i in range(9)],
        "product_id bigint, product_name string, extend_info string",
    )
    shop.createOrReplaceTempView("product_info")
    clicked = spark.createDataFrame(
        [("x", 1, "c", 1)], "area string, city_id bigint, city_name string, product_id bigint"
    )
    assert area_top3_by_sql(spark, clicked, shop.where("product_id < 5")).count() == 1
    assert read_products(spark).count() == 9
    spark.catalog.dropTempView("product_info")
