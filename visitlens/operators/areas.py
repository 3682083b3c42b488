"""Top products of each area.

Clicks are counted per (city, product) before the joins and the ranking, so
only one row per pair ever meets them, and no task sees more than its share of
a product that draws a large part of all clicks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.text import concat_distinct, json_field, labelled
from visitlens.sources.dimensions import area_level
from visitlens.sources.tables import in_date_range


def area_click_actions(actions: DataFrame, start: str, end: str) -> DataFrame:
    """City and product of each product click in the date range."""
    product = F.col("click_product_id")
    return (
        in_date_range(actions, start, end)
        .where(product.isNotNull() & (product != -1))
        .select("city_id", "click_product_id")
    )


def city_product_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks counted per (city, product), for use in place of the clicks."""
    return clicks.groupBy("city_id", "click_product_id").agg(
        F.count(F.lit(1)).alias("clicks")
    )


def area_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Attach city name and area. ``cities`` is the fixed small dimension; a
    larger one is better passed through Spark's own size check (no hint)."""
    counted = ["clicks"] if "clicks" in clicks.columns else []
    return clicks.join(cities, "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id"), *counted
    )


def area_product_click_count(basic: DataFrame) -> DataFrame:
    """Clicks and the distinct cities of each (area, product)."""
    if "clicks" not in basic.columns:
        basic = basic.groupBy("area", "product_id", "city_id", "city_name").agg(
            F.count(F.lit(1)).alias("clicks")
        )
    return basic.groupBy("area", "product_id").agg(
        F.sum("clicks").alias("click_count"),
        concat_distinct(labelled(F.col("city_id"), F.col("city_name"))).alias("city_infos"),
    )


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Add product name and status; products without a record are left out."""
    status = F.when(json_field(F.col("extend_info"), "product_status") == "0", "Self")
    return counts.join(
        products.select(
            "product_id", "product_name", status.otherwise("Third Party").alias("product_status")
        ),
        "product_id",
    ).select(
        "area", "city_infos", "product_id", "click_count", "product_name", "product_status"
    )


def area_top3_products(info: DataFrame, k: int = 3) -> DataFrame:
    """Products ranked up to ``k`` in their area by clicks, ties kept."""
    by_clicks = Window.partitionBy("area").orderBy(F.desc("click_count"))
    return (
        info.withColumn("rank", F.rank().over(by_clicks))
        .where(F.col("rank") <= k)
        .select(
            "area",
            area_level(F.col("area")).alias("area_level"),
            "product_id",
            "city_infos",
            "click_count",
            "product_name",
            "product_status",
        )
    )
