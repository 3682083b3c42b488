"""The fixed city dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens import schemas

# City id, city name, area.
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Level of each area; areas not listed are "D Level".
AREA_LEVELS = {
    "A Level": ["华北", "华东"],
    "B Level": ["华南", "华中"],
    "C Level": ["西南", "西北"],
}
OTHER_LEVEL = "D Level"


def city_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, schemas.CITY)


def area_level(area: Column) -> Column:
    level = F.lit(OTHER_LEVEL)
    for name, areas in AREA_LEVELS.items():
        level = F.when(area.isin(areas), name).otherwise(level)
    return level
