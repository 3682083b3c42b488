"""The area ranking in SQL text, over DataFrames passed by name.

The statement reads its inputs as ``{name}`` parameters, so nothing is
registered in the session but the scalar functions, and calls with other inputs
don't meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlens.functions.text import register_sql_functions
from visitlens.sources.dimensions import AREA_LEVELS, OTHER_LEVEL

RANKED = """
WITH hits AS (
    SELECT area, product_id, concat_long_string(city_id, city_name, ':') AS city, count(1) AS n
    FROM {clicked} GROUP BY ALL
),
popular AS (
    SELECT area, product_id, sum(n) AS click_count,
        listagg(DISTINCT city, ',') WITHIN GROUP (ORDER BY city) AS city_infos
    FROM hits GROUP BY ALL
),
placed AS (
    SELECT popular.*, {catalog}.product_name,
        get_json_value({catalog}.extend_info, 'product_status') <=> '0' AS own,
        rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS place
    FROM popular JOIN {catalog} USING (product_id)
)
SELECT area, ifnull(level_name, {other}) AS area_level, product_id, city_infos, click_count,
    product_name, if(own, 'Self', 'Third Party') AS product_status
FROM placed LEFT JOIN {levels} USING (area)
WHERE place <= {k}
"""


def area_top3_by_sql(
    spark: SparkSession, clicked: DataFrame, catalog: DataFrame, k: int = 3
) -> DataFrame:
    """The ``k`` most clicked products of each area, from (area, product, city)
    clicks and the product table."""
    register_sql_functions(spark)
    levels = spark.createDataFrame(
        [(area, name) for name, areas in AREA_LEVELS.items() for area in areas],
        "area string, level_name string",
    )
    return spark.sql(RANKED, clicked=clicked, catalog=catalog, levels=levels,
                     other=OTHER_LEVEL, k=k)
