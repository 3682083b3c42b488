"""Shop tables derived from the generic test tables (events, customer, part).

Every derivation is a row-wise projection, so it adds no shuffle and column
pruning reaches the files. Ad lines also come as files that arrive one after
another, for streams of many batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
    " props STRING"
)
_CUSTOMER = (
    "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
)
_PART = (
    "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE"
)


def _read(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def _events(spark: SparkSession, folder: str, start: str | None, end: str | None) -> DataFrame:
    events = _read(spark, folder, "events", _EVENTS)
    return _typed_events(events, start, end)


def _typed_events(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None and end is not None:
        # On the stored column, so that it is pushed to the Parquet scan.
        events = events.where(
            (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
            & (F.col("ts") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
        )
    return events.selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "user_id",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    )


def visit_actions(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """``user_visit_action`` plus ``event_id``, which orders equal times."""
    return _events(spark, folder, start, end).selectExpr(
        "CAST(CAST(ts AS DATE) AS STRING) AS date",
        "user_id",
        "concat_ws('_', user_id, CAST(ts AS DATE)) AS session_id",
        "k % 10 AS page_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k % 20 ELSE -1L END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN k ELSE -1L END AS click_product_id",
        "CASE WHEN event_type = 'signup' THEN concat_ws(',', k % 20, (k + 7) % 20) END"
        " AS order_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS order_product_ids",
        "CASE WHEN event_type = 'purchase' THEN concat_ws(',', k % 20, (k + 3) % 20) END"
        " AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_product_ids",
        "user_id % 10 AS city_id",
        "event_id",
    )


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer", _CUSTOMER).selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(10 + c_custkey % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "concat('city', c_nationkey) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def product_info(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "part", _PART).selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', p_size % 2, '}') AS extend_info""",
    )


def _lines_of(events: DataFrame) -> DataFrame:
    return _typed_events(events, None, None).where("event_type = 'click'").selectExpr(
        "concat_ws(' ', unix_millis(ts), user_id % 10, user_id % 10, user_id, k % 20) AS value"
    )


def ad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ad-click lines as text, column ``value``."""
    return _lines_of(_read(spark, folder, "events", _EVENTS))


DAY_MILLIS = 86_400_000


def ad_line_arrivals(
    spark: SparkSession, folder: str, parts: int, late_users: int = 0, late_days: int = 0
) -> DataFrame:
    """Ad lines, column ``value``, with the part 0 to ``parts`` - 1 of the time they arrive in.

    Lines arrive at the time of their click, but those of every ``late_users``-th user
    (by id; 0 for none) come ``late_days`` later.
    """
    delay = f"IF(user_id % {late_users} = 0, {late_days * DAY_MILLIS}, 0)" if late_users else "0"
    lines = _typed_events(_read(spark, folder, "events", _EVENTS), None, None)
    lines = lines.where("event_type = 'click'").selectExpr(
        "concat_ws(' ', unix_millis(ts), user_id % 10, user_id % 10, user_id, k % 20) AS value",
        f"unix_millis(ts) + {delay} AS arrival",
    )
    first, last = lines.agg(F.min("arrival"), F.max("arrival")).first()
    if first is None:
        return lines.select("value", F.lit(0).cast("long").alias("part"))
    return lines.selectExpr("value", f"(arrival - {first}L) * {parts} div {last - first + 1}L AS part")


def write_ad_line_parts(lines: DataFrame, target: str, parts: range, files: int) -> None:
    """Append the lines of each part to a folder, part after part, as ``files`` files each.

    A stream that takes ``files`` files at a time then has one batch a part, in order.
    A part should hold at least ``files`` lines.
    """
    for part in parts:
        mine = lines.where(F.col("part") == part).select("value")
        mine.repartition(files).write.mode("append").text(target)
