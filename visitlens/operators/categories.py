"""Category popularity and the most active sessions of each category.

Actions are first counted per (session, category). That count is what the
session filter, the category totals and the per-category session ranking all
work on, so a session or category with a very large part of all actions has
already shrunk to one row per pair before it meets a join or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.joins import rows_with_key

_KINDS = ("click", "order", "pay")
_COUNTS = [f"{kind}_count" for kind in _KINDS]


def _clicked() -> Column:
    return F.when(F.col("click_category_id") != -1, F.col("click_category_id"))


def _listed(actions: DataFrame, ids: str, *keep: str) -> DataFrame:
    """One row per id of a comma list."""
    split = actions.where(F.col(ids).isNotNull()).select(
        *keep, F.explode(F.split(ids, ",")).alias("id")
    )
    return split.where(F.col("id") != "").select(
        *keep, F.col("id").cast("bigint").alias("category_id")
    )


def category_click_count(actions: DataFrame) -> DataFrame:
    return (
        actions.select(_clicked().alias("category_id"))
        .where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def category_order_count(actions: DataFrame) -> DataFrame:
    return (
        _listed(actions, "order_category_ids")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def category_pay_count(actions: DataFrame) -> DataFrame:
    return (
        _listed(actions, "pay_category_ids")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("pay_count"))
    )


def category_events(actions: DataFrame) -> DataFrame:
    """One row per (action, kind, category), from a single scan."""
    stacked = actions.selectExpr(
        "session_id",
        """stack(3,
             'click', nullif(click_category_id, -1), NULL,
             'order', NULL, order_category_ids,
             'pay', NULL, pay_category_ids) AS (kind, clicked, ids)""",
    ).where("clicked IS NOT NULL OR ids IS NOT NULL")
    return (
        stacked.selectExpr("session_id", "kind", "clicked", "explode_outer(split(ids, ',')) AS id")
        .selectExpr(
            "session_id", "kind", "coalesce(clicked, CAST(nullif(id, '') AS BIGINT)) AS category_id"
        )
        .where("category_id IS NOT NULL")
    )


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of each (session, category)."""
    return (
        category_events(actions)
        .groupBy("session_id", "category_id")
        .agg(*[F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in _KINDS])
    )


def counts_of_sessions(counts: DataFrame, sessions: DataFrame) -> DataFrame:
    """The counts that belong to the given sessions."""
    return rows_with_key(counts, sessions, "session_id")


def category_full_counts(counts: DataFrame) -> DataFrame:
    """Every category clicked, ordered or paid with its three totals."""
    return counts.groupBy("category_id").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` categories by clicks, then orders, then payments."""
    return (
        category_full_counts(counts)
        .orderBy(*[F.desc(c) for c in _COUNTS], "category_id")
        .limit(k)
    )


def top_sessions_per_category(
    counts: DataFrame, categories: DataFrame, k: int = 10
) -> DataFrame:
    """For each given category the ``k`` sessions that clicked it most.

    Any number of categories may be given; how they are joined is left to
    Spark's size check.
    """
    wanted = categories.select("category_id")
    # The session decides every tie. The counts after it keep the columns of
    # this branch equal to those behind ``categories``, so that Spark shuffles
    # the actions once and reuses the result.
    most = Window.partitionBy("category_id").orderBy(
        F.desc("click_count"), "session_id", "order_count", "pay_count"
    )
    return (
        counts.where(F.col("click_count") > 0)
        .join(wanted, "category_id", "left_semi")
        .withColumn("position", F.row_number().over(most))
        .where(F.col("position") <= k)
        .select("category_id", "session_id", "click_count")
    )
