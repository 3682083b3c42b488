"""The three batch jobs. Each returns result tables by name.

Nothing passes through the driver: results stay DataFrames, to be written by
``visitlens.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import time_text
from visitlens.operators import areas, categories, funnel, sampling, sessions
from visitlens.params import TaskParams
from visitlens.session import materialize
from visitlens.sinks.tables import with_task_id
from visitlens.sources.dimensions import city_dimension
from visitlens.sources.tables import in_date_range


def session_aggr_stat(ratios: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(ratios, task_id)


def session_random_extract(sample: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(
        sample.select(
            F.col("session_id").alias("sessionid"),
            time_text(F.col("start_time")).alias("startTime"),
            F.array_join("search_keywords", ",").alias("searchKeywords"),
            F.array_join(F.col("click_category_ids").cast("array<string>"), ",").alias(
                "clickCategoryIds"
            ),
        ),
        task_id,
    )


def top10_category(top: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(
        top.select(
            F.col("category_id").alias("categoryid"),
            F.col("click_count").alias("clickCount"),
            F.col("order_count").alias("orderCount"),
            F.col("pay_count").alias("payCount"),
        ),
        task_id,
    )


def top10_session(top: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(
        top.select(
            F.col("category_id").alias("categoryid"),
            F.col("session_id").alias("sessionid"),
            F.col("click_count").alias("clickCount"),
        ),
        task_id,
    )


def page_split_convert_rate(conversion: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(conversion.select(F.col("rate_str").alias("rateStr")), task_id)


def area_top3_product(top: DataFrame, task_id: str) -> DataFrame:
    return with_task_id(
        top.select(
            "area",
            F.col("area_level").alias("areaLevel"),
            F.col("product_id").alias("productid"),
            F.col("city_infos").alias("cityInfos"),
            F.col("click_count").alias("clickCount"),
            F.col("product_name").alias("productName"),
            F.col("product_status").alias("productStatus"),
        ),
        task_id,
    )


def run_session_job(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: str,
    sample_size: int = 100,
    seed: int = 0,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """The four session analyses.

    The actions are read for the sessions, for the category counts and for the
    words of the sampled sessions. Everything else works on the tables
    written in between, which survive lost executors; the bucket counts come
    along with the pass that writes the matching sessions.
    """
    actions = in_date_range(actions, params.start_date, params.end_date)
    facts = sessions.session_facts(actions, params.keywords, params.category_ids)
    everyone = materialize(sessions.with_user(facts, users), "sessions", folder)
    observed, counted = sessions.observed_sessions(sessions.flagged_sessions(everyone, params))
    matching = materialize(observed, "matching", folder)
    counts = materialize(
        categories.counts_of_sessions(categories.session_category_counts(actions), matching),
        "session-categories",
        folder,
    )
    top = categories.top_categories(counts)
    sample = materialize(
        sampling.session_stratified_sample(everyone, sample_size, seed), "sample", folder
    )
    return {
        "session_aggr_stat": session_aggr_stat(
            sessions.observed_bucket_ratios(actions.sparkSession, counted), task_id
        ),
        "session_random_extract": session_random_extract(
            sampling.sample_with_terms(sample, actions), task_id
        ),
        "top10_category": top10_category(top, task_id),
        "top10_session": top10_session(
            categories.top_sessions_per_category(counts, top), task_id
        ),
    }


def run_page_job(
    actions: DataFrame,
    params: TaskParams,
    task_id: str,
    tie_break: tuple[str, ...] = ("page_id",),
) -> dict[str, DataFrame]:
    steps = funnel.page_flow_steps(
        actions, params.start_date, params.end_date, params.page_flow, tie_break
    )
    return {
        "page_split_convert_rate": page_split_convert_rate(
            funnel.page_flow_conversion(steps), task_id
        )
    }


def run_area_job(
    spark: SparkSession,
    actions: DataFrame,
    products: DataFrame,
    params: TaskParams,
    task_id: str,
) -> dict[str, DataFrame]:
    clicks = areas.area_click_actions(actions, params.start_date, params.end_date)
    counted = areas.city_product_clicks(clicks)
    basic = areas.area_product_basic(counted, F.broadcast(city_dimension(spark)))
    info = areas.area_product_info(areas.area_product_click_count(basic), products)
    return {"area_top3_product": area_top3_product(areas.area_top3_products(info), task_id)}
