"""Registered queries and their equivalents in SQL.

``queries()`` maps a name to a function of (spark, folder of test tables);
``oracle_sql()`` gives the same result as SQL on the raw tables.
"""

from __future__ import annotations

import importlib
import importlib.util
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sql_equivalents import SQL_EQUIVALENTS
from visitlens.functions.times import time_text
from visitlens.operators import ads, areas, categories, funnel, lists, sampling, sessions
from visitlens import schemas
from visitlens.params import TaskParams
from visitlens.plans import jobs
from visitlens.plans.area_sql import area_top3_by_sql
from visitlens.session import materialize, shared_dir
from visitlens.sinks import merge, partition_files, tables
from visitlens.sinks.buckets import BucketTable
from visitlens.sources import adlog, derived
from visitlens.streaming import closing, native, pipeline
from visitlens.sources.dimensions import city_dimension
from visitlens.sources.tables import in_date_range, lookup, read_actions, read_users

TASK_ID = "task-1"
SAMPLE_SIZE = 3000
SEED = 7
THRESHOLD = 2  # no user of the test tables clicks one ad 100 times a day
TREND_DAYS = 5
BUCKETS = 8
SOME_USERS = (1, 7, 11)
HALF = "2024-01-16"  # where the merge queries split "current" from "delta"

# The keys of the job parameters.
PARAMS = TaskParams.from_dict(
    {
        "startDate": "2024-01-01",
        "endDate": "2024-12-31",
        "startAge": "20",
        "endAge": "50",
        "professionals": "",
        "cities": "",
        "sex": "male",
        "keywords": "",
        "categoryIds": "",
        "targetPageFlow": "1,2,3,4,5,6,7",
    }
)
SEARCHERS = TaskParams.from_dict(
    {
        "startDate": "2024-01-01",
        "endDate": "2024-12-31",
        "professionals": "BUILDING,MACHINERY,HOUSEHOLD",
        "keywords": "kw1,kw2,kw3,kw4,kw5",
        "categoryIds": "1,2,3,4,5,6,7,8,9",
    }
)
CITY_VISITORS = TaskParams.from_dict(
    {"startDate": "2024-01-01", "endDate": "2024-12-31", "cities": "city1,city3,city7,city12"}
)


# ---- inputs ----------------------------------------------------------------


def _actions(spark: SparkSession, d: str) -> DataFrame:
    return derived.visit_actions(spark, d, PARAMS.start_date, PARAMS.end_date)


def _clicks(spark: SparkSession, d: str) -> DataFrame:
    return adlog.parse_ad_log(derived.ad_lines(spark, d))


def _matching(spark: SparkSession, d: str) -> DataFrame:
    return sessions.matching_sessions(_actions(spark, d), derived.user_info(spark, d), PARAMS)


def _matching_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = categories.session_category_counts(_actions(spark, d))
    return categories.counts_of_sessions(counts, _matching(spark, d))


def _user_sessions(spark: SparkSession, d: str) -> DataFrame:
    return sessions.user_sessions(_actions(spark, d), derived.user_info(spark, d))


def _listed_text(df: DataFrame) -> DataFrame:
    """Lists and times as text, the way the result tables hold them."""
    return df.withColumns(
        {
            "start_time": time_text(F.col("start_time")),
            "search_keywords": F.array_join("search_keywords", ","),
            "click_category_ids": F.array_join(
                F.col("click_category_ids").cast("array<string>"), ","
            ),
        }
    )


# ---- areas -----------------------------------------------------------------


def area_click_actions(spark, d):
    return areas.area_click_actions(_actions(spark, d), PARAMS.start_date, PARAMS.end_date)


def area_product_basic(spark, d):
    return areas.area_product_basic(
        area_click_actions(spark, d), F.broadcast(city_dimension(spark))
    )


def area_product_click_count(spark, d):
    return areas.area_product_click_count(area_product_basic(spark, d))


def area_product_info(spark, d):
    counted = areas.city_product_clicks(area_click_actions(spark, d))
    basic = areas.area_product_basic(counted, F.broadcast(city_dimension(spark)))
    return areas.area_product_info(
        areas.area_product_click_count(basic), derived.product_info(spark, d)
    )


def area_top3_products(spark, d):
    return areas.area_top3_products(area_product_info(spark, d))


def area_top3_sql(spark, d):
    return area_top3_by_sql(spark, area_product_basic(spark, d), derived.product_info(spark, d))


def area_top3_product_result(spark, d):
    return jobs.area_top3_product(area_top3_products(spark, d), TASK_ID)


# ---- page flow -------------------------------------------------------------


def page_flow_steps(spark, d):
    return funnel.page_flow_steps(
        _actions(spark, d), PARAMS.start_date, PARAMS.end_date, PARAMS.page_flow, ("event_id",)
    )


def page_flow_conversion(spark, d):
    return jobs.page_split_convert_rate(
        funnel.page_flow_conversion(page_flow_steps(spark, d)), TASK_ID
    )


# ---- sessions --------------------------------------------------------------


def _aggregate(spark, d):
    return sessions.session_aggregate(_actions(spark, d), derived.user_info(spark, d))


def session_aggregate(spark, d):
    return _listed_text(_aggregate(spark, d))


def session_terms_long(spark, d):
    return sessions.session_terms_long(_actions(spark, d))


def session_filter(spark, d):
    return _listed_text(sessions.session_filter(_aggregate(spark, d), SEARCHERS))


def matching_sessions(spark, d):
    found = sessions.matching_sessions(
        _actions(spark, d), derived.user_info(spark, d), SEARCHERS
    )
    return found.withColumn("start_time", time_text(F.col("start_time")))


def sessions_of_cities(spark, d):
    found = sessions.matching_sessions(
        _actions(spark, d), derived.user_info(spark, d), CITY_VISITORS
    )
    return found.withColumn("start_time", time_text(F.col("start_time")))


def session_bucket_ratios(spark, d):
    return jobs.session_aggr_stat(
        sessions.session_bucket_ratios(_matching(spark, d)), TASK_ID
    )


def filtered_session_detail(spark, d):
    return sessions.filtered_session_detail(_actions(spark, d), _matching(spark, d))


def session_sample_quota(spark, d):
    return sampling.session_sample_quota(_user_sessions(spark, d), SAMPLE_SIZE)


def session_stratified_sample(spark, d):
    sample = sampling.session_stratified_sample(_user_sessions(spark, d), SAMPLE_SIZE, SEED)
    return jobs.session_random_extract(
        sampling.sample_with_terms(sample, _actions(spark, d)), TASK_ID
    )


# ---- categories ------------------------------------------------------------


def category_click_count(spark, d):
    return categories.category_click_count(filtered_session_detail(spark, d))


def category_order_count(spark, d):
    return categories.category_order_count(filtered_session_detail(spark, d))


def category_pay_count(spark, d):
    return categories.category_pay_count(filtered_session_detail(spark, d))


def session_category_counts(spark, d):
    return _matching_counts(spark, d)


def category_full_counts(spark, d):
    return categories.category_full_counts(_matching_counts(spark, d))


def top_categories(spark, d):
    return jobs.top10_category(categories.top_categories(_matching_counts(spark, d)), TASK_ID)


def top_sessions_per_category(spark, d):
    counts = _matching_counts(spark, d)
    return jobs.top10_session(
        categories.top_sessions_per_category(counts, categories.top_categories(counts)), TASK_ID
    )


# ---- ads -------------------------------------------------------------------


def parse_ad_log(spark, d):
    clicks = _clicks(spark, d)
    return clicks.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_millis")


def ad_user_daily_clicks(spark, d):
    return ads.ad_user_daily_clicks(_clicks(spark, d))


def ad_blacklist_update(spark, d):
    return ads.ad_blacklist_update(ad_user_daily_clicks(spark, d), threshold=THRESHOLD)


def ad_blacklist_filter(spark, d):
    kept = ads.ad_blacklist_filter(_clicks(spark, d), ad_blacklist_update(spark, d))
    return kept.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_millis")


def ad_realtime_stat(spark, d):
    return ads.ad_realtime_stat(_clicks(spark, d))


def ad_province_top3(spark, d):
    return ads.ad_province_top3(ad_realtime_stat(spark, d))


def ad_province_top3_overall(spark, d):
    return ads.ad_province_top3(ad_realtime_stat(spark, d), partition_by=("province",))


def ad_minute_counts(spark, d):
    return ads.ad_minute_counts(_clicks(spark, d))


def ad_click_trend(spark, d):
    return ads.ad_click_trend(_clicks(spark, d))


def ad_click_trend_days(spark, d):
    """The trend of the last days instead of the last hour."""
    return ads.ad_click_trend(_clicks(spark, d), minutes=TREND_DAYS * 24 * 60)


def ad_trend_windows(spark, d):
    return ads.ad_trend_windows(_clicks(spark, d))


# ---- ads as streams: the given events through a file source ----------------


PARTS = 6  # batches of the streams below, by time of arrival
FILES = 2  # files of a batch
LATE_USERS, LATE_DAYS = 9, 8  # clicks of every ninth user arrive eight days later
DELAY = "2 days"


class _Arrivals:
    """Ad lines as files that arrive part by part, and the stream over them."""

    def __init__(self, spark: SparkSession, d: str, late: bool = False):
        self.spark, self.folder = spark, f"{_new_folder(spark)}"
        self.lines = derived.ad_line_arrivals(spark, d, PARTS, LATE_USERS if late else 0, LATE_DAYS)

    def arrive(self, *parts: int) -> DataFrame:
        files = f"{self.folder}/lines"
        derived.write_ad_line_parts(self.lines, files, range(*parts), FILES)
        return adlog.text_ad_lines(self.spark, files, files_per_batch=FILES)


def _click_lines(spark: SparkSession, d: str) -> DataFrame:
    """All ad lines as a stream of several batches."""
    return _Arrivals(spark, d).arrive(PARTS)


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _upserted(spark, updates, schema, keys, bucket_by):
    folder = _new_folder(spark)
    table = BucketTable(spark, f"{folder}/table", schema, [bucket_by], day="date")
    native.start_upserts(
        updates, table, keys, f"{folder}/checkpoint", every=None
    ).awaitTermination()
    return table.rows()


def stream_realtime_stat(spark, d):
    clicks = adlog.parse_ad_log(_click_lines(spark, d))
    updates = native.realtime_stat_stream(clicks)
    return _upserted(spark, updates, schemas.AD_STAT, pipeline.STAT_KEYS, "province")


def stream_user_daily_clicks(spark, d):
    clicks = adlog.parse_ad_log(_click_lines(spark, d))
    updates = native.user_daily_clicks_stream(clicks)
    return _upserted(
        spark, updates, schemas.AD_USER_CLICK_COUNT, pipeline.USER_KEYS, "userid"
    )


def stream_blacklist_update(spark, d):
    tables = pipeline.AdTables.under(spark, _new_folder(spark))
    pipeline.start_blacklist_query(
        _click_lines(spark, d), tables, THRESHOLD, every=None
    ).awaitTermination()
    return tables.blacklist()


def _after_pipeline(spark, d):
    tables = pipeline.AdTables.under(spark, _new_folder(spark))
    pipeline.start_ad_pipeline(_click_lines(spark, d), tables, every=None).awaitTermination()
    return tables


def stream_click_trend(spark, d):
    return _after_pipeline(spark, d).click_trend()


def stream_province_top3(spark, d):
    return _after_pipeline(spark, d).province_top3()


# ---- streams of many batches whose list filters --------------------------------


def _after_feedback(spark, d):
    """The pipeline over six batches: users listed in one are filtered from the next on."""
    arrivals = _Arrivals(spark, d)
    tables = pipeline.AdTables.under(spark, f"{arrivals.folder}/ads")
    lines = arrivals.arrive(PARTS)
    pipeline.start_ad_pipeline(lines, tables, THRESHOLD, every=None).awaitTermination()
    return tables


def stream_feedback_blacklist(spark, d):
    return _after_feedback(spark, d).blacklist()


def stream_feedback_stat(spark, d):
    return _after_feedback(spark, d).stat()


def stream_feedback_top3(spark, d):
    return _after_feedback(spark, d).province_top3()


def stream_feedback_trend(spark, d):
    return _after_feedback(spark, d).click_trend()


class _CutOff(Exception):
    pass


def _after_restarts(spark, d):
    """The same, cut off and started again: two batches; a third whose tables are in place
    but which the checkpoint doesn't know of, so that it comes again; a fourth that is
    noted but not put in place; then the rest from the checkpoint."""
    arrivals = _Arrivals(spark, d)
    tables = pipeline.AdTables.under(spark, f"{arrivals.folder}/ads")

    def run(lines, cut=None, before_publishing=False):
        def write(batch, batch_id):
            if batch_id == cut and before_publishing:
                pipeline.stage_batch(batch, batch_id, tables, THRESHOLD)
                raise _CutOff
            pipeline.process_batch(batch, batch_id, tables, THRESHOLD)
            if batch_id == cut:
                raise _CutOff

        query = (
            lines.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{tables.folder}/checkpoint")
            .trigger(availableNow=True).start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if cut is None:
                raise

    run(arrivals.arrive(2))
    lines = arrivals.arrive(2, 4)
    run(lines, cut=2)
    run(lines, cut=3, before_publishing=True)
    run(arrivals.arrive(4, PARTS))
    return tables


def stream_restart_stat(spark, d):
    return _after_restarts(spark, d).stat()


def stream_restart_blacklist(spark, d):
    return _after_restarts(spark, d).blacklist()


# ---- streams whose units close behind a watermark -------------------------------


def _closed(spark, d, counts, unit) -> closing.ClosedTable:
    """Closed counts over six batches, three of them after a restart; some clicks come late."""
    arrivals = _Arrivals(spark, d, late=True)
    for parts in ((0, PARTS // 2), (PARTS // 2, PARTS)):
        clicks = adlog.parse_ad_log(arrivals.arrive(*parts))
        closed = counts(clicks, DELAY)
        table = closing.ClosedTable(spark, f"{arrivals.folder}/closed", closed.schema)
        closing.start_closing(clicks, closed, table, unit, DELAY, every=None).awaitTermination()
    return table


def stream_closed_windows(spark, d):
    return _closed(spark, d, closing.closed_trend_windows, closing.MINUTE).closed()


def stream_late_clicks(spark, d):
    late = _closed(spark, d, closing.closed_minutes, closing.MINUTE).late()
    return late.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_millis")


def stream_closed_days(spark, d):
    return _closed(spark, d, closing.closed_days, closing.DAY).closed()


# ---- table merges ----------------------------------------------------------


def _halves(clicks: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = F.col("ts") < F.lit(HALF).cast("timestamp")
    return clicks.where(early), clicks.where(~early)


def upsert_add(spark, d):
    """Running clicks per (user, ad): the late half is added to the early one."""

    def per_user(clicks):
        return clicks.groupBy(
            F.col("user_id").alias("userid"), F.col("ad_id").alias("adid")
        ).agg(F.count(F.lit(1)).alias("clickCount"))

    early, late = _halves(_clicks(spark, d))
    return merge.upsert_add(per_user(early), per_user(late), ["userid", "adid"], "clickCount")


def upsert_replace(spark, d):
    """Clicks of (hour of day, ad): keys of the late half replace early ones."""

    def per_hour(clicks):
        return clicks.groupBy(
            F.date_format("ts", "HH").alias("hour"), F.col("ad_id").alias("adid")
        ).agg(F.count(F.lit(1)).alias("clickCount"))

    early, late = _halves(_clicks(spark, d))
    return merge.upsert_replace(per_hour(early), per_hour(late), ["hour", "adid"])


def replace_group(spark, d):
    """Ads of (hour of day, user): the late half replaces whole groups."""

    def per_user_hour(clicks):
        return clicks.groupBy(
            F.date_format("ts", "HH").alias("hour"),
            F.col("user_id").alias("userid"),
            F.col("ad_id").alias("adid"),
        ).agg(F.count(F.lit(1)).alias("clickCount"))

    early, late = _halves(_clicks(spark, d))
    return merge.replace_group(per_user_hour(early), per_user_hour(late), ["hour", "userid"])


def insert_new(spark, d):
    """Users of the late half join those of the early half, each once."""

    def first_day(clicks):
        return clicks.groupBy(F.col("user_id").alias("userid")).agg(
            F.min(F.col("ts").cast("date").cast("string")).alias("date")
        )

    early, late = _halves(_clicks(spark, d))
    return merge.insert_new(first_day(early), first_day(late), ["userid"])


# ---- tables of the catalog, by partition, bucket and task ------------------------


def _stored(spark: SparkSession, kind: str) -> tuple[str, str]:
    """A new table's name and folder."""
    name = f"visitlens_{kind}_{uuid.uuid4().hex}"
    return name, f"{shared_dir(spark)}/{name}"


def catalog_actions(spark, d):
    """Three days of a table by date, which replaced one of half its days."""
    name, path = _stored(spark, "actions")
    actions = _actions(spark, d)
    for rows in (actions.where(F.col("date") < HALF), actions):
        tables.overwrite_table(rows, name, ["date"], path)
    stored = in_date_range(read_actions(spark, name), "2024-01-15", "2024-01-17")
    return stored.select("event_id", "date", "user_id", "session_id", "page_id", "action_time")


def _bucketed_sessions(spark, d):
    name, path = _stored(spark, "sessions")
    facts = sessions.session_facts(_actions(spark, d))
    tables.overwrite_bucketed(facts, name, "user_id", BUCKETS, path)
    return spark.table(name)


def bucketed_sessions_of_users(spark, d):
    """Sessions and users stored by the same buckets: the join needs no shuffle."""
    name, path = _stored(spark, "users")
    tables.overwrite_bucketed(derived.user_info(spark, d), name, "user_id", BUCKETS, path)
    found = sessions.with_user(_bucketed_sessions(spark, d), spark.table(name))
    return found.withColumn("start_time", time_text(F.col("start_time")))


def bucketed_user_lookup(spark, d):
    """Sessions of three users, from their buckets."""
    found = lookup(_bucketed_sessions(spark, d), "user_id", SOME_USERS)
    return found.withColumn("start_time", time_text(F.col("start_time")))


def session_bucket_ratios_observed(spark, d):
    """The shares from counts that came along while the sessions were written."""
    observed, counts = sessions.observed_sessions(_matching(spark, d))
    materialize(observed, "matching")
    return jobs.session_aggr_stat(sessions.observed_bucket_ratios(spark, counts), TASK_ID)


def category_users(spark, d):
    """The users who clicked each category, as texts of at most 25 ids."""
    clicks = _actions(spark, d).where("click_category_id <> -1")
    users = clicks.select(F.col("click_category_id").alias("category_id"), "user_id")
    return lists.concat_distinct_chunks(users, ["category_id"], "user_id", 25)


def partition_writes(spark, d):
    """Clicks written and committed by partition."""
    clicks, folder = ad_user_daily_clicks(spark, d), _new_folder(spark)
    partition_files.append_partitions(clicks, folder)
    return partition_files.read_partitions(spark, folder, clicks.schema)


def stream_partition_writes(spark, d):
    """A stream of clicks whose batches are written and committed by partition."""
    arrivals = _Arrivals(spark, d)
    for parts in ((0, 2), (2, PARTS)):
        clicks = adlog.parse_ad_log(arrivals.arrive(*parts))
        clicks = clicks.select(F.unix_millis("ts").alias("ts_millis"), *clicks.columns[1:])
        table = f"{arrivals.folder}/clicks"
        partition_files.start_appending(
            clicks, table, f"{arrivals.folder}/checkpoint", every=None
        ).awaitTermination()
    return partition_files.read_partitions(spark, table, clicks.schema)


# ---- whole jobs, over tables of the catalog -------------------------------------


def _shop(spark, d):
    """Actions by date and users, as tables that the jobs read by name."""
    actions, actions_path = _stored(spark, "actions")
    users, users_path = _stored(spark, "users")
    tables.overwrite_table(_actions(spark, d), actions, ["date"], actions_path)
    tables.overwrite_table(derived.user_info(spark, d), users, (), users_path)
    return read_actions(spark, actions), read_users(spark, users)


def _session_job(spark, d):
    actions, users = _shop(spark, d)
    return jobs.run_session_job(actions, users, PARAMS, TASK_ID, SAMPLE_SIZE, SEED)


def job_session_aggr_stat(spark, d):
    return _session_job(spark, d)["session_aggr_stat"]


def job_session_random_extract(spark, d):
    return _session_job(spark, d)["session_random_extract"]


def job_top10_session(spark, d):
    return _session_job(spark, d)["top10_session"]


def job_page_split(spark, d):
    actions, _ = _shop(spark, d)
    return jobs.run_page_job(actions, PARAMS, TASK_ID, ("event_id",))["page_split_convert_rate"]


def job_area_top3(spark, d):
    actions, _ = _shop(spark, d)
    products = derived.product_info(spark, d)
    return jobs.run_area_job(spark, actions, products, PARAMS, TASK_ID)["area_top3_product"]


# ---- contract --------------------------------------------------------------

_QUERIES = [
    area_top3_products,
    area_click_actions,
    area_product_basic,
    area_product_click_count,
    area_product_info,
    area_top3_sql,
    area_top3_product_result,
    page_flow_steps,
    page_flow_conversion,
    session_aggregate,
    session_terms_long,
    session_filter,
    matching_sessions,
    sessions_of_cities,
    session_bucket_ratios,
    filtered_session_detail,
    session_sample_quota,
    session_stratified_sample,
    category_click_count,
    category_order_count,
    category_pay_count,
    session_category_counts,
    category_full_counts,
    top_categories,
    top_sessions_per_category,
    parse_ad_log,
    ad_user_daily_clicks,
    ad_blacklist_update,
    ad_blacklist_filter,
    ad_realtime_stat,
    ad_province_top3,
    ad_province_top3_overall,
    ad_minute_counts,
    ad_click_trend,
    ad_click_trend_days,
    ad_trend_windows,
    stream_realtime_stat,
    stream_user_daily_clicks,
    stream_blacklist_update,
    stream_click_trend,
    stream_province_top3,
    stream_feedback_blacklist,
    stream_feedback_stat,
    stream_feedback_top3,
    stream_feedback_trend,
    stream_restart_stat,
    stream_restart_blacklist,
    stream_closed_windows,
    stream_late_clicks,
    stream_closed_days,
    upsert_add,
    upsert_replace,
    replace_group,
    insert_new,
    catalog_actions,
    bucketed_sessions_of_users,
    bucketed_user_lookup,
    session_bucket_ratios_observed,
    category_users,
    partition_writes,
    stream_partition_writes,
    job_session_aggr_stat,
    job_session_random_extract,
    job_top10_session,
    job_page_split,
    job_area_top3,
]


def _in_utc(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the top products of each area."""
    return _in_utc(area_top3_products)(spark, "/root/testdata/sf0.001")


def _corpus_part(name: str):
    """A module of the corpus operations, None where they or a package they need is missing.

    A module of this library that is missing from an installed part is an error.
    """
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        own = (missing.name or "").split(".")[0] == "visitlens" and missing.name != "visitlens.llm"
        if own and importlib.util.find_spec("visitlens.llm"):
            raise
        return None


_CORPUS_QUERIES = _corpus_part("visitlens.llm.queries")
_CORPUS_SQL = _corpus_part("visitlens.llm.sql")
_PIPELINE = _corpus_part("corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if _CORPUS_QUERIES:
        found |= _CORPUS_QUERIES.queries()
    if _PIPELINE:
        found["pipeline"] = _PIPELINE.run
    return {name: _in_utc(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    found = dict(SQL_EQUIVALENTS)
    if _CORPUS_SQL:
        found |= _CORPUS_SQL.SQL
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found
