"""Session tables: aggregate, filter, bucket shares and raw detail.

A session may hold a very large part of all actions. Times, counts, filter
flags and sets combine before the shuffle, so the task that builds a session's
row gets a row from each task before it, not each action.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.predicates import all_of, any_of, between, equal_to, one_of
from visitlens.functions.text import non_empty
from visitlens.functions.times import parse_time, seconds_between
from visitlens.operators.joins import rows_with_key
from visitlens.params import TaskParams

# Name, lowest and highest visit length in whole seconds.
VISIT_LENGTHS = [
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
]

# Name, lowest and highest step count.
STEP_LENGTHS = [
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
]

_USER_COLUMNS = ["user_id", "age", "professional", "city", "sex"]


def _step_columns() -> list[Column]:
    category = F.col("click_category_id")
    word = F.col("search_keyword")
    return [
        F.col("session_id"),
        F.when(F.col("user_id") != -1, F.col("user_id")).alias("user_id"),
        parse_time(F.col("action_time")).alias("ts"),
        F.when(non_empty(word), word).alias("word"),
        F.when(category != -1, category).alias("category"),
    ]


def _times() -> list[Column]:
    return [
        F.min("user_id").alias("user_id"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _with_lengths(grouped: DataFrame, *more: str) -> DataFrame:
    return grouped.select(
        "session_id",
        "user_id",
        "start_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("visit_length"),
        "step_length",
        *more,
    )


def with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join: sessions of unknown users are left out."""
    return sessions.join(users.select(*_USER_COLUMNS), "user_id").select(
        *sessions.columns, *_USER_COLUMNS[1:]
    )


def session_facts(
    actions: DataFrame, words: Iterable[str] = (), categories: Iterable[int] = ()
) -> DataFrame:
    """One fixed-size row per session.

    ``has_word`` / ``has_category`` tell whether the session searched one of
    ``words`` / clicked one of ``categories`` and are present when asked for.
    """
    flags = {}
    if words := list(words):
        flags["has_word"] = F.bool_or(F.col("word").isin(words))
    if categories := list(categories):
        flags["has_category"] = F.bool_or(F.col("category").isin(categories))
    grouped = (
        actions.select(*_step_columns())
        .groupBy("session_id")
        .agg(
            *_times(),
            *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
        )
    )
    return _with_lengths(grouped, *flags)


def _items(actions: DataFrame) -> DataFrame:
    """One row for each word and category that an action names.

    They come as rows of their own, so a session has as many distinct ones as words
    plus categories, not words times categories.
    """
    word, category = F.col("word"), F.col("category")

    def item(kind: str, w: Column, c: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), w.alias("word"), c.alias("category"))

    named = F.array(
        item("word", word, F.lit(None).cast("bigint")),
        item("category", F.lit(None).cast("string"), category),
    )
    told = F.filter(named, lambda i: i["word"].isNotNull() | i["category"].isNotNull())
    steps = actions.select(*_step_columns()).where(word.isNotNull() | category.isNotNull())
    return steps.select("session_id", F.explode(told).alias("item")).select("session_id", "item.*")


def _lists() -> list[Column]:
    return [
        F.array_sort(F.collect_set("word")).alias("search_keywords"),
        F.array_sort(F.collect_set("category")).alias("click_category_ids"),
    ]


def session_terms(actions: DataFrame) -> DataFrame:
    """Sorted distinct search words and clicked categories of each session."""
    return actions.select(*_step_columns()).groupBy("session_id").agg(*_lists())


def session_terms_long(actions: DataFrame) -> DataFrame:
    """The same as one row for each (session, word) and (session, category), for
    sessions whose lists don't fit a row."""
    value = F.coalesce("word", F.col("category").cast("string"))
    return _items(actions).select("session_id", "kind", value.alias("value")).distinct()


def session_aggregate(actions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per session of a known user: who, when, how long, what.

    One aggregation and one shuffle: the sets are built before it, so what travels is
    a row per session and task with the distinct entries seen there.
    """
    grouped = actions.select(*_step_columns()).groupBy("session_id").agg(*_times(), *_lists())
    return with_user(
        _with_lengths(grouped, "search_keywords", "click_category_ids"), users
    )


def user_sessions(actions: DataFrame, users: DataFrame) -> DataFrame:
    """:func:`session_aggregate` without the lists: all that counting needs."""
    return with_user(session_facts(actions), users)


def _user_predicates(params: TaskParams) -> list[Column | None]:
    return [
        between(F.col("age"), params.start_age, params.end_age),
        one_of(F.col("professional"), params.professionals),
        one_of(F.col("city"), params.cities),
        equal_to(F.col("sex"), params.sex),
    ]


def session_filter(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of :func:`session_aggregate` that meet every given parameter."""
    return sessions.where(
        all_of(
            *_user_predicates(params),
            any_of(F.col("search_keywords"), params.keywords),
            any_of(F.col("click_category_ids"), params.category_ids),
        )
    )


def matching_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Aggregate and filter in one step, without building the lists.

    Same sessions as ``session_filter(session_aggregate(...))``: list
    membership becomes a flag that combines before the shuffle, and the user
    predicates reach the scan of the user table.
    """
    facts = session_facts(actions, params.keywords, params.category_ids)
    return flagged_sessions(with_user(facts, users), params)


def flagged_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """The matching ones among sessions that carry the flags for ``params``."""
    flags = [
        F.col("has_word") if params.keywords else None,
        F.col("has_category") if params.category_ids else None,
    ]
    return sessions.where(all_of(*flags, *_user_predicates(params))).drop(
        "has_word", "has_category"
    )


def filtered_session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Raw actions of the given sessions."""
    return rows_with_key(actions, sessions, "session_id")


def _bucket_counts() -> dict[str, str]:
    """SQL that counts the sessions of each bucket, by bucket."""
    counts = {}
    for column, buckets in (("visit_length", VISIT_LENGTHS), ("step_length", STEP_LENGTHS)):
        for name, low, high in buckets:
            inside = f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"
            counts[name] = f"count_if({inside})"
    return counts


def session_bucket_ratios(sessions: DataFrame) -> DataFrame:
    """Session count and the share of each visit-length and step bucket.

    Shares are rounded half up; without any session they are NULL.
    """
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[
            F.expr(f"round(try_divide({count}, count(1)), 2)").alias(f"{name}_ratio")
            for name, count in _bucket_counts().items()
        ],
    )


def observed_sessions(sessions: DataFrame) -> tuple[DataFrame, Observation]:
    """The sessions with their bucket counts taken along by whatever pass reads them next.

    Read them in the last stage of a write: there Spark counts each task's success once,
    whatever was tried again or lost.
    """
    observation = Observation()
    counts = [F.expr(count).alias(name) for name, count in _bucket_counts().items()]
    total = F.count(F.lit(1)).alias("session_count")
    return sessions.observe(observation, total, *counts), observation


def observed_bucket_ratios(spark: SparkSession, observation: Observation) -> DataFrame:
    """:func:`session_bucket_ratios` from counts that a pass has taken along."""
    counts = observation.get
    total = F.lit(counts["session_count"]).cast("long")
    return spark.range(1).select(
        total.alias("session_count"),
        *[
            F.round(F.try_divide(F.lit(counts[name]).cast("long"), total), 2).alias(f"{name}_ratio")
            for name in _bucket_counts()
        ],
    )
