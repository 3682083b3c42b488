"""Step-by-step conversion along a page flow.

Consecutive page pairs need the time order of each session. To keep a huge
session out of a single task, its actions are ordered in slots of a few
minutes; every slot reports its pair counts with its first and last page, and
the pairs across slot borders come from ordering those slot rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.text import pair_key
from visitlens.functions.times import parse_time
from visitlens.sources.tables import in_date_range

SLOT_SECONDS = 60


def _is_pair(a: str, b: str, pair: tuple[int, int]) -> Column:
    return (F.col(a) == pair[0]) & (F.col(b) == pair[1])


def _pair_counts(
    visits: DataFrame,
    first_page: int,
    pairs: Sequence[tuple[int, int]],
    tie_break: Sequence[str],
    slot_seconds: int,
) -> DataFrame:
    """One row: visits of the first page and the count of each pair."""
    in_slot = Window.partitionBy("session_id", "slot").orderBy("ts", *tie_break)
    names = [f"pair_{i}" for i in range(len(pairs))]
    slots = (
        visits.withColumn("slot", F.floor(F.unix_seconds("ts") / F.lit(slot_seconds)))
        .withColumn("next_page", F.lead("page_id").over(in_slot))
        .withColumn("opens", F.row_number().over(in_slot) == 1)
        .withColumn("closes", F.lead(F.lit(1)).over(in_slot).isNull())
        .groupBy("session_id", "slot")
        .agg(
            F.max(F.when(F.col("opens"), F.col("page_id"))).alias("slot_first"),
            F.max(F.when(F.col("closes"), F.col("page_id"))).alias("slot_last"),
            F.count_if(F.col("page_id") == first_page).alias("first_page"),
            *[
                F.count_if(_is_pair("page_id", "next_page", pair)).alias(name)
                for name, pair in zip(names, pairs)
            ],
        )
    )
    over_slots = Window.partitionBy("session_id").orderBy("slot")
    return slots.withColumn("next_first", F.lead("slot_first").over(over_slots)).agg(
        F.coalesce(F.sum("first_page"), F.lit(0)).alias("first_page"),
        *[
            (
                F.coalesce(F.sum(name), F.lit(0))
                + F.count_if(_is_pair("slot_last", "next_first", pair))
            ).alias(name)
            for name, pair in zip(names, pairs)
        ],
    )


def page_flow_steps(
    actions: DataFrame,
    start: str,
    end: str,
    flow: Sequence[int],
    tie_break: Sequence[str] = ("page_id",),
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Step number, page pair, pair count and conversion rate.

    The first rate is against the visits of the first page, each other one
    against the step before; after a step that never happened it is NULL.
    ``tie_break`` names the columns that order actions of equal time.
    """
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    steps = list(zip(flow, flow[1:]))
    pairs = list(dict.fromkeys(steps))
    visits = in_date_range(actions, start, end).select(
        "session_id",
        "page_id",
        parse_time(F.col("action_time")).alias("ts"),
        *[c for c in tie_break if c != "page_id"],
    )
    counted = _pair_counts(visits, flow[0], pairs, tie_break, slot_seconds)
    count_of = {pair: F.col(f"pair_{i}") for i, pair in enumerate(pairs)}
    before = [F.col("first_page"), *[count_of[s] for s in steps]]
    rows = [
        F.struct(
            F.lit(number).alias("step"),
            F.lit(pair_key(*step)).alias("page_pair"),
            count_of[step].alias("pair_count"),
            F.try_divide(count_of[step].cast("double"), before[number - 1]).alias("rate"),
        )
        for number, step in enumerate(steps, 1)
    ]
    return counted.select(F.inline(F.array(*rows)))


def page_flow_conversion(steps: DataFrame) -> DataFrame:
    """One row of text, ``a_b=rate|b_c=rate``, in flow order.

    ``steps`` has one row per step of the flow, so the list is short.
    """
    text = F.concat(
        F.col("page_pair"), F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("null"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("step", text.alias("text"))))
    return steps.agg(F.array_join(ordered.getField("text"), "|").alias("rate_str"))
