"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word budget. A source smaller than its budget is repeated:
complete epochs first, then a fraction of one. The fraction is drawn without
replacement with probability by quality: each document has the exponential key
``-ln(u) / weight`` and the source takes documents in order of their keys until
the prefix sum of sizes reaches what is left of its budget.

The prefix sums need no source in one task: keys are cut into slices, the sizes
are summed by (source, slice), and only the one slice per source in which the
budget ends is sorted.

Null texts and sources: a null text has no words and is taken 0 times beyond
complete epochs; a null source is a source of its own and comes last. Rows with
equal key, id and text are taken or left together. An empty table gives an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.scratch import save

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SLICES = 4096
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Characters that lower a text's quality weight.
NOISE = "0123456789#$%&*+/<=>@[]^_{|}~"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.5 for noise or nothing, 1.5 for a text without digits and symbols."""
    chars = F.char_length(text)
    clean = F.char_length(F.translate(text, NOISE, ""))
    return F.when(chars > 0, clean / chars + 0.5).otherwise(F.lit(0.5))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """Exponential key: small keys are taken first, heavy documents get small ones."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(2**52)) / weight


def _slice(key: Column) -> Column:
    """Number of the slice; it grows with the key and no slice is hot."""
    return F.floor((1.0 - F.exp(-key)) * SLICES).cast("int")


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    """(doc_id, source, size, place): one narrow row for each document."""
    named = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    key = sampling_key(F.col("doc_id"), quality_weight(F.col("text")), seed)
    return named.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        key.alias("key"), F.xxhash64("text").alias("text_hash"),
    ).select("doc_id", "source", "size", _place())


def _place() -> Column:
    return F.struct(
        _slice(F.col("key")).alias("slice"), F.col("key"), F.col("doc_id"), F.col("text_hash")
    ).alias("place")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, null last, have the weights in turn. The words
    of all sources are shared by weight; no target exceeds ``MAX_EPOCHS`` times
    its source, and what is above goes to the others by weight. A source is at
    its limit exactly if, with all sources of a smaller limit per weight at
    theirs, its share would still reach its own limit.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    ).withColumn("limit", F.col("source_size") * MAX_EPOCHS)
    everything = Window.partitionBy()
    by_limit = Window.orderBy(
        (F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    reach = (
        F.coalesce(F.sum("limit").over(by_limit), none) * F.col("weight")
        + F.col("limit")
        * (F.sum("weight").over(everything)
           - F.coalesce(F.sum("weight").over(by_limit), none))
    )
    total = F.sum("source_size").over(everything)
    limited = weighed.withColumn("limited", reach <= total * F.col("weight")).withColumn(
        "total", total
    )
    rest = F.col("total") - F.sum(F.when(F.col("limited"), F.col("limit")).otherwise(0)).over(
        everything
    )
    open_weight = F.sum(F.when(F.col("limited"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(
        F.try_divide(rest, open_weight) * F.col("weight")
    )
    return limited.select("source", "source_size", target.alias("target"))


def _cuts(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, cut_slice, cut) for each source.

    A document is in the last, partial epoch if its slice is before
    ``cut_slice``, or is that slice and its place is not after ``cut``.
    """
    planned = targets.withColumn(
        "epochs",
        F.when(
            F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
        ).otherwise(0).cast("long"),
    ).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    per_slice = keyed.groupBy("source", F.col("place.slice").alias("slice")).agg(
        F.sum("size").alias("words")
    )
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = per_slice.withColumn(
        "before", F.coalesce(F.sum("words").over(upto), F.lit(0).cast("long"))
    )
    same = F.col("p.source").eqNullSafe(F.col("b.source"))
    ending = (
        before.alias("b")
        .join(planned.alias("p"), same)
        .where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
        .select("p.source", F.col("slice").alias("cut_slice"), "before", "left")
    )
    here = F.col("k.source").eqNullSafe(F.col("e.source")) & (
        F.col("k.place.slice") == F.col("e.cut_slice")
    )
    in_slice = (
        keyed.alias("k").join(ending.alias("e"), here)
        .groupBy("e.source", "cut_slice", "before", "left", "place")
        .agg(F.sum("size").alias("size"))
    )
    sorted_places = Window.partitionBy("source").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    taken = F.col("before") + F.coalesce(F.sum("size").over(sorted_places), F.lit(0).cast("long"))
    cut = (
        in_slice.withColumn("taken", taken)
        .groupBy("source", "cut_slice")
        .agg(F.max(F.when(F.col("taken") + F.col("size") / 2 <= F.col("left"), F.col("place")))
             .alias("cut"))
    )
    return (
        planned.alias("p")
        .join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select("p.source", "source_size", "target", "epochs", "cut_slice", "cut")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with a struct column ``mix`` of size, source_size, target, copies.

    ``copies`` says how many times the mix takes the row. The table of sources
    is small by nature (a weight is stated for each); Spark decides by its size
    whether to broadcast it.
    """
    keyed = save(_keyed(docs, doc_id, text, source, seed))
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = save(_cuts(keyed, source_targets(save(sizes), weights)))
    plan = plan.select(F.struct(*plan.columns).alias("__plan"))
    key = sampling_key(F.col(doc_id), quality_weight(F.col(text)), seed)
    own = docs.withColumn(
        "__own",
        F.struct(
            word_count(F.col(text)).alias("size"), key.alias("key"),
            F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        ),
    )
    place = F.struct(
        _slice(F.col("__own.key")).alias("slice"), F.col("__own.key"),
        F.col("__own.doc_id"), F.col("__own.text_hash"),
    )
    slice_ = _slice(F.col("__own.key"))
    partial = F.coalesce(
        (slice_ < F.col("__plan.cut_slice"))
        | ((slice_ == F.col("__plan.cut_slice")) & (place <= F.col("__plan.cut"))),
        F.lit(False),
    )
    copies = F.col("__plan.epochs") + F.when(partial, 1).otherwise(0)
    return own.join(plan, own[source].eqNullSafe(F.col("__plan.source"))).select(
        *[own[c] for c in docs.columns if c != "mix"],
        F.struct(
            F.col("__own.size").alias("size"),
            F.col("__plan.source_size").alias("source_size"),
            F.col("__plan.target").alias("target"),
            copies.cast("long").alias("copies"),
        ).alias("mix"),
    )


def mixed_rows(docs: DataFrame, **named: str) -> DataFrame:
    """The rows of the mix: ``docs`` with each row as often as the mix takes it."""
    taken = mix(docs, **named)
    # repeats of a row are not null, so the range never runs downwards
    again = F.when(F.col("mix.copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("mix.copies")))
    return taken.withColumn("__copy", F.explode(again)).select(*docs.columns)
