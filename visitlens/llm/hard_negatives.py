"""Hard negatives: rows of another label that come close to an anchor's positives.

An anchor's positives are its best rows of the same label by inner product. Each
positive opens a window of scores below its own, and the best rows of other labels
inside that window are its negatives.

Both steps are threshold joins in :mod:`suffix_index`: a threshold starts high and
is lowered for the anchors whose windows are not full yet, until all are full or
the window's lower end is reached. Rows are dealt to slices and anchors to blocks
of bounded size, by position and not by any value, so that no key can be hot. A
slice meets each block once and passes on the best of each window only; the last
choice is a ranking by anchor.

Rows with a null id or label, a null vector or any null, NaN or infinite entry take
no part. An empty table gives no rows. A ``vec_id`` names a row: rows that share the
anchor's id are none of its "other" rows, and otherwise repeated rows each count.
Shorter vectors count as followed by zeros. Further columns are ignored. Scores that
exceed a long become its bounds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.scratch import save
from visitlens.llm.suffix_index import Rows

POSITIVES = 5
NEGATIVES = 10
#: Per cent of the positive's score between which a negative's lies.
LOWEST, HIGHEST = 30, 90
SLICE_ROWS = 8192
BLOCK_ANCHORS = 1024
ASKING = 256  # anchors that advance together in a task
#: First thresholds for positives, as parts of the greatest score norms allow.
STEPS = (0.6, 0.45, 0.3, 0.15, 0.0)

_KEY = ("block", "slice")
_POSITIVE = "anchor_no long, positive_id long, positive_score long"
_NEGATIVE = "anchor_no long, place int, negative_id long, negative_score long"


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * entry) as double; NULL where an entry is null or not finite."""
    def floored(entry):
        value = entry.cast("double") * F.lit(float(scale))
        # floor() gives a long; doubles from 2^53 on are whole already.
        return F.when(F.abs(value) < float(1 << 53), F.floor(value).cast("double")).otherwise(value)

    def unusable(entry):
        value = entry.cast("double") * F.lit(float(scale))
        return value.isNull() | F.isnan(value) | (F.abs(value) == math.inf)

    return F.when(~F.exists(vector, unusable), F.transform(vector, floored))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """List entries as rows, padded with zeros."""
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width))
    found[np.arange(width) < sizes[:, None]] = values
    return found


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _best_first(a, ids, score):
    """Pairs by anchor, best score first, ties by smaller id."""
    return np.lexsort((ids, -score, a))


def _positives_of(rows: Rows, row_ids, asking, asking_ids, wanted: int):
    """The best ``wanted`` rows of each asking vector, as (asking row, id, score)."""
    reach = np.sqrt((asking * asking).sum(axis=1)) * np.sqrt((rows.rows * rows.rows).sum(axis=1).max())
    open_, found = np.arange(len(asking)), []
    for step in (*STEPS, None):
        floors = np.full(len(open_), -np.inf) if step is None else step * reach[open_]
        a, r, score = rows.pairs(asking[open_], floors)
        other = asking_ids[open_[a]] != row_ids[r]
        a, r, score = a[other], r[other], score[other]
        full = np.bincount(a, minlength=len(open_)) >= wanted
        if step is None:
            full[:] = True
        mine = full[a]
        a, ids, score = open_[a[mine]], row_ids[r[mine]], score[mine]
        order = _best_first(a, ids, score)
        a, ids, score = a[order], ids[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        found.append((a[place < wanted], ids[place < wanted], score[place < wanted]))
        open_ = open_[~full]
        if not len(open_):
            break
    return [np.concatenate(part) for part in zip(*found)]


def find_positives(rows: pa.Table, anchors: pa.Table, wanted: int) -> pa.Table:
    """A slice's best rows of each anchor's label."""
    vectors, asking = _same_width(_matrix(rows["vector"]), _matrix(anchors["vector"]))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    numbers, own_ids = anchors["anchor_no"].to_numpy(), anchors["vec_id"].to_numpy()
    own_labels = anchors["label"].to_numpy()
    found = []
    for label in np.unique(own_labels):
        same, mine = (labels == label).nonzero()[0], (own_labels == label).nonzero()[0]
        if not len(same):
            continue
        index = Rows(vectors[same])
        for at in range(0, len(mine), ASKING):
            some = mine[at : at + ASKING]
            a, found_ids, score = _positives_of(index, ids[same], asking[some], own_ids[some], wanted)
            found.append((numbers[some[a]], found_ids, score))
    columns = [np.concatenate(part) for part in zip(*found)] if found else [np.empty(0, np.int64)] * 3
    return pa.table(dict(zip(("anchor_no", "positive_id", "positive_score"), columns)))


def _windows(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """The whole scores of a window: lowest * score <= 100 * x <= highest * score."""
    return -(-lowest * score // 100), highest * score // 100


def find_negatives(
    rows: pa.Table, anchors: pa.Table, wanted: int, lowest: int, highest: int
) -> pa.Table:
    """A slice's best rows of other labels in each window of each anchor."""
    vectors, asking = _same_width(_matrix(rows["vector"]), _matrix(anchors["vector"]))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    own_labels, numbers = anchors["label"].to_numpy(), anchors["anchor_no"].to_numpy()
    windows = [
        [(place, *_windows(score, lowest, highest)) for place, score in enumerate(scores)]
        for scores in anchors["scores"].to_pylist()
    ]
    windows = [[w for w in own if w[1] <= w[2]] for own in windows]
    index = Rows(vectors)
    asked = np.array([i for i, own in enumerate(windows) if own], np.int64)
    found = []
    for at in range(0, len(asked), ASKING):
        open_ = asked[at : at + ASKING]
        last = np.array([min(w[1] for w in windows[i]) for i in open_], float)
        least = np.array([min(w[2] for w in windows[i]) for i in open_], float)
        gap = np.maximum(1.0, (least - last) / 32)
        floors = np.maximum(last, least - gap)
        while len(open_):
            a, r, score = index.pairs(asking[open_], floors)
            other = own_labels[open_[a]] != labels[r]
            a, found_ids, score = a[other], ids[r[other]], score[other]
            order = _best_first(a, found_ids, score)
            a, found_ids, score = a[order], found_ids[order], score[order]
            borders = np.searchsorted(a, np.arange(len(open_) + 1))
            full = np.zeros(len(open_), bool)
            for i, anchor in enumerate(open_):
                falling = -score[borders[i] : borders[i + 1]]
                cuts = [
                    (place, np.searchsorted(falling, -high), np.searchsorted(falling, -low, "right"))
                    for place, low, high in windows[anchor]
                ]
                full[i] = floors[i] <= last[i] or all(end - begin >= wanted for _, begin, end in cuts)
                if full[i]:
                    for place, begin, end in cuts:
                        chosen = slice(borders[i] + begin, borders[i] + min(end, begin + wanted))
                        n = chosen.stop - chosen.start
                        found.append((
                            np.full(n, numbers[anchor]), np.full(n, place, np.int32),
                            found_ids[chosen], score[chosen],
                        ))
            left = ~full
            open_, last, least, gap = open_[left], last[left], least[left], 2 * gap[left]
            floors = np.maximum(last, floors[left] - gap)
    names = ("anchor_no", "place", "negative_id", "negative_score")
    kinds = (np.int64, np.int32, np.int64, np.int64)
    columns = [np.concatenate(p) for p in zip(*found)] if found else [np.empty(0, k) for k in kinds]
    return pa.table(dict(zip(names, columns)))


def _met(rows: DataFrame, anchors: DataFrame, slices: int, blocks: int, find, schema: str) -> DataFrame:
    """What ``find`` makes of each slice of rows and block of anchors."""
    every = {"block": F.sequence(F.lit(0), F.lit(blocks - 1)), "slice": F.sequence(F.lit(0), F.lit(slices - 1))}
    left = rows.withColumn("block", F.explode(every["block"])).groupBy(*_KEY)
    right = anchors.withColumn("slice", F.explode(every["slice"])).groupBy(*_KEY)

    def meet(some_rows: pa.Table, some_anchors: pa.Table) -> pa.Table:
        return find(some_rows, some_anchors)

    return left.cogroup(right).applyInArrow(meet, schema)


def _ranked(found: DataFrame, key: list[str], score: str, row: str, wanted: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Negatives of each anchor and positive of ``vec_id, label, vector, anchor``.

    ``vector`` holds whole numbers as doubles, ``anchor`` marks the rows to ask for.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    )
    rows = vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"),
        F.coalesce("anchor", F.lit(False)).alias("anchor"),
        F.monotonically_increasing_id().alias("anchor_no"),
    )
    sizes = rows.agg(F.count("*"), F.count_if("anchor")).first()
    slices, blocks = (max(1, math.ceil(n / size)) for n, size in zip(sizes, (SLICE_ROWS, BLOCK_ANCHORS)))
    # Places in a partition, not values, so that equal rows are dealt out as well.
    dealt = rows.withColumn("slice", F.pmod("anchor_no", F.lit(slices)).cast("int"))
    anchors = save(
        dealt.where("anchor").select(
            "anchor_no", "vec_id", "label", "vector",
            F.pmod(F.xxhash64("anchor_no"), F.lit(blocks)).cast("int").alias("block"),
        )
    )
    dealt = dealt.select("vec_id", "label", "vector", "slice")
    near = _met(
        dealt, anchors, slices, blocks, lambda r, a: find_positives(r, a, positives), _POSITIVE
    )
    best = _ranked(near, ["anchor_no"], "positive_score", "positive_id", positives)
    by_anchor = best.groupBy("anchor_no").agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("best")
    )
    asking = save(
        anchors.join(by_anchor, "anchor_no").select(
            "*", F.col("best.positive_score").alias("scores")
        )
    )
    found = _met(
        dealt, asking.drop("best"), slices, blocks,
        lambda r, a: find_negatives(r, a, negatives, lowest, highest), _NEGATIVE,
    )
    chosen = _ranked(found, ["anchor_no", "place"], "negative_score", "negative_id", negatives)
    positive = F.get("best", F.col("place"))
    return chosen.join(asking.select("anchor_no", "vec_id", "best"), "anchor_no").select(
        F.col("vec_id").alias("anchor_id"), positive["positive_id"].alias("positive_id"), "rank",
        "negative_id", positive["positive_score"].alias("positive_score"), "negative_score",
    )
