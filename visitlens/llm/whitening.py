"""Whitening of vectors by a covariance weighted with their multiplicity.

Equal vectors are grouped first. Sums, the covariance and the whitening then run
over distinct vectors, each weighing as often as it occurs (or once), and the
result joins back to the rows by the vectors' digest, so that a vector that a
third of all rows share is worked on once and only ids travel for its rows.

Entries are whole numbers below 2^53 and their sums exact; entries are centred
before they are multiplied. A task adds up a whole block of vectors by one matrix
product and passes on one matrix; the driver holds no more than a few matrices of
dimensions x dimensions, and finds the eigenvectors.

Rows with a null vector or with any null, NaN, infinite or larger entry are left
out. Shorter vectors count as followed by ``missing``. Repeated rows and null ids
stay rows of their own. Without any row the result is empty. A component whose
eigenvalue is nothing but rounding has ``whitened`` NULL and doesn't count for the
error. Columns besides ``vec_id`` and ``x`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.scratch import save

COMPONENTS = 32
WHOLE = 1 << 53
_BLOCK = 4096  # vectors multiplied at once


@dataclass(frozen=True)
class Fit:
    """What whitening needs: all of it as large as the dimensions, not the rows."""

    n: int  # vectors, by weight
    sums: tuple[int, ...]  # of each dimension, exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float

    @property
    def means(self) -> list[int]:
        """Nearest whole numbers of the dimensions' means."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    @property
    def rests(self) -> list[int]:
        """n times what the means leave: at most n / 2."""
        return [s - self.n * m for s, m in zip(self.sums, self.means)]

    def kept(self) -> np.ndarray:
        """Components with more variance than rounding makes."""
        floor = len(self.values) * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)
        return self.values > floor


def whole_vectors(vector: Column, scale: int, offset: int) -> Column:
    """floor(scale * entry) + offset as longs; NULL where an entry is not usable."""

    def scaled(entry):
        return entry.cast("double") * F.lit(float(scale))

    def unusable(entry):
        return (
            entry.isNull() | F.isnan(scaled(entry)) | (F.abs(scaled(entry)) >= float(WHOLE - abs(offset)))
        )

    whole = F.transform(vector, lambda entry: F.floor(scaled(entry)) + F.lit(offset).cast("long"))
    return F.when(~F.exists(vector, unusable), whole)


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            yield batch.slice(at, _BLOCK)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each vector once, with its digest and its number of rows."""
    return rows.groupBy("digest", "x").agg(F.count(F.lit(1)).alias("copies"))


def _exact_sums(distinct: DataFrame, width: int, weight: str) -> tuple[int, list[int]]:
    """Weights and weighted sums of the dimensions; a task passes on a row a dimension."""

    def add(batches):
        n, sums = 0, [0] * width
        for block in _blocks(batches):
            x, w = _lists(block["x"], width), block["weight"].to_numpy()
            n += int(w.sum())
            # high and low halves, so that products with the weights stay exact
            high, low = x >> 26, x & ((1 << 26) - 1)
            for part, shift in ((high, 26), (low, 0)):
                for d, total in enumerate(_products(w, part)):
                    sums[d] += total << shift
        yield pa.RecordBatch.from_pydict(
            {"dimension": pa.array(range(-1, width), pa.int32()),
             "total": pa.array([str(t) for t in (n, *sums)], pa.string())}
        )

    parts = distinct.select("x", F.col(weight).cast("long").alias("weight"))
    found = (
        parts.mapInArrow(add, "dimension int, total string")
        .groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    )
    totals = {r["dimension"]: int(r["total"]) for r in found.collect()}
    return totals.get(-1, 0), [totals.get(d, 0) for d in range(width)]


def _products(weights: np.ndarray, part: np.ndarray) -> list[int]:
    """weights @ part in whole numbers."""
    reach = int(np.abs(part).max(initial=0)) * int(weights.sum())
    if reach < 1 << 62:
        return [int(t) for t in weights @ part]
    return [sum(int(w) * int(x) for w, x in zip(weights, column)) for column in part.T]


def _gram(parts: DataFrame, centre, width: int) -> np.ndarray:
    """Sum of weight * z z' over all rows, z = centre(block)."""

    def multiply(batches):
        total = np.zeros((width, width))
        for block in _blocks(batches):
            z = centre(block)
            total += (z * block["weight"].to_numpy()[:, None]).T @ z
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(width), pa.int32()),
             "line": pa.array(list(total), pa.list_(pa.float64()))}
        )

    lines = parts.mapInArrow(multiply, "i int, line array<double>")
    cells = lines.select("i", F.posexplode("line").alias("j", "value"))
    found = np.zeros((width, width))
    for row in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        found[row["i"], row["j"]] = row["value"]
    return (found + found.T) / 2


def _centred(block: pa.RecordBatch, fit: Fit) -> np.ndarray:
    """x - S/n: the whole part exactly, then the rest below a half."""
    width = len(fit.sums)
    near = _lists(block["x"], width) - np.array(fit.means, np.int64)
    return near - np.array([r / fit.n for r in fit.rests])


def learn(distinct: DataFrame, width: int, weight: str = "copies") -> Fit | None:
    """Fit on distinct vectors: ``weight="copies"``, or a column of ones."""
    n, sums = _exact_sums(distinct, width, weight)
    if not n:
        return None
    rough = Fit(n, tuple(sums), np.zeros(0), np.zeros((width, 0)), 0.0)
    parts = distinct.select("x", F.col(weight).cast("double").alias("weight"))
    covariance = _gram(parts, lambda block: _centred(block, rough), width) / n
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, rough.sums, values[::-1].copy(), vectors[:, ::-1].copy(), float(np.trace(covariance)))


def _deviations(block: pa.RecordBatch, fit: Fit) -> list[int]:
    """Sum of (n * x - S)^2, exact: with x = mean + y and S = n * mean + r it is
    n^2 * sum(y^2) - 2 n * sum(r * y) + sum(r^2)."""
    near = _lists(block["x"], len(fit.sums)) - np.array(fit.means, np.int64)
    rests = np.array(fit.rests, np.int64)
    reach = int(np.abs(near).max(initial=0))
    if max(reach * reach * near.shape[1], reach * sum(map(abs, fit.rests))) >= 1 << 62:
        near, rests = near.astype(object), rests.astype(object)
    squares, across = (near * near).sum(axis=1), near @ rests
    own = sum(r * r for r in fit.rests)
    return [fit.n**2 * int(s) - 2 * fit.n * int(a) + own for s, a in zip(squares, across)]


def whiten_distinct(distinct: DataFrame, fit: Fit, components: int) -> DataFrame:
    """digest, copies, deviation and the list ``whitened`` of each distinct vector."""
    kept = fit.kept()[:components]
    scales = np.where(kept, 1 / np.sqrt(np.where(kept, fit.values[:components], 1.0)), np.nan)
    axes = fit.vectors[:, :components] * scales

    def project(batches):
        for block in _blocks(batches):
            z = _centred(block, fit) @ axes
            # a sum over 38 digits has no decimal: it stays null
            deviation = [str(d) if d < 10**38 else None for d in _deviations(block, fit)]
            yield pa.RecordBatch.from_arrays(
                [block["digest"], block["copies"], pa.array(deviation, pa.string()),
                 pa.array(list(z), pa.list_(pa.float64()))],
                ["digest", "copies", "deviation", "whitened"],
            )

    found = distinct.select("digest", "copies", "x").mapInArrow(
        project, "digest binary, copies long, deviation string, whitened array<double>"
    )
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(whitened: DataFrame, fit: Fit, components: int, weight: str) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    kept = fit.kept()[:components].nonzero()[0]
    if not len(kept):
        return 0.0
    parts = whitened.select("whitened", F.col(weight).cast("double").alias("weight"))

    def add(batches):
        total = np.zeros(components)
        for block in _blocks(batches):
            total += block["weight"].to_numpy() @ _lists(block["whitened"], components)
        yield pa.RecordBatch.from_pydict(
            {"j": pa.array(range(components), pa.int32()), "total": pa.array(total)}
        )

    sums = np.zeros(components)
    added = parts.mapInArrow(add, "j int, total double").groupBy("j").agg(F.sum("total").alias("total"))
    for row in added.collect():
        sums[row["j"]] = row["total"]
    mean = sums[kept] / fit.n
    found = _gram(parts, lambda b: _lists(b["whitened"], components)[:, kept] - mean, len(kept))
    return float(np.abs(found / fit.n - np.eye(len(kept))).max())


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, missing: int = 0, count_copies: bool = True
) -> DataFrame:
    """``vec_id, x`` (array of longs) to a row per vector: vec_id, n, deviation (decimal),
    whitened, explained (lists by component) and identity_error.

    ``count_copies=False`` fits on every distinct vector once. Then n, deviation and
    the error are those of that fit.
    """
    usable = F.col("x").isNotNull() & ~F.exists("x", lambda e: e.isNull() | (F.abs(e) >= WHOLE))
    given = vectors.where(usable).select("vec_id", F.col("x").cast("array<long>").alias("x"))
    width = given.agg(F.max(F.size("x"))).first()[0] or 0
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, " \
        "explained array<double>, identity_error double"
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    padding = F.array_repeat(F.lit(missing).cast("long"), F.lit(width) - F.size("x"))
    full = F.when(F.size("x") < width, F.concat("x", padding)).otherwise(F.col("x"))
    text = F.array_join(F.col("x").cast("array<string>"), ",")
    rows = given.withColumn("x", full).withColumn("digest", F.unhex(F.sha2(text, 256)))
    distinct = save(distinct_vectors(rows).withColumn("once", F.lit(1).cast("long")))
    components = min(components, width)
    weight = "copies" if count_copies else "once"
    fit = learn(distinct, width, weight)
    whitened = save(
        whiten_distinct(distinct, fit, components).withColumn("once", F.lit(1).cast("long"))
    )
    error = identity_error(whitened, fit, components, weight)
    explained = [float(v / fit.trace) if fit.trace > 0 else 0.0 for v in fit.values[:components]]
    numbers = F.transform("whitened", lambda z: F.when(~F.isnan(z), z))
    return rows.select("vec_id", "digest").join(whitened, "digest").select(
        "vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", numbers.alias("whitened"),
        F.array(*(F.lit(e) for e in explained)).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
