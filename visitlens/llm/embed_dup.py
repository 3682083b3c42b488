"""Near-duplicates of embeddings by E8 lattice hashing.

1. Equal vectors become one node: a number of its own, its copies, its smallest id.
2. In each of ``TABLES`` tables a node is projected at random to ``PARTS`` times
   eight dimensions and each part is decoded to its nearest E8 point; the points
   together name its cell. It lives there and also visits the cells that differ
   in one part by one of the ``PROBES`` next points.
3. In each cell residents are compared with residents and visitors, by cosine in
   double precision, in blocks that different tasks may hold. A pair that meets
   more than once counts where it meets first, which its cells tell; so links are
   counted without listing them.
4. Each block names the smallest member that each node reaches in it; components
   follow by large-star and small-star, and take the smallest id of their nodes.

A pair of cosine 0.9 is found with a probability of about 0.97 (2 to 512 components
were simulated), one of 0.95 almost surely; no pair below 0.9 is linked.

Cases: a vector that is null, empty or zero, or holds null, NaN or infinity links
with nothing; so does a row with a null id, whose component is null. Vectors of
different lengths aren't compared. Rows are compared by their vectors, whatever
their ids: repeated rows link with each other, and an id that comes with different
vectors has the links of each in the row of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.components import connected_components
from visitlens.llm.lattice import nearest
from visitlens.llm.scratch import save
from visitlens.llm.shingles import mixed

TABLES, PARTS, PROBES = 16, 3, 2
#: A unit vector's image has an expected length of SCALE * sqrt(24 / DIMENSION), for
#: vectors of any length; a cell is about one wide.
SCALE, DIMENSION = 3.2, 64
COSINE = 0.9
BLOCK = 256
SEED = 8


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; a power of two keeps squares from overflowing or vanishing."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


@lru_cache(maxsize=4)
def _projection(size: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, TABLES * PARTS * 8) projections and the shifts of the lattices."""
    rng = np.random.default_rng((SEED, size))
    width = PARTS * 8
    # a projection to 24 of more components shortens, one of fewer doesn't
    scale = SCALE * np.sqrt(max(size, width) / DIMENSION)
    tables = []
    for _ in range(TABLES):
        gauss = rng.standard_normal((max(size, width), width))
        tables.append(np.linalg.qr(gauss)[0][:size] * scale)
    return np.concatenate(tables, axis=1), rng.uniform(0, 1, TABLES * width)


def cells(vectors: np.ndarray) -> np.ndarray:
    """(n, TABLES, 1 + PARTS * PROBES) hashed cells; a node's own comes first.

    The sums run over the dimensions one by one, so that a vector gets the same
    cells in every batch, which matrix products don't promise.
    """
    n, size = vectors.shape
    projection, shift = _projection(size)
    unit = _units(vectors)
    image = np.tile(shift, (n, 1))
    for d in range(size):
        image += unit[:, d, None] * projection[d]
    points = nearest(image.reshape(-1, 8), PROBES)
    hashed = []
    for point in points:
        h = np.zeros(len(point), dtype=np.uint64)
        for i in range(8):
            h = mixed(h * np.uint64(31) + point[:, i].astype(np.uint64))
        hashed.append(h.reshape(n, TABLES, PARTS))

    def named(parts: list[np.ndarray]) -> np.ndarray:
        h = np.broadcast_to(np.arange(1, TABLES + 1, dtype=np.uint64), (n, TABLES))
        for part in parts:
            h = mixed(h * np.uint64(31) + part)
        return h

    own = [hashed[0][:, :, p] for p in range(PARTS)]
    out = [named(own)]
    for p in range(PARTS):
        for other in hashed[1:]:
            out.append(named([*own[:p], other[:, :, p], *own[p + 1 :]]))
    return np.stack(out, axis=2).view(np.int64)


def _describe(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, vectors = [], []
            for values in batch.column("embedding").to_pylist():
                raw = None
                if values and None not in values:
                    vector = np.array(values, dtype=kind)
                    if np.isfinite(vector).all() and vector.any():
                        raw = (vector + kind(0)).tobytes()  # -0.0 is 0.0
                digests.append(raw and blake2b(raw, digest_size=16).digest())
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(digests, pa.binary()),
                 pa.array(vectors, pa.binary())],
                ["vec_id", "digest", "vector"],
            )

    return run


def _stacks(raw: list[bytes], kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length of vector."""
    sizes = np.array([len(v) for v in raw])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        joined = b"".join(raw[i] for i in rows)
        yield rows, np.frombuffer(joined, kind).reshape(len(rows), -1).astype(np.float64)


def _to_cells(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = TABLES * (1 + PARTS * PROBES)
        lives = np.zeros((TABLES, 1 + PARTS * PROBES), dtype=bool)
        lives[:, 0] = True
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            for rows, vectors in _stacks(batch.column("vector").to_pylist(), kind):
                for at in range(0, len(rows), 512):
                    own = rows[at : at + 512]
                    keys = cells(vectors[at : at + 512])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.repeat(nodes[own], each)),
                         pa.array(np.tile(lives.ravel(), len(own)))],
                        ["cell", "node", "lives"],
                    )

    return run


def _first_meeting(keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair the cell in which it counts: that of the first table where
    they meet, the shared one or the one in which i lives or else j lives."""
    own_i, own_j = keys[i, :, 0], keys[j, :, 0]
    j_comes = (own_i[:, :, None] == keys[j]).any(axis=2)
    i_comes = (own_j[:, :, None] == keys[i]).any(axis=2)
    first = np.argmax(j_comes | i_comes, axis=1)
    rows = np.arange(len(i))
    return np.where(j_comes[rows, first], own_i[rows, first], own_j[rows, first])


def _compare(kind: type):
    """Links that each block counts: (node, links, reaches)."""
    plain = ("cell", "low", "high", "block", "node", "lives", "copies")

    def links(r: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        group = np.repeat(np.arange(len(starts)), sizes)
        found_i, found_j = [], []
        for rows, vectors in _stacks(r["vector"].tolist(), kind):
            unit = _units(vectors)
            own = group[rows]
            most = np.bincount(own).max(initial=0) if len(own) else 0
            for apart in range(1, int(most)):
                i = np.flatnonzero(own[apart:] == own[:-apart])
                a, b = rows[i], rows[i + apart]
                across = (r["low"][a] == r["high"][a]) | (r["block"][a] != r["block"][b])
                use = across & (r["lives"][a] | r["lives"][b])
                i, a, b = i[use], a[use], b[use]
                for at in range(0, len(i), 8192):
                    part = slice(at, at + 8192)
                    same = np.einsum("ij,ij->i", unit[i[part]], unit[i[part] + apart]) >= COSINE
                    found_i.append(a[part][same])
                    found_j.append(b[part][same])
        i = np.concatenate([np.empty(0, np.int64), *found_i])
        j = np.concatenate([np.empty(0, np.int64), *found_j])
        counts = np.zeros(len(group), dtype=np.int64)
        reaches = r["node"].copy()
        if len(i):
            swap = r["node"][i] > r["node"][j]  # the smaller node comes first
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            keys = np.zeros((len(group), TABLES, 1 + PARTS * PROBES), dtype=np.int64)
            used = np.unique(np.concatenate((i, j)))
            for rows, vectors in _stacks(r["vector"][used].tolist(), kind):
                keys[used[rows]] = cells(vectors)
            for at in range(0, len(i), 4096):
                a, b = i[at : at + 4096], j[at : at + 4096]
                here = _first_meeting(keys, a, b) == r["cell"][a]
                np.add.at(counts, a[here], r["copies"][b[here]])
                np.add.at(counts, b[here], r["copies"][a[here]])
            before = None
            while before is None or (before != reaches).any():
                before = reaches.copy()
                np.minimum.at(reaches, i, reaches[j])
                np.minimum.at(reaches, j, reaches[i])
        told = (counts > 0) | (reaches != r["node"])
        return pa.RecordBatch.from_arrays(
            [pa.array(r["node"][told]), pa.array(counts[told]), pa.array(reaches[told])],
            ["node", "links", "reaches"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by (cell, low, high); a block may go on in the next batch
        waiting: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*plain, "vector")}
            if waiting is not None:
                now = {c: np.concatenate((waiting[c], now[c])) for c in now}
            new = np.ones(len(now["cell"]), dtype=bool)
            new[1:] = False
            for c in ("cell", "low", "high"):
                new[1:] |= now[c][1:] != now[c][:-1]
            starts = np.flatnonzero(new)
            last = starts[-1]
            if last:
                full = {c: v[:last] for c, v in now.items()}
                yield links(full, starts[:-1], starts[1:])
            waiting = {c: v[last:].copy() for c, v in now.items()}
        if waiting is not None:
            yield links(waiting, np.array([0]), np.array([len(waiting["cell"])]))

    return run


def near_duplicate_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``."""
    named = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")
    )
    kind = np.float32 if "float" in named.schema["embedding"].dataType.simpleString() else np.float64
    described = save(
        named.mapInArrow(_describe(kind), "vec_id long, digest binary, vector binary")
    )
    nodes = save(
        described.where(F.col("vec_id").isNotNull() & F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"),
             F.min("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id())  # stored with the row
    )
    placed = save(
        nodes.select("node", "vector").mapInArrow(
            _to_cells(kind), "cell long, node long, lives boolean"
        )
    )
    shared = save(
        placed.groupBy("cell")
        .agg(F.count("*").alias("members"), F.max("lives").alias("used"))
        .where("members > 1 AND used")
        .select("cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    members = save(placed.join(shared, "cell"))
    with_vectors = members.join(nodes.select("node", "copies", "vector"), "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # each member meets every block of its cell, its own included
    spread = with_vectors.withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "cell", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        "block", "node", "lives", "copies", "vector",
    )
    counted = save(
        spread.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_compare(kind), "node long, links long, reaches long")
    )
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(counted.where("node != reaches"), "node", "reaches")
    placed_nodes = save(
        nodes.select("node", "digest", "copies", "least")
        .join(links, "node", "left").join(components, "node", "left")
        .select(
            "digest", "least", F.coalesce("component", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    # combined before the shuffle and written, so that a large component is one row here
    roots = save(placed_nodes.groupBy("root").agg(F.min("least").alias("component")))
    told = save(
        placed_nodes.join(roots, "root").select("digest", "n_links", "component")
    )
    return (
        described.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(told, "digest", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
