"""MinHash near-duplicates: which documents share most of their word shingles.

1. Documents with equal shingle sets become one node (equality is a link).
2. ``HASHES`` universal hash minima per node; ``BANDS`` bands of ``ROWS`` minima
   each, no minimum in two bands. At a similarity of 0.8 two nodes miss each other
   in all bands with a probability below 1e-6.
3. In every bucket of a band the members are held against one leading member and
   confirmed on their full sets. That joins large groups of copies in one pass,
   with as many checks as members.
4. Members of a bucket that are still in different components are compared by
   their signatures, in blocks. Components with similar signatures form a
   cluster; a block names only which components it joins to clusters.
5. In a cluster all pairs of different components are compared, each once, by
   signature and, if that agrees, on the full sets, in blocks that different tasks
   may hold. A block gives only the links that join its components. No bucket or
   cluster is cut off, and no list of pairs is written.
6. Components by large-star and small-star after steps 3, 4 and 5.

Cases: a null or empty text, or one without words, has an empty set and is
linked with nothing. Rows with the same id count as linked. A row with a null id
is in no link, its component is null and it is kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.components import connected_components
from visitlens.llm.scratch import save
from visitlens.llm.shingles import SHINGLE_WORDS, mixed, overlap, shingles

BANDS, ROWS = 48, 6
HASHES = BANDS * ROWS
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: The first minima are the signature that pairs are compared by. Those that agree
#: in fewer places are not similar: at 0.8 that has a probability of 3e-8.
COMPARED, LEAST_AGREEING = 128, 76
#: Members of a bucket, or a cluster, that a task compares with as many others at once.
BLOCK, CLUSTER_BLOCK = 256, 1024

_rng = np.random.default_rng(20240601)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def minima(values: np.ndarray) -> np.ndarray:
    """The minima of a non-empty set under all hashes, as unsigned 32-bit values."""
    low = np.full(HASHES, 2**32 - 1, dtype=np.uint64)
    for at in range(0, len(values), 256):
        hashed = (values[at : at + 256, None] * _MULTIPLY + _ADD) >> np.uint64(32)
        np.minimum(low, hashed.min(axis=0), out=low)
    return low.astype(np.uint32)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, BANDS) bucket keys as signed 64-bit values."""
    bands = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys.view(np.int64)


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, lows = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, words)
                sizes.append(len(values))
                full = len(values) > 0
                digests.append(blake2b(values.tobytes(), digest_size=16).digest() if full else None)
                lows.append(minima(values) if full else None)
            keys = iter(band_keys(np.array([m for m in lows if m is not None], np.uint32)))
            bands = [None if m is None else next(keys).tobytes() for m in lows]
            # the lowest byte of a minimum is enough to compare by
            short = [None if m is None else m[:COMPARED].astype(np.uint8).tobytes() for m in lows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.binary()), pa.array(short, pa.binary())],
                ["id", "n_shingles", "digest", "bands", "signature"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])


def _confirm(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            for one, two, text_one, text_two in zip(*columns, strict=True):
                if text_two != last_text:  # rows come sorted by b
                    last_text, last = text_two, shingles(text_two, words)
                mine = shingles(text_one, words)
                common = overlap(mine, last)
                if common and 100 * common >= PERCENT * (len(mine) + len(last) - common):
                    a.append(one)
                    b.append(two)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return save(both.mapInArrow(_confirm(words), "a long, b long"))


def _rows(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns of a batch as arrays, the signatures as a matrix of bytes."""
    raw = b"".join(batch.column("signature").to_pylist())
    return {
        c: batch.column(c).to_numpy(zero_copy_only=False)
        for c in batch.schema.names if c != "signature"
    } | {"signature": np.frombuffer(raw, np.uint8).reshape(-1, COMPARED)}


def _blocks(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(rows of whole blocks, number of each row's block).

    Rows come sorted by (key, low, high); a block may go on in the next batch, so
    the last one of a batch waits for it.
    """
    waiting: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = _rows(batch)
        if waiting is not None:
            now = {c: np.concatenate((waiting[c], now[c])) for c in now}
        new = np.zeros(len(now["key"]), dtype=bool)
        for c in ("key", "low", "high"):
            new[1:] |= now[c][1:] != now[c][:-1]
        number = np.cumsum(new)
        last = int(np.searchsorted(number, number[-1]))
        if last:
            yield {c: v[:last] for c, v in now.items()}, number[:last]
        waiting = {c: v[last:].copy() for c, v in now.items()}
    if waiting is not None:
        yield waiting, np.zeros(len(waiting["key"]), dtype=np.int64)


def _similar(
    r: dict[str, np.ndarray], number: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows i and j of one block, of different components, whose signatures agree,
    and in how many places."""
    most = int(np.bincount(number).max(initial=0))
    for apart in range(1, most):
        i = np.flatnonzero(number[apart:] == number[:-apart])
        j = i + apart
        # within a pair of different blocks, only across the two
        across = (r["low"][i] == r["high"][i]) | (r["block"][i] != r["block"][j])
        use = across & (r["component"][i] != r["component"][j])
        i, j = i[use], j[use]
        agreeing = (r["signature"][i] == r["signature"][j]).sum(axis=1)
        found = agreeing >= LEAST_AGREEING
        if found.any():
            yield i[found], j[found], agreeing[found]


def _clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(component, smaller component of its cluster) as blocks of buckets tell."""
    for r, number in _blocks(batches):
        components, own = np.unique(r["component"], return_inverse=True)
        ends = [(own[i], own[j]) for i, j, _ in _similar(r, number)]
        if not ends:
            continue
        i, j = (np.concatenate(e) for e in zip(*ends, strict=True))
        least, before = np.arange(len(components)), None
        while before is None or (least != before).any():
            before = least.copy()
            np.minimum.at(least, i, before[j])
            np.minimum.at(least, j, before[i])
        moved = np.flatnonzero(least != np.arange(len(components)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(components[moved]), pa.array(components[least[moved]])], ["a", "b"]
        )


def _links_in_clusters(words: int):
    """Confirmed links that join components, from blocks of clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, number in _blocks(batches):
            told = list(_similar(r, number))
            if not told:
                continue
            i, j, agreeing = (np.concatenate(t) for t in zip(*told, strict=True))
            _, own = np.unique(r["component"], return_inverse=True)
            joined = list(range(int(own.max()) + 1))

            def root(c: int) -> int:
                while joined[c] != c:
                    joined[c] = joined[joined[c]]
                    c = joined[c]
                return c

            sets: dict[int, np.ndarray] = {}
            links: list[tuple[int, int]] = []
            order = np.argsort(-agreeing, kind="stable")  # likely links come first
            for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
                one, two = root(int(own[a])), root(int(own[b]))
                if one == two:  # joined already: no further link is needed
                    continue
                for row in (a, b):
                    if row not in sets:
                        sets[row] = shingles(r["text"][row], words)
                common = overlap(sets[a], sets[b])
                if 100 * common >= PERCENT * (len(sets[a]) + len(sets[b]) - common):
                    joined[max(one, two)] = min(one, two)
                    links.append((int(r["node"][a]), int(r["node"][b])))
            if links:
                ends = list(zip(*links, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(e, pa.int64()) for e in ends], ["a", "b"]
                )

    return run


def _leading_links(shared: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Each member against the leader that it meets most often, confirmed."""
    met = shared.where(F.col("node") != F.col("leader")).groupBy("node", "leader").count()
    chosen = met.groupBy("node").agg(F.max(F.struct("count", "leader")).alias("best"))
    pairs = save(chosen.select(F.col("node").alias("a"), F.col("best.leader").alias("b")))
    return _confirmed(pairs, texts, words)


def _in_blocks(members: DataFrame, size: int, *more: str) -> DataFrame:
    """Members (key, node, component, signature, members) dealt to blocks of about
    ``size``: each member meets every block of its key, its own included."""
    dealt = members.withColumn("blocks", F.ceil(F.col("members") / size).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    spread = dealt.withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        "block", "node", "component", "signature", *more,
    )
    return spread.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def _several_components(placed: DataFrame) -> DataFrame:
    """(key, members) of the keys whose members are in different components."""
    return (
        placed.groupBy("key")
        .agg(
            F.min("component").alias("one"), F.max("component").alias("other"),
            F.count("*").alias("members"),
        )
        .where("one != other").select("key", "members")
    )


def _open_links(
    shared: DataFrame, components: DataFrame, nodes: DataFrame, texts: DataFrame, words: int
) -> DataFrame:
    """Confirmed links between nodes in different components."""
    short = nodes.select("node", "signature")
    placed = save(
        shared.select("key", "node")
        .join(components, "node", "left")
        .select("key", "node", F.coalesce("component", "node").alias("component"))
    )
    members = save(placed.join(save(_several_components(placed)), "key")).join(short, "node")
    near = _in_blocks(members, BLOCK).mapInArrow(_clusters, "a long, b long")
    cluster = save(connected_components(near)).select(
        F.col("node").alias("component"), F.col("component").alias("key")
    )
    of_node = placed.select("node", "component").distinct().join(cluster, "component")
    in_cluster = save(of_node.select("key", "node", "component"))
    with_texts = (
        in_cluster.join(save(_several_components(in_cluster)), "key")
        .join(short, "node").join(texts.withColumnRenamed("id", "node"), "node")
    )
    blocks = _in_blocks(with_texts, CLUSTER_BLOCK, "text")
    return save(blocks.mapInArrow(_links_in_clusters(words), "a long, b long"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    named = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")
    )
    described = save(
        named.mapInArrow(
            _describe(words),
            "id long, n_shingles long, digest binary, bands binary, signature binary",
        )
    )
    usable = described.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    nodes = save(
        usable.groupBy("digest")
        .agg(F.min(F.struct("id", "bands", "signature")).alias("first"))
        .select("digest", F.col("first.id").alias("node"), "first.bands", "first.signature")
    )
    bands = save(
        nodes.select("node", "bands").mapInArrow(_bands, "key long, node long")
    )
    leader = F.min(F.struct(F.xxhash64("node").alias("order"), "node"))
    met = save(
        bands.groupBy("key")
        .agg(F.count("*").alias("members"), leader.alias("leader"))
        .where("members > 1")
        .select("key", F.col("leader.node").alias("leader"))
    )
    shared = save(bands.join(met, "key"))
    wanted = save(shared.select(F.col("node").alias("id")).distinct())
    texts = save(named.join(wanted, "id", "left_semi"))
    # rows with one id but other texts are linked by their id
    first = _leading_links(shared, texts, words)
    found = save(connected_components(first))
    components = connected_components(
        first.union(_open_links(shared, found, nodes, texts, words))
    )
    of_digest = save(
        nodes.select("digest", "node")
        .join(components, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component"))
    )
    return (
        described.select("id", "n_shingles", "digest")
        .join(of_digest, "digest", "left")
        .select(
            F.col("id").alias("doc_id"), "n_shingles",
            F.when(
                F.col("id").isNotNull(), F.coalesce("component", "id")
            ).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
