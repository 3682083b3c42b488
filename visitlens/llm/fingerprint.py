"""Document fingerprints as invertible Bloom lookup sketches, built-in functions only.

A text is the set of its paragraphs: pieces between line ends, and between marks
that end a sentence or clause. Pieces without such marks that are long are cut
after words that their own hash chooses, what is still long after characters, so
that an edit changes few of them; the pieces of a short text are its words. A
paragraph is a 64-bit digest.

A sketch has 2**levels blocks, which bits of a digest's hash choose; a block has
``ROWS`` rows of ``CELLS`` cells, and each digest is in one cell of each row. A
cell holds how many digests it got, their XOR and the XOR of their check hashes.
Subtracting the sketches of two texts cancels what they share. A cell that is left
with one digest reveals it; taking it out of its other cells reveals more, until
all differing digests are known and every cell is empty.

The fingerprint of a text is its sketch with at most ``LOAD`` digests a block on
average. Two fingerprints are brought to the size of the smaller one (two blocks
that differ in their last bit add up to one) and subtracted. Where they differ too
much to peel, larger sketches of the same texts with other hashes are compared;
blocks that fail are tried again twice as large, until all cells are empty. All of it happens within
the row, in time that grows as the text does, times the logarithm of its length.

The likeness of two texts is the share of their paragraphs that is common,
2 * common / (both), 1 for two texts without paragraphs.

Cases: a null text is empty. Documents are ordered by id, null ids first, equal
ids by the hash of their texts. A single document is its own next one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.scratch import save

ROWS, CELLS = 5, 8
#: Digests of a block of a fingerprint, at most on average.
LOAD = 32
#: Differing digests of a block that are tried to peel.
MOST_DIFFERING = 22
#: Digests, rows and cells a row of a block of the larger sketches.
RETRY_LOAD, RETRY_ROWS, RETRY_CELLS = 8, 4, 4
#: Peeling steps of a block, those most blocks take, and larger sketches that are tried.
STEPS, FEW_STEPS, ATTEMPTS = 20, 3, 24
#: Characters of a text whose words are its pieces, and of a piece that stays whole.
SHORT_TEXT, WHOLE_PIECE = 200, 240
#: One word (character) in so many ends a piece.
WORDS_A_PIECE, CHARACTERS_A_PIECE = 8, 24
#: Documents of a slice of the order, and the greatest number of slices.
SLICE_DOCUMENTS, MOST_SLICES = 500, 65_536

# white space that has a line end or follows a mark, told at its first character
_PARAGRAPH = r"\s(?:(?<=\n)|(?<=[.!?,;:]\s)|[^\S\n]*+\n)\s*+"
_WIDE_PARAGRAPH = _PARAGRAPH + r"|(?<=[。！？；，、：])\s*+"
_BLOCK_BITS = 16  # bits of a digest's hash below this one choose its cells


# ---- texts to digests ------------------------------------------------------


def _cut(piece: str, between: str, share: int) -> str:
    """SQL: the parts of a piece, cut after the items whose hash is 0 modulo ``share``."""
    ended = f"if(pmod(xxhash64(w), {share}) = 0, concat(w, '\\n'), concat(w, '{between}'))"
    return f"split(array_join(transform(split({piece}, '{between}'), w -> {ended}), ''), '\\n')"


def paragraphs(text: str) -> Column:
    """Distinct digests of the paragraphs of the column named ``text``."""
    # texts of single bytes have no full-width marks to look for
    parts = (
        f"if(octet_length({text}) = char_length({text}), split(trim({text}), r'{_PARAGRAPH}'),"
        f" split(trim({text}), r'{_WIDE_PARAGRAPH}'))"
    )
    for between, share in ((" ", WORDS_A_PIECE), ("", CHARACTERS_A_PIECE)):
        whole = f"char_length(p) <= {WHOLE_PIECE}"
        parts = f"flatten(transform({parts}, p -> if({whole}, array(p), {_cut('p', between, share)})))"
    words = f"split({text}, r'\\s+')"
    pieces = f"if(char_length({text}) <= {SHORT_TEXT}, {words}, {parts})"
    return F.expr(
        f"array_distinct(transform(filter(transform({pieces}, p -> trim(p)), p -> p <> ''),"
        " p -> xxhash64(p)))"
    )


# ---- sketches, as SQL ------------------------------------------------------


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is evaluated once.

    An aggregate over nothing copies neither, as a transform would at every depth.
    """
    return f"aggregate(cast(array() as array<int>), {value}, (v, i) -> v, {name} -> {body})"


def _repeated(start: str, s: str, count: str, on: str, step: str, few: int, most: int) -> str:
    """``step`` on ``s`` up to ``most`` times from ``start``, while ``on``.

    Every turn of an aggregate copies its state: those after the first few are
    only gone through where they are needed.
    """
    turns = f"array(sequence(1, {few}), sequence({few + 1}, {most}))"
    return (
        f"aggregate({turns}, {start}, ({s}, some) -> if({on},"
        f" aggregate(some, {s}, ({s}, {count}) -> if({on}, {step}, {s})), {s}))"
    )


def _cell(n: str, x: str, m: str) -> str:
    return f"named_struct('n', {n}, 'x', {x}, 'm', {m})"


def _longs(values: Iterable[int]) -> str:
    return f"array({', '.join(f'{v}L' for v in values)})"


def _hits(hashed: str, rows: int, cells: int) -> str:
    """Bit set of the cells of its block that a digest is in, one in each row.

    Two rows at a time are looked up by the bits of the hash that choose their cells.
    """
    width = cells.bit_length() - 1
    found = []
    for row in range(0, rows, 2):
        some = range(row, min(row + 2, rows))
        sets = [
            sum(1 << (cells * r + (at >> width * (r - row) & cells - 1)) for r in some)
            for at in range(cells ** len(some))
        ]
        at = f"shiftright({hashed}, {width * row})" if row else hashed
        found.append(f"{_longs(sets)}[cast({at} & {len(sets) - 1}L as int)]")
    return " | ".join(found)


def _bits(rows: int, cells: int) -> str:
    """One bit for each cell of a block."""
    return _longs(1 << i for i in range(rows * cells))


def _dealt(entries: str, levels: str) -> str:
    """Entries dealt to 2**levels blocks, one bit of their hash after the other."""

    one = "cast(d.h & bit as boolean)"
    halved = f"flatten(transform(groups, g -> array(filter(g, d -> NOT {one}), filter(g, d -> {one}))))"
    bits = _longs(1 << i for i in range(_BLOCK_BITS, 63))
    return (
        f"if({levels} <= 0, array({entries}),"
        f" aggregate(slice({bits}, 1, {levels}), array({entries}), (groups, bit) -> {halved}))"
    )


def _signed(digests: str, sign: int) -> str:
    return f"transform({digests}, d -> named_struct('n', {sign}, 'x', d))"


def _hashed(entries: str, seed: str) -> str:
    return f"transform({entries}, d -> named_struct('n', d.n, 'x', d.x, 'h', xxhash64(d.x, {seed})))"


def _entries(signed: str, seed: str, rows: int, cells: int) -> str:
    """Signed digests with hash, check hash and cells."""
    entry = f"named_struct('n', d.n, 'x', d.x, 'h', h, 'm', hash(d.x), 'hits', {_hits('h', rows, cells)})"
    return f"transform({signed}, d -> {_let(f'xxhash64(d.x, {seed})', 'h', entry)})"


def _cells(entries: str, levels: str, rows: int, cells: int) -> str:
    """array<array<cell>>: the cells of each block."""
    sums = _cell(*(f"aggregate(own, {zero}, (a, d) -> a {add} d.{name})"
                   for name, zero, add in (("n", "0", "+"), ("x", "0L", "^"), ("m", "0", "^"))))
    own = f"filter(block, d -> cast(d.hits & bit as boolean))"
    each = f"transform({_bits(rows, cells)}, bit -> {_let(own, 'own', sums)})"
    return f"transform({_dealt(entries, levels)}, block -> {each})"


def _levels(expected: str, load: int) -> str:
    """Levels at which blocks expect at most ``load`` digests."""
    return f"cast(greatest(0, ceil(log2(greatest(1, {expected}) / {load}.0))) as int)"


def _added(one: str, two: str, sign: str) -> str:
    """Two blocks added or subtracted cell by cell."""
    return f"zip_with({one}, {two}, (u, v) -> {_cell(f'u.n {sign} v.n', 'u.x ^ v.x', 'u.m ^ v.m')})"


def _folded(sketched: str, times: str) -> str:
    """A sketch brought to half its blocks ``times`` times."""
    halves = "sequence(0, cast(size(t) / 2 as int) - 1)"
    half = f"transform({halves}, i -> {_added('t[2 * i]', 't[2 * i + 1]', '+')})"
    return f"if({times} <= 0, {sketched}, aggregate(sequence(1, {times}), {sketched}, (t, k) -> {half}))"


def _subtracted(one: str, two: str) -> str:
    return f"zip_with({one}, {two}, (p, q) -> {_added('p', 'q', '-')})"


_EMPTY = "c.n = 0 AND c.x = 0 AND c.m = 0"


def _placed(block: str, rows: int, cells: int) -> str:
    """The cells of a block that are not empty, each with its bit."""
    placed = "named_struct('bit', bit, 'n', c.n, 'x', c.x, 'm', c.m)"
    return f"filter(zip_with({block}, {_bits(rows, cells)}, (c, bit) -> {placed}), c -> NOT ({_EMPTY}))"


def _peeled(difference: str, seed: str, rows: int, cells: int) -> str:
    """struct<found, done>: the differing digests (x, and n = 1 or -1 for their
    side) of a subtracted sketch, and whether every cell came out empty.

    Only cells that are not empty are gone through. One with a single digest is
    empty when that is taken out; the others lose those of its digests they hold.
    """
    single = "abs(c.n) = 1 AND c.m = hash(c.x)"
    pure = f"array_distinct(transform(filter(s.cells, c -> {single}), c -> {_cell('c.n', 'c.x', 'c.m')}))"
    known = (
        "transform(pure, p -> named_struct('n', p.n, 'x', p.x, 'm', p.m, 'hits',"
        f" {_let(f'xxhash64(p.x, {seed})', 'h', _hits('h', rows, cells))}))"
    )
    taken = ", ".join(f"'{name}', aggregate(own, c.{name}, (u, p) -> u {take} p.{name})"
                      for name, take in (("n", "-"), ("x", "^"), ("m", "^")))
    own = _let("filter(known, p -> cast(p.hits & c.bit as boolean))", "own",
               f"if(size(own) = 0, c, named_struct('bit', c.bit, {taken}))")
    left = (
        f"filter(transform(filter(s.cells, c -> NOT ({single})), c -> {own}), c -> NOT ({_EMPTY}))"
    )
    more = "concat(s.found, transform(pure, p -> named_struct('x', p.x, 'n', p.n)))"
    state = "named_struct('cells', {}, 'found', {}, 'on', {})".format
    step = _let(
        pure, "pure", f"if(size(pure) = 0, {state('s.cells', 's.found', 'false')}, "
        + _let(known, "known", _let(left, "left", state("left", more, "size(left) > 0"))) + ")",
    )
    nothing = "cast(array() as array<struct<x: bigint, n: int>>)"
    start = _let(_placed("block", rows, cells), "start", state("start", nothing, "size(start) > 0"))
    steps = _repeated(start, "s", "k", "s.on", step, FEW_STEPS, STEPS)
    block = _let(steps, "s", "named_struct('found', s.found, 'done', size(s.cells) = 0)")
    return _joined(f"transform({difference}, block -> {block})")


def _joined(blocks: str) -> str:
    """What the blocks gave, as one struct<found, done>."""
    return _let(
        blocks, "blocks",
        "named_struct('found', flatten(transform(blocks, b -> b.found)),"
        " 'done', forall(blocks, b -> b.done))",
    )


def sketch(digests: str) -> Column:
    """The sketch of the digests of the column of that name, as its fingerprint holds it."""
    return F.expr(
        _cells(_entries(_signed(digests, 1), "0", ROWS, CELLS),
               _levels(f"size({digests})", LOAD), ROWS, CELLS)
    )


def fingerprint(sketched: str) -> Column:
    """A sketch as text: count, XOR and check of each cell in hexadecimal digits."""
    cell = "if(c.n = 0, '', concat_ws(':', hex(c.n), hex(c.x), right(hex(c.m), 8)))"
    return F.expr(f"array_join(transform(flatten({sketched}), c -> {cell}), '.')")


def recovered(one: tuple[str, str], two: tuple[str, str]) -> Column:
    """struct<found array<struct<x, n>>, done>: the digests that differ.

    ``one`` and ``two`` name a text's sketch and its digests. The sketches are
    compared first, which is enough where few digests differ.
    """
    (sketch1, digests1), (sketch2, digests2) = one, two
    size1, size2 = f"cast(round(log2(size({sketch1}))) as int)", f"cast(round(log2(size({sketch2}))) as int)"
    small = _subtracted(_folded(sketch1, f"({size1} - {size2})"),
                        _folded(sketch2, f"({size2} - {size1})"))
    # the squared counts of a row add up to the number of differing digests or more
    squares = "aggregate(flatten(small), 0L, (a, c) -> a + c.n * c.n)"
    hopeless = f"{squares} > {MOST_DIFFERING * ROWS} * size(small)"
    failed = "named_struct('found', cast(array() as array<struct<x: bigint, n: int>>), 'done', false)"
    first = _let(small, "small", f"if({hopeless}, {failed}, {_peeled('small', '0', ROWS, CELLS)})")
    both = f"(size({digests1}) + size({digests2}))"
    # one text's digests put in, the other's taken out, in blocks of few
    signed = f"concat({_signed(digests1, 1)}, {_signed(digests2, -1)})"
    parts = _dealt(_hashed(signed, "0"), _levels(both, RETRY_LOAD))
    again = _peeled(
        _cells(_entries("part", "attempt", RETRY_ROWS, RETRY_CELLS), "(attempt - 1)",
               RETRY_ROWS, RETRY_CELLS),
        "attempt", RETRY_ROWS, RETRY_CELLS,
    )
    tries = _repeated(failed, "got", "attempt", "NOT got.done", again, 1, ATTEMPTS)
    larger = _joined(f"transform({parts}, part -> {tries})")
    return F.expr(_let(first, "tried", f"if(tried.done, tried, {larger})"))


# ---- documents and their successors ----------------------------------------


def _slices(docs: DataFrame) -> tuple[Column, int]:
    """Number of the slice of the order of ids that a row is in, and how many.

    The bounds are quantiles of the ids, found by halving; all rows of one id
    are in one slice.
    """
    rows = docs.count()
    n = max(1, min(MOST_SLICES, rows // SLICE_DOCUMENTS))
    shares = [i / n for i in range(1, n)]
    bounds: list[int] = []
    if shares:
        told = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * n))).first()[0]
        bounds = sorted(set(told or []))
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    at = F.lit(0)
    if bounds:
        halves = [2**k for k in range(len(bounds).bit_length() - 1, -1, -1)]
        at = F.aggregate(
            F.array(*map(F.lit, halves)), F.lit(0),
            lambda low, step: F.when(
                F.coalesce(F.try_element_at(listed, low + step) <= F.col("doc_id"), F.lit(False)),
                low + step,
            ).otherwise(low),
        )
    return F.coalesce(at, F.lit(0)), len(bounds) + 1


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digests, own, next) of each document; ``own`` is its sketch,
    ``next`` has text, digests and sketch of the next one.

    Slices of the order are sorted side by side. A slice's last document goes on
    with the first of the next slice that isn't empty; of those there is one row
    for each slice. Texts are shuffled once; what follows stays in its slice.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    slice_, _ = _slices(named)
    placed = named.withColumn("slice", slice_).withColumn("hash", F.xxhash64("text"))
    first = placed.groupBy("slice").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
    by_slice = Window.orderBy("slice")
    everything = by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = save(
        first.select(
            "slice", F.coalesce(F.lead("first").over(by_slice),
                                F.first("first").over(everything)).alias("first"),
        )
    )
    # at most MOST_SLICES narrow rows
    firsts = save(
        placed.join(
            F.broadcast(following.withColumnRenamed("slice", "before")),
            placed["doc_id"].eqNullSafe(F.col("first.doc_id"))
            & (placed["hash"] == F.col("first.hash")),
        )
        .select(F.col("before").alias("slice"), "text").dropDuplicates(["slice"])
    )
    other = _sketched(firsts).select(
        "slice", F.struct("text", "digests", "own").alias("other")
    )
    order = Window.partitionBy("slice").orderBy("doc_id", "hash")
    sorted_ = _sketched(placed.repartition("slice")).withColumn(
        "next", F.lead(F.struct("text", "digests", "own")).over(order)
    )
    return sorted_.join(other, "slice", "left").select(
        "doc_id", "text", "digests", "own", F.coalesce("next", "other").alias("next")
    )


def _sketched(texts: DataFrame) -> DataFrame:
    return texts.withColumn("digests", paragraphs("text")).withColumn("own", sketch("digests"))


def edited(text: Column, following: Column) -> Column:
    """The last quarter of a text, rounded down, replaced by as much of the next."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter),
                    F.substring(following, F.lit(1), quarter))


def likeness(found: Column, one: Column, two: Column) -> Column:
    """Share of the digests that is common, from the recovered differences; NULL
    should no sketch have come out empty."""
    both = F.size(one) + F.size(two)
    return F.when(found["done"], F.when(both > 0, 1.0 - F.size(found["found"]) / both).otherwise(1.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each document (doc_id, text) its fingerprint, that of its edited text,
    and their likeness and the likeness to the next document."""
    told = (
        with_next(docs)
        .withColumn("edited", edited(F.col("text"), F.col("next.text")))
        .withColumn("edited_digests", paragraphs("edited"))
        .withColumn("changed", sketch("edited_digests"))
        .withColumn("from_edited", recovered(("own", "digests"), ("changed", "edited_digests")))
        .withColumn("from_next", recovered(("own", "digests"), ("next.own", "next.digests")))
    )
    return told.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"),
        fingerprint("changed").alias("edited_fingerprint"),
        likeness(F.col("from_edited"), F.col("digests"), F.col("edited_digests"))
        .alias("near_edited"),
        likeness(F.col("from_next"), F.col("digests"), F.col("next.digests")).alias("near_next"),
    )
