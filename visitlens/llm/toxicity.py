"""Toxicity of texts by a weighted finite-state grammar over clauses.

A word is read as a class: an insult, a threat, a person addressed (target), a
negation, a reporting verb, or any other word. Transducers rewrite a clause of
such classes: *threat* needs a person shortly after a threatening verb, *target*
tells insults shortly after a person from plain ones, *negation* weakens what
follows it closely, and *reported speech* weakens what follows a reporting verb.
Their composition emits matched clauses of five kinds (``KINDS``); an insult's
strength is multiplied by the weights of the arcs that its clause takes.

Insults are learned: words that labelled toxic documents hold significantly more
often than other documents, with the log ratio of the two rates as their
strength, and beginnings of several such words, as stems with many endings are. The score is a
logistic function of the clauses' weights, divided by the log of the text's length:
their sum, and a correction of the arcs' weights by kind that only much evidence
moves, all fitted on the same rows. Without labels of both kinds the small lists below and fixed coefficients
remain.

Cases: a null or empty text has no clause and a low score, as has every text
without a matched clause. Null labels are not learned from; of repeated labels
the highest counts. No other column than id and text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, log, log1p, pi

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.scratch import save
from visitlens.llm.transducer import Scorer, Transducer, compose

#: Labelled rows that are learned from at most; a row's hash chooses.
TRAINING_ROWS = 20_000
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Words of documents that an entry stands for, at least.
LEAST_WORDS = 3
#: Least log ratio of the rates in toxic and other documents.
LEAST_STRENGTH = 1.5
THRESHOLD = 0.3
#: Penalties of ``features`` in the fit; the kinds' own terms only correct the arcs.
RIDGE = (0.05, 0.05, 20.0, 20.0, 20.0, 20.0, 20.0)
#: Coefficients of ``features`` without labels.
COEFFICIENTS = (-4.3, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0)

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "ITPNRo"
#: Matched clauses: a plain and an aimed insult, a threat, one denied, one told of.
KINDS = PLAIN_INSULT, AIMED_INSULT, THREATENING, DENIED, TOLD = tuple("xatnr")
ALPHABET = [INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER]

# Everyday words of the four languages.
WORDS = {
    INSULT: "idiot idiots moron morons imbecile bastard bastards scumbag "
    "arschloch vollidiot dummkopf connard salaud abruti gilipollas imbécil",
    THREAT: "kill murder hurt destroy beat stab shoot töten umbringen schlagen "
    "tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours they them he she him her du dich dir ihr euch sie "
    "tu te toi vous ils elle tú ti usted ustedes ellos",
    NEGATION: "not never no don't isn't aren't nicht kein keine nie pas jamais "
    "aucun nunca jamás tampoco",
    REPORT: "said says claimed called quoted wrote reported sagte sagt schrieb "
    "behauptete dit écrit déclaré dijo dice escribió",
}
#: What each transducer multiplies a clause by.
PLAIN, AIMED, THREATENED = 1.0, 1.3, 1.0
NEGATED, REPORTED = 0.2, 0.4
REACH = 2  # other words between two parts of a pattern
SURE = 4.0  # strength of a listed word

_WORD = r"\p{L}[\p{L}\p{M}]*(?:['’]\p{L}[\p{L}\p{M}]*)*"
_TOKEN = regex.compile(_WORD + r"|[.!?;:\n]")
_BREAKS = frozenset(".!?;:\n")


# ---- the grammar -----------------------------------------------------------


def _within_reach(machine: Transducer) -> list[int]:
    """A chain of states that lets ``REACH`` other words pass, then falls back."""
    chain = [machine.state() for _ in range(REACH + 1)]
    for here, after in zip(chain, [*chain[1:], 0], strict=True):
        machine.otherwise[here] = after
    return chain


def _threat() -> Transducer:
    """A threatening verb with a target shortly after it is a threat."""
    machine = Transducer(otherwise={0: 0})
    chain = _within_reach(machine)
    for here in [0, *chain]:
        machine.arc(here, THREAT, THREAT, 1.0, chain[0])
    for here in chain:
        machine.arc(here, TARGET, THREATENING, THREATENED, 0)
        # a negation or report in between is passed on and keeps the reach
        for kept in (NEGATION, REPORT):
            machine.arc(here, kept, kept, 1.0, here)
    return machine


def _target() -> Transducer:
    """An insult weighs ``PLAIN``, shortly after a target ``AIMED``."""
    machine = Transducer(otherwise={0: 0})
    machine.arc(0, INSULT, PLAIN_INSULT, PLAIN, 0)
    chain = _within_reach(machine)
    for here in [0, *chain]:
        machine.arc(here, TARGET, TARGET, 1.0, chain[0])
    for here in chain:
        machine.arc(here, INSULT, AIMED_INSULT, AIMED, 0)
        # a negation or report in between stays visible and keeps the reach
        for kept in (NEGATION, REPORT):
            machine.arc(here, kept, kept, 1.0, here)
    return machine


def _negation() -> Transducer:
    """What closely follows a negation is denied and weighs less."""
    machine = Transducer(otherwise={0: 0})
    chain = _within_reach(machine)
    for here in [0, *chain]:
        machine.arc(here, NEGATION, NEGATION, 1.0, chain[0])
    for here in chain:
        for kind in (PLAIN_INSULT, AIMED_INSULT, THREATENING):
            machine.arc(here, kind, DENIED, NEGATED, 0)
        for kept in (TARGET, THREAT):
            machine.arc(here, kept, kept, 1.0, here)
    return machine


def _reported() -> Transducer:
    """What follows a reporting verb in its clause is told of and weighs less."""
    machine = Transducer(otherwise={0: 0})
    inside = machine.state()
    machine.otherwise[inside] = inside
    machine.arc(0, REPORT, REPORT, 1.0, inside)
    for kind in (PLAIN_INSULT, AIMED_INSULT, THREATENING):
        machine.arc(inside, kind, TOLD, REPORTED, inside)
    machine.arc(inside, DENIED, DENIED, REPORTED, inside)
    return machine


@lru_cache(maxsize=1)
def grammar() -> Scorer:
    machine = _threat()
    for later in (_target(), _negation(), _reported()):
        machine = compose(machine, later, [*ALPHABET, *KINDS])
    return Scorer(machine, "".join(KINDS), ALPHABET)


# ---- learning the insults --------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    """Every fourth document by the checksum of its id is kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _words(docs: DataFrame) -> DataFrame:
    """(toxic, entry): each distinct word of a document once, as the reader cuts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [w for w in set(_TOKEN.findall((text or "").lower())) if len(w) > 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic] * len(words), pa.int32()), pa.array(words, pa.string())],
                    ["toxic", "entry"],
                )

    return docs.select(F.col("toxic").cast("int"), "text").mapInArrow(run, "toxic int, entry string")


def _surprise(toxic: Column, n: Column, share: float) -> Column:
    """-log of the chance that, at this share of words in toxic documents, so many of an
    entry's ``n`` words are in toxic ones (the largest term of the tail, by Stirling)."""
    clean = n - toxic
    both = (
        toxic * F.log(toxic / (n * share)) + clean * F.log(clean / (n * (1 - share)))
        + F.log(2 * pi * toxic * clean / n) / 2
    )
    return F.when(toxic <= n * share, 0.0).when(clean == 0, -toxic * log(share)).otherwise(both)


def _strength(toxic: Column, n: Column, in_toxic: int, in_all: int) -> Column:
    """Log ratio of an entry's rates in toxic and other documents."""
    return F.log((toxic + 0.5) / float(in_toxic)) - F.log(
        (n - toxic + 0.5) / float(in_all - in_toxic)
    )


def _entries(words: DataFrame, in_toxic: int, in_all: int) -> DataFrame:
    """(entry, toxic, n, strength) of words and, with a *, of their beginnings.

    Of a beginning, the words but the one that speaks most for it must be toxic as
    well, so that one word alone never marks others that begin alike.
    """
    longer = F.filter(F.array(*map(F.lit, PREFIXES)), lambda n: n < F.char_length("entry"))
    stems = F.transform(longer, lambda n: F.concat(F.col("entry").substr(F.lit(1), n), F.lit("*")))
    begun = words.select("toxic", "n", F.explode(stems).alias("entry")).groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n"),
        F.max(F.struct("toxic", (-F.col("n")).alias("less"))).alias("most"),
    )
    others, all_others = F.col("toxic") - F.col("most.toxic"), F.col("n") + F.col("most.less")
    begun = begun.where(others >= LEAST_WORDS).where(
        _strength(others, all_others, in_toxic, in_all) >= LEAST_STRENGTH
    )
    both = words.select("entry", "toxic", "n").union(begun.select("entry", "toxic", "n"))
    return both.where(F.col("n") >= LEAST_WORDS).withColumn(
        "strength", _strength(F.col("toxic"), F.col("n"), in_toxic, in_all)
    )


def _without_shorter(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Entries without the beginnings that a longer beginning says as much as."""
    covered: dict[str, int] = {}
    for entry, (toxic, _) in found.items():
        if entry.endswith("*"):
            for n in range(PREFIXES[0], len(entry) - 1):
                stem = entry[:n] + "*"
                covered[stem] = max(covered.get(stem, 0), toxic)
    return {e: strength for e, (toxic, strength) in found.items() if covered.get(e, -1) < toxic}


def _fit(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w - np.linalg.solve(hessian, gradient)
    return w


def features(sums: list[float], words: int) -> tuple[float, ...]:
    """What the score is fitted on: the clauses' weights in a text of this length,
    together and by kind. Without a clause only the constant is left."""
    scale = 1 / log1p(words + 1)
    return (1.0, sum(sums) * scale, *(s * scale for s in sums))


@dataclass(frozen=True)
class Model:
    """Strengths of learned words and beginnings (with *), and the coefficients."""

    lexicon: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = COEFFICIENTS


def training_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, toxic 0/1) of at most ``rows`` labels that aren't held out.

    The hash of the id chooses, so every label has the same chance. The chosen
    ids have a known greatest number, which is why they may be broadcast.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Learn the insults and the coefficients from at most ``rows`` labelled rows.

    What comes to the driver is bounded by ``rows``: their features, and the entries
    that are significant in them.
    """
    known = save(training_sample(docs, labels, rows))
    words = save(
        _words(known).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    )
    totals = words.agg(F.sum("toxic"), F.sum("n")).first()
    in_toxic, in_all = totals[0] or 0, totals[1] or 0
    if not 0 < in_toxic < in_all:
        return Model()
    candidates = save(_entries(words, in_toxic, in_all))
    bound = log(candidates.count() + 1) + 3
    found = (
        candidates.where(F.col("strength") >= LEAST_STRENGTH)
        .where(_surprise(F.col("toxic"), F.col("n"), in_toxic / in_all) > bound)
        .orderBy("entry").collect()
    )
    lexicon = _without_shorter({r["entry"]: (r["toxic"], r["strength"]) for r in found})
    rows_seen = sorted(_weigh(known, Model(lexicon), "toxic").collect())  # reruns agree
    x = np.array([features(r["sums"], r["words"]) for r in rows_seen])
    y = np.array([float(r["toxic"]) for r in rows_seen])
    return Model(lexicon, tuple(_fit(x, y, np.array(RIDGE)).tolist()))


# ---- scoring ---------------------------------------------------------------


class Reader:
    """Words to classes, and texts to weights and scores."""

    def __init__(self, model: Model):
        self._coefficients = model.coefficients
        self._words = {w: (c, SURE) for c, words in WORDS.items() for w in words.split()}
        self._begin = {}
        for entry, strength in model.lexicon.items():
            if entry.endswith("*"):
                self._begin[entry[:-1]] = (INSULT, strength)
            elif self._words.get(entry, (INSULT,))[0] == INSULT:
                self._words[entry] = (INSULT, strength)
        self._lengths = sorted({len(b) for b in self._begin}, reverse=True)
        self._seen: dict[str, tuple[str, float]] = {}

    def read(self, word: str) -> tuple[str, float]:
        """Class and strength of a lower-case word; its longest entry counts."""
        found = self._seen.get(word)
        if found is None:
            begun = (self._begin.get(word[:n]) for n in self._lengths if len(word) > n)
            found = self._words.get(word) or next(filter(None, begun), (OTHER, 0.0))
            if len(self._seen) > 300_000:
                self._seen.clear()
            self._seen[word] = found
        return found

    def sums(self, text: str | None) -> tuple[list[float], int]:
        """Weights of a text's matched clauses by kind, and its number of words."""
        sums, words, marked = [0.0] * len(KINDS), 0, False
        clause: list[tuple[str, float]] = []
        for token in [*_TOKEN.findall((text or "").lower()), "\n"]:
            if token in _BREAKS:
                if marked:
                    grammar().add(clause, sums)
                words += len(clause)
                clause, marked = [], False
            else:
                symbol = self.read(token)
                marked = marked or symbol[0] in (INSULT, THREAT)
                clause.append(symbol)
        return sums, words

    def weigh(self, text: str | None) -> tuple[float, int]:
        """Summed weights of a text's clauses, and its number of words."""
        sums, words = self.sums(text)
        return sum(sums), words

    def score(self, text: str | None) -> float:
        given = features(*self.sums(text))
        z = sum(c * x for c, x in zip(self._coefficients, given, strict=True))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def _weigh(docs: DataFrame, model: Model, label: str) -> DataFrame:
    """(label, sums, words) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            read = [reader.sums(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(label), pa.array([s for s, _ in read], pa.list_(pa.float64())),
                 pa.array([n for _, n in read], pa.int64())],
                [label, "sums", "words"],
            )

    return docs.select(label, "text").mapInArrow(run, f"{label} int, sums array<double>, words long")


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            scores = [reader.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double"
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more."""
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([reader.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, schema)
