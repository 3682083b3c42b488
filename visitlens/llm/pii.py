"""Personal data in texts, with built-in functions only.

Regular expressions propose spans, validators (Luhn for cards, mod 97 for IBANs,
number ranges for addresses) confirm them, and words shortly before a span move
its score. The spans of the four base kinds (email, ip, card, phone) stay
whatever their score; spans of the other kinds (iban, ssn) need
``MIN_SCORE``. All offsets count code points, ends are exclusive.

A null or empty text has no spans. Spans of different kinds may overlap;
``redact`` covers their union. Columns other than the text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
MIN_SCORE = 0.6
CONTEXT_CHARS = 48
#: Characters of the pieces by which places in a text are found.
CHUNK_CHARS = 512

# The base patterns find the same leftmost matches as these plain forms:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([ -]?[0-9])+ where it has 16 digits or more
#   phone  \+[0-9][ ().0-9-]+[0-9]
# Possessive quantifiers and look-behinds only keep the time linear: a run of
# word characters without an @ is tried from its start, not from every character
# of it, and no group recurses once for each digit.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){15,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this can't hold the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail|contact|write|courriel|correo",
    "ip": "ip|address|host|server|client|login",
    "card": "card|credit|visa|mastercard|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|contact|telefon|appel",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}
AGAINST = "version|release|build|example|sample|order|invoice|isbn|serial"


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join) -> Column:
    """Each value joined with all before it, doubling the reach step by step."""

    def step(done: Column, k: Column) -> Column:
        reach = F.pow(F.lit(2), k).cast("int")
        return F.transform(
            done, lambda v, i: F.when(i >= reach, join(F.get(done, i - reach), v)).otherwise(v)
        )

    last = F.greatest(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)
    return F.aggregate(F.sequence(F.lit(0), last), values, step)


def _chunks(text: Column) -> Column:
    """A text in pieces of ``CHUNK_CHARS``, so that a place is found without
    counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))


def _stretch(chunks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end``."""
    first = F.floor(start / CHUNK_CHARS).cast("int")
    count = F.floor(end / CHUNK_CHARS).cast("int") - first + 1
    joined = F.array_join(F.slice(chunks, first + 1, count), "")
    return F.when(
        start < end, F.substring(joined, start - first * CHUNK_CHARS + 1, end - start)
    ).otherwise("")


def _found(text: Column, kind: str) -> Column:
    """array<struct<start, end, value>> of the pattern's matches.

    The gaps that ``split`` leaves and the matches themselves alternate, so
    their running lengths give the offsets.
    """
    pattern = F.lit(PATTERNS[kind])
    steps = F.zip_with(
        F.split(text, PATTERNS[kind], -1),
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda gap, value: F.struct(
            (F.char_length(gap) + F.char_length(value)).alias("length"), value.alias("value")
        ),
    )

    def placed(matched: Column) -> Column:
        lengths = F.transform(matched, lambda s: s["length"])
        return F.zip_with(
            matched, _let(lengths, lambda each: _running(each, lambda x, y: x + y)),
            lambda s, end: F.struct(
                (end - F.char_length(s["value"])).alias("start"), end.alias("end"),
                s["value"].alias("value"),
            ),
        )

    spans = _let(F.filter(steps, lambda s: s["value"].isNotNull()), placed)
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    needed = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
    return F.when(needed, spans).otherwise(nothing)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits has a right Luhn checksum."""
    values = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(
        values,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def iban_valid(value: Column) -> Column:
    """True if an IBAN's letters and digits leave 1 modulo 97."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))
    codes = F.transform(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        lambda c: F.when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48),
    )
    rest = F.aggregate(
        codes, F.lit(0), lambda done, v: (done * F.when(v > 9, 100).otherwise(10) + v) % 97
    )
    return rest == 1


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(
            parts,
            lambda p: F.regexp_like(p, F.lit("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")),
        )
    if kind == "card":
        digits = _digits(value)
        return (F.length(digits) <= 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return iban_valid(value)
    if kind == "ssn":
        return ~F.regexp_like(value, F.lit("^(000|666|9)|-00-|-0000$"))
    return F.lit(True)


def _score(chunks: Column, kind: str, start: Column) -> Column:
    """The kind's base score, moved by the words shortly before the span."""
    begin = F.greatest(start - CONTEXT_CHARS, F.lit(0))
    before = F.lower(_stretch(chunks, begin, start))
    score = (
        F.lit(BASE_SCORE[kind])
        + F.when(F.regexp_like(before, F.lit(rf"\b({CONTEXT[kind]})")), 0.4).otherwise(0.0)
        - F.when(F.regexp_like(before, F.lit(rf"\b({AGAINST})\b")), 0.3).otherwise(0.0)
    )
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3)


def _spans(text: Column, chunks: Column, kind: str) -> Column:
    """Confirmed spans of one kind in order of their starts."""
    confirmed = F.filter(_found(text, kind), lambda s: _valid(kind, s["value"]))
    scored = F.transform(
        confirmed,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            _score(chunks, kind, s["start"]).alias("score"), s["value"].alias("value"),
        ),
    )
    return scored if kind in BASE_KINDS else F.filter(scored, lambda s: s["score"] >= MIN_SCORE)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with a column ``into`` of spans, by kind and then by start.

    array<struct<kind, start, end, score, value>>, empty where nothing is found.
    A column of that name is replaced.
    """
    return _with_spans(docs, text, into).drop("__chunks")


def _with_spans(docs: DataFrame, text: str, into: str) -> DataFrame:
    whole, chunks = F.coalesce(F.col(text), F.lit("")), F.col("__chunks")
    return docs.withColumn("__chunks", _chunks(whole)).withColumn(
        into, F.concat(*(_spans(whole, chunks, kind) for kind in KINDS))
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each covered stretch of the text replaced by <KIND>.

    Where spans overlap, the one that starts first (then ends first) names the
    stretch and the union is removed. A null text stays null.
    """
    found = _with_spans(docs, text, "__pii")
    places = F.array_sort(
        F.transform("__pii", lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    chunks = F.col("__chunks")

    def cleaned(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        return _let(_let(ends, lambda each: _running(each, F.greatest)), lambda covered: marked(
            spans, covered))

    def marked(spans: Column, covered: Column) -> Column:
        # covered: up to where each span and those before it reach
        named = F.transform(
            spans,
            lambda s, i: F.struct(
                F.when(i > 0, F.get(covered, i - 1)).otherwise(0).alias("at"),
                s["start"].alias("start"), s["kind"].alias("kind"),
            ),
        )
        pieces = F.transform(
            F.filter(named, lambda s: s["start"] >= s["at"]),
            lambda s: F.concat(
                _stretch(chunks, s["at"], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")
            ),
        )
        rest = _stretch(chunks, F.element_at(covered, -1), F.char_length(F.col(text)))
        return F.concat(F.array_join(pieces, ""), rest)

    return found.withColumn(
        text, F.when(F.size("__pii") > 0, _let(places, cleaned)).otherwise(F.col(text))
    ).drop("__pii", "__chunks")
