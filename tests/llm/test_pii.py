import re
import time
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from visitlens.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in double) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


TEXTS = [
    None, "", "no data", "a@b.c%d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "9" * 3000, "x" * 50_000 + "@y.z",
    "+1 (555) 123-4567) ok +12", "😀😀 foo@bar.com 😀 x@y.zz", "1 " * 3000,
    "a.b-c@d-.e..f g@h.i.j-", "+49 30 1234567 +49 30 1234567", "4111111111111111@mail.example.com",
    "é é 192.168.0.1\n192.168.0.256",
]


def test_base_spans_match_the_plain_patterns(spark, documents, sf_docs):
    docs = documents(*enumerate(TEXTS)).select("doc_id", "text").union(
        sf_docs.select(F.col("doc_id") + 1000, "text")
    )
    for row in pii.find_pii(docs).collect():
        found = [(s.kind, s.start, s.end) for s in row.pii if s.kind in PLAIN]
        assert found == base_spans(row.text)
        assert all(row.text[s.start : s.end] == s.value for s in row.pii)


def test_query_counts_and_digest(spark, sf_docs):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    rows = queries.op2_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = base_spans(texts[row.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == sha256(joined.encode()).hexdigest()
        assert row.spans.startswith(joined)
        assert row.n_email == sum(k == "email" for k, _, _ in spans)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("IBAN GB82 WEST 1234 5698 7654 32.", ["iban"]),
        ("IBAN GB82 WEST 1234 5698 7654 33.", []),
        ("my ssn 123-45-6789", ["ssn"]),
        ("the number 123-45-6789", []),
        ("social security 000-45-6789", []),
    ],
)
def test_validators_and_context(documents, text, kinds):
    (row,) = pii.find_pii(documents((1, text))).collect()
    assert [s.kind for s in row.pii] == kinds


def test_context_moves_the_score(documents):
    rows = pii.find_pii(
        documents((1, "server 10.0.0.1"), (2, "x 10.0.0.1"), (3, "version 10.0.0.1"))
    ).orderBy("doc_id").collect()
    assert [r.pii[0].score for r in rows] == [1.0, 0.6, 0.3]


def test_redaction_covers_overlaps(documents):
    rows = pii.redact(
        documents((1, "call +49 30 1234567 or a@b.cd."), (2, None), (3, ""),
                  (4, "4111111111111111@mail.example.com"))
    ).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["call <PHONE> or <EMAIL>.", None, "", "<CARD>"] or [
        r.text for r in rows
    ] == ["call <PHONE> or <EMAIL>.", None, "", "<EMAIL>"]
    assert rows[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_empty_table_and_clashing_column(documents):
    docs = documents().withColumn("pii", F.lit(1))
    assert pii.find_pii(docs).count() == 0
    assert pii.redact(docs).columns == docs.columns
    plan = pii.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def redacted_by_force(text, spans):
    """Stretches one after the other, named by the span that starts first."""
    out, at = "", 0
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_redaction_of_whole_texts(spark, documents, sf_docs):
    texts = [t for t in TEXTS if t]
    texts += [(f"😀 a{i}@b.cd, " * 90 + "x" * i + " 10.0.0.1 ") * 3 for i in (0, 511, 512, 513)]
    docs = documents(*enumerate(texts)).select("doc_id", "text").union(
        sf_docs.select(F.col("doc_id") + 1000, "text")
    )
    found = {r.doc_id: (r.text, r.pii) for r in pii.find_pii(docs).collect()}
    for row in pii.redact(docs).collect():
        assert row.text == redacted_by_force(*found[row.doc_id])


def test_context_is_read_over_chunk_borders(documents):
    texts = [" " * n + "server 10.0.0.1" for n in (500, 503, 505, 509, 512, 1020)]
    rows = pii.find_pii(documents(*enumerate(texts))).collect()
    assert [[s.score for s in r.pii] for r in rows] == [[1.0]] * len(texts)


def test_time_grows_with_the_spans(documents):
    """16,000 addresses in one text; a square in their number takes a minute."""
    docs = documents((1, "".join(f"write to user{i}@mail.example.com " for i in range(16_000))))
    for work in (pii.find_pii, pii.redact):
        work(documents((1, "a@b.cd"))).collect()
        began = time.monotonic()
        work(docs).collect()
        assert time.monotonic() - began < 12
