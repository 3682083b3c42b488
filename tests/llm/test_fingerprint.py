import re
from hashlib import sha256

import pytest
import xxhash
from pyspark.sql import functions as F

from visitlens.llm import fingerprint, queries


def signed_hash(text):
    value = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return value - (1 << 64 if value >> 63 else 0)


def cut(piece, between, share):
    """Parts of a long piece, ended by items whose own hash says so."""
    if len(piece) <= 240:
        return [piece]
    items = piece.split(" ") if between else list(piece)
    return "".join(w + ("\n" if signed_hash(w) % share == 0 else between) for w in items).split("\n")


def paragraphs(text):
    text = text or ""
    if len(text) <= 200:
        pieces = re.split(r"\s+", text)
    else:
        marked = re.split(
            r"\s*\n\s*|(?<=[.!?,;:])\s+|(?<=[。！？；，、：])\s*", text.strip(" ")
        )
        pieces = [q for p in marked for part in cut(p, " ", 8) for q in cut(part, "", 24)]
    return {p.strip(" ") for p in pieces} - {""}


def likeness(a, b):
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def by_force(rows):
    """Rows of (doc_id, text) in order -> {doc_id: expected values}."""
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        out[doc_id] = (
            len(text), sha256(changed.encode()).hexdigest(),
            pytest.approx(likeness(paragraphs(text), paragraphs(changed))),
            pytest.approx(likeness(paragraphs(text), paragraphs(after))),
        )
    return out


def told(rows):
    return {
        r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows
    }


def test_query_against_sets_of_paragraphs(spark, sf_docs):
    rows = sorted((r.doc_id, r.text) for r in sf_docs.collect())
    frame = queries.op5_fingerprint(spark, "/root/testdata/sf0.001")
    assert told(frame.collect()) == by_force(rows)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_cases_and_slices(documents, monkeypatch):
    monkeypatch.setattr(fingerprint, "SLICE_DOCUMENTS", 2)
    long = "\n".join(f"paragraph {i}." for i in range(3000))
    rows = [(1, "a, b. c"), (5, None), (7, ""), (9, long), (12, "😀 x. é y! z"), (30, "one"),
            (31, "a, b. c"), (40, "a,  b.\n\nc. d")]
    got = fingerprint.fingerprints(documents(*reversed(rows))).collect()
    assert told(got) == by_force(rows)
    same = {r.doc_id: r.fingerprint for r in got}
    assert same[1] == same[31] and same[5] == same[7] and same[1] != same[9]


def test_single_document_and_empty_table(documents):
    (row,) = fingerprint.fingerprints(documents((3, "x. y. z. w"))).collect()
    assert row.near_next == 1.0 and row.n_chars == 10
    assert fingerprint.fingerprints(documents()).count() == 0


def test_ties_and_null_ids(documents):
    docs = documents((None, "n. m"), (2, "x. y"), (2, "x. y"), (2, "other"))
    rows = fingerprint.fingerprints(docs.withColumn("key", F.lit(1))).collect()
    assert len(rows) == 4 and sum(r.doc_id is None for r in rows) == 1


def pairs_of(spark, *rows):
    frame = spark.createDataFrame(rows, "key long, one array<long>, two array<long>")
    return frame.withColumn("a", fingerprint.sketch("one")).withColumn("b", fingerprint.sketch("two"))


PAIRS = [
    (1, list(range(100)), list(range(50, 150))), (2, [1, 2], [1, 2]), (3, [], list(range(300))),
    (4, [], []), (5, list(range(5000)), list(range(4, 5004))), (6, [5, 6, 7], [7, 8]),
]


@pytest.mark.parametrize("hopeless", [22, 0])
def test_recovers_the_digests(spark, monkeypatch, hopeless):
    """From the sketches themselves, and from larger ones alone."""
    monkeypatch.setattr(fingerprint, "MOST_DIFFERING", hopeless)
    got = pairs_of(spark, *PAIRS).select(
        "key", fingerprint.recovered(("a", "one"), ("b", "two")).alias("r")
    )
    found = {row.key: (row.r.done, sorted((f.x, f.n) for f in row.r.found)) for row in got.collect()}
    assert found == {
        key: (True, sorted([(x, 1) for x in set(one) - set(two)]
                           + [(x, -1) for x in set(two) - set(one)]))
        for key, one, two in PAIRS
    }


def test_few_differences_are_read_from_the_sketches_alone(spark):
    """Without the digests, so that nothing larger can be tried."""
    none = F.expr("cast(array() as array<bigint>)")
    frame = pairs_of(spark, PAIRS[4], PAIRS[5]).withColumn("one", none).withColumn("two", none)
    got = frame.select(fingerprint.recovered(("a", "one"), ("b", "two")).alias("r")).collect()
    assert [(r.r.done, len(r.r.found)) for r in got] == [(True, 8), (True, 3)]


def test_small_sketches_are_tried_again_larger(spark, monkeypatch):
    """Far too few cells at first: every digest is still recovered in the end."""
    monkeypatch.setattr(fingerprint, "LOAD", 3000)
    monkeypatch.setattr(fingerprint, "RETRY_LOAD", 200)
    got = pairs_of(spark, *PAIRS).select(
        "key", fingerprint.recovered(("a", "one"), ("b", "two")).alias("r")
    )
    assert {r.key: (r.r.done, len(r.r.found)) for r in got.collect()} == {
        1: (True, 100), 2: (True, 0), 3: (True, 300), 4: (True, 0), 5: (True, 8), 6: (True, 3)
    }


def test_edits_change_few_pieces_of_texts_without_marks(documents):
    spaced = " ".join(f"word{i * 7919 % 1013}" for i in range(400))
    unspaced = "".join(chr(0x4E00 + i * 7919 % 1999) for i in range(900))
    rows = [(1, spaced), (2, unspaced), (3, "six words and not one mark")]
    got = fingerprint.fingerprints(documents(*rows)).collect()
    assert told(got) == by_force(rows)
    assert all(r.near_edited >= 0.5 for r in got)


def test_texts_are_shuffled_once(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(fingerprint, "SLICE_DOCUMENTS", 50)
    plan = fingerprint.fingerprints(sf_docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == plan.count("Exchange hash") == 1


def test_values_are_bound_without_copies(spark, sf_docs):
    """A transform of one value copies what it returns, again at every depth, and an
    aggregate its state in every turn: together more time than the budget leaves."""
    plan = fingerprint.fingerprints(sf_docs)._jdf.queryExecution().executedPlan().toString()
    assert "transform(array(" not in plan
    assert fingerprint._repeated("0", "s", "k", "s < 3", "s + 1", 2, 20).count("aggregate(") == 2


@pytest.mark.parametrize(("few", "most", "reached"), [(2, 20, 7), (7, 20, 7), (2, 5, 5), (1, 3, 3)])
def test_steps_go_on_while_needed(spark, few, most, reached):
    steps = F.expr(fingerprint._repeated("0", "s", "k", "s < 7", "s + 1", few, most))
    assert spark.range(1).select(steps).first()[0] == reached


def test_line_ends_and_marks_in_odd_white_space(documents):
    items = ["a", ". ", "\n", " ", "\t\n ", "b,", "。", " \n\n", "c! \t", "！ ", ";\n", "\r\n", "d", ": : ", "、"]
    texts = ["".join(items[(i * k + i // 3) % len(items)] for i in range(400)) for k in (1, 2, 4, 7, 11)]
    plain = "".join(c for c in texts[0] if ord(c) < 128) * 2
    rows = list(enumerate([*texts, plain], 1))
    assert told(fingerprint.fingerprints(documents(*rows)).collect()) == by_force(rows)
