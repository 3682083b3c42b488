"""Chat formatting: round trips, masks against plain Python, pieces against wholes."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens.llm import chat_format
from visitlens.llm.chat_format import covered, escape, overlaps, read_turns, render_turn, unescape
from visitlens.llm.queries import BYTE_VOCABULARY

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", "\\", "<turn:", "</turn>", "\\<turn:user>\n", "</turn>\n<turn:assistant>\nx", "\\\\</turn>",
       "<|endoftext|>", "中文。", "é\u0301👩‍👩‍👧", " \n\n ", ">", "a\\>"]
odd_text = st.lists(st.sampled_from([*ODD, "a", " ", "\n", "<", ":"]), max_size=8).map("".join)


@given(st.lists(st.tuples(odd_text, odd_text), max_size=6))
@settings(max_examples=300, deadline=None)
def test_renderings_read_back(turns):
    assert all(unescape(escape(text)) == text for pair in turns for text in pair)
    rendered = "".join(render_turn(*turn)[0] for turn in turns)
    assert read_turns(rendered) == turns


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text_reads_back(text):
    rendered, start, end = render_turn(text, text)
    assert read_turns(rendered) == [(text, text)] and unescape(rendered[start:end]) == text


@given(st.lists(odd_text, min_size=1, max_size=5), st.lists(odd_text, min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_pieces_have_the_tokens_of_the_whole(one, other):
    encode = chat_format._tokenizer(BYTE_VOCABULARY).encode
    left, right = ("".join(render_turn("user", t)[0] for t in texts) for texts in (one, other))
    assert encode(left + right).ids == encode(left).ids + encode(right).ids


def test_overlaps_against_all_pairs():
    draw = np.random.default_rng(4)
    for _ in range(200):
        tokens = np.sort(draw.integers(0, 30, (draw.integers(0, 12), 2)), axis=1)
        tokens = tokens[np.lexsort((tokens[:, 1], tokens[:, 0]))]
        tokens[:, 1] = np.maximum.accumulate(tokens[:, 1])
        spans = np.unique(draw.integers(0, 30, 8))
        spans = spans[: len(spans) // 2 * 2].reshape(-1, 2)
        expected = [
            (i, max(a, s), min(b, e)) for i, (a, b) in enumerate(tokens) for s, e in spans
            if a < e and s < b and s < e
        ]
        assert list(zip(*overlaps(tokens, spans))) == expected
        inside = sorted({c for _, a, b in expected for c in range(a, b)})
        text = "abcdefghijklmnopqrstuvwxyz0123"
        parts = [(a, b) for _, a, b in expected if a < b]
        if parts:
            assert covered(text, *np.array(parts).T) == "".join(text[c] for c in inside)


def brute(rows):
    by_conversation = {}
    first = lambda v: (v is not None, v)
    for conv, turn, role, text in rows:
        by_conversation.setdefault(conv, []).append((first(turn), first(role), first(text), role or "", text or ""))
    out = {}
    for conv, turns in by_conversation.items():
        turns = [t[3:] for t in sorted(turns, key=lambda t: t[:3])]
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[conv] = (
            len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), sum(len(render_turn(*t)[0]) for t in turns),
        )
    return out


def read(spark, rows, **columns):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(columns)
    formatted = chat_format.format_conversations(frame, BYTE_VOCABULARY)
    found = chat_format.read_back(formatted).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r)[1:] for r in found}


def conversations(n):
    draw = np.random.default_rng(n)
    return [
        (c, t, ("system", "user", "assistant", "assistant")[draw.integers(4)],
         "".join(draw.choice([*ODD, " word", "\n"], draw.integers(0, 9))))
        for c in range(n) for t in range(draw.integers(1, 9))
    ]


def test_against_python(spark):
    rows = conversations(60)
    assert read(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "a"), (None, 0, "assistant", "b"), (1, None, "assistant", "last"),
        (1, 2, None, None), (1, 2, "assistant", None), (1, 2, "assistant", "x"), (1, 2, "assistant", "x"),
        (2, 0, "assistant", ""), (3, 0, "a>b\\\n<turn:", "</turn>"), (-7, 0, "assistant", "\\### A </turn>"),
        (4, 0, "assistant", "long " * 300_000), (5, 0, "user", "長" * 50_000),
    ]
    extra = {"position": F.lit("p"), "whole": F.lit(1), "formatted": F.lit("f")}
    assert read(spark, rows, **extra) == brute(rows)
    assert read(spark, []) == {}


def test_one_conversation_over_many_tasks(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"turn {t} \\ </turn> " * 5) for t in range(3000)]
    rows += [(c, 0, "assistant", f"c{c}") for c in range(40)]
    conf, before = "spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(conf, "false")  # else the small ranges are joined
    try:
        frame = spark.createDataFrame(rows, SCHEMA)
        formatted = chat_format.format_conversations(frame, BYTE_VOCABULARY)
        pieces = formatted.where("conv_id = 7").withColumn("task", F.expr("position >> 32"))
        assert pieces.select("task").distinct().count() > 1
        assert read(spark, rows) == brute(rows)
    finally:
        spark.conf.set(conf, before)


@pytest.mark.parametrize("limit", [1, 40, 1 << 18])
def test_pieces_by_size(spark, limit, monkeypatch):
    """Read by the same code that wrote, in one process: sizes are set there."""
    monkeypatch.setattr(chat_format, "PIECE_CHARS", limit)
    monkeypatch.setattr(chat_format.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda s: 3})())
    import pyarrow as pa

    rows = sorted(conversations(30), key=lambda r: r[:2])
    batch = pa.RecordBatch.from_pydict(
        {n: [r[i] for r in rows] for n, i in (("conv_id", 0), ("role", 2), ("text", 3))}
    )
    pieces = list(chat_format._pieces(iter([batch]), ("assistant",)))
    if limit == 1:
        assert len(pieces) == len(rows)
    encoded = chat_format._encoded(pieces, BYTE_VOCABULARY)
    table = pa.Table.from_batches(list(chat_format._digests(iter([encoded]))))
    assert {r["conv_id"]: tuple(r.values())[1:] for r in table.to_pylist()} == brute(rows)
    whole = {p.conv_id for p in pieces if p.whole}
    assert all(sum(p.conv_id == c for p in pieces) == 1 for c in whole)
    assert limit == 1 or len(whole) > 5


def test_ids_decode_to_the_rendering(spark):
    rows = conversations(20)
    got = chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA), BYTE_VOCABULARY).collect()
    decode = chat_format._tokenizer(BYTE_VOCABULARY).decode
    for row in got:
        assert decode(row["token_ids"], skip_special_tokens=False) == row["formatted"]
        assert row["loss_tokens"] == sorted(row["loss_tokens"])
