r"""Conversations as training text, with masks of the tokens that a loss counts.

A turn becomes ``<turn:ROLE>``, a line end, the text, ``</turn>`` and a line end.
Inside a role or a text each backslash and the first character of each control
string (``<turn:``, ``</turn>``; in roles also ``>``) gets a backslash before it, so
that the text alone tells turns from their content and everything comes back.

Rows are sorted by conversation and turn over the whole table, by ranges, and a
task renders what lies next to each other. Each rendering is encoded once, with
the offsets of its tokens; the spans of the wanted turns and those of the tokens
are both sorted, so a binary search finds which tokens meet which spans. A
conversation that crosses the border of two ranges, or is longer than
``PIECE_CHARS``, is rendered in pieces of whole turns; since a turn begins and
ends with marks that tokens don't cross, pieces have the ids and masks of the
whole. So a conversation with a third of all rows is spread over tasks too. Memory
follows the longest turn.

Rows of a conversation are taken by turn, then role, then text, nulls first; repeated
rows are turns of their own. A null role or text counts as empty, rows with a null
``conv_id`` are one conversation. Other columns are ignored, an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSS_ROLES = ("assistant",)
PIECE_CHARS = 1 << 18
_AT_ONCE = 1 << 19  # characters encoded together

OPEN, CLOSE = "<turn:", "</turn>"
_TURN = re.compile(
    r"<turn:((?:[^\\>]++|\\.)*+)>\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = (
    "conv_id long, position long, whole boolean, n_turns long, formatted string,"
    " token_ids array<int>, loss_tokens array<int>, loss_starts array<int>, loss_ends array<int>"
)
_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return text.replace(OPEN, "\\" + OPEN).replace(CLOSE, "\\" + CLOSE)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn and the borders of its text in it."""
    head = f"{OPEN}{escape(role).replace('>', chr(92) + '>')}>\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a rendering."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


def overlaps(tokens: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, start, end) of each part of a token inside a span.

    Both are rows of (start, end); spans are disjoint, and starts and ends ascend.
    """
    spans = spans[spans[:, 0] < spans[:, 1]]
    first = np.searchsorted(spans[:, 1], tokens[:, 0], "right")  # the first that ends later
    last = np.searchsorted(spans[:, 0], tokens[:, 1], "left")  # the first that starts behind
    met = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(tokens)), met)
    span = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met) + first[token]
    return token, np.maximum(tokens[token, 0], spans[span, 0]), np.minimum(tokens[token, 1], spans[span, 1])


def covered(text: str, starts: np.ndarray, ends: np.ndarray) -> str:
    """The characters inside the parts, each once: tokens may share a character."""
    if not len(starts):
        return ""
    before = np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])
    starts = np.maximum(starts, before)
    starts, ends = starts[starts < ends], ends[starts < ends]
    new = np.concatenate([[True], starts[1:] != ends[:-1]])
    runs = zip(starts[new], ends[np.concatenate([new[1:], [True]])])
    return "".join(text[a:b] for a, b in runs)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
    return tokenizer


class _Piece:
    def __init__(self, conv_id, position: int):
        self.conv_id, self.position = conv_id, position
        self.parts: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.size = 0
        self.whole = True

    def add(self, role: str, text: str, wanted: bool) -> None:
        rendered, start, end = render_turn(role, text)
        if wanted:
            self.spans.append((self.size + start, self.size + end))
        self.parts.append(rendered)
        self.size += len(rendered)


def _encoded(pieces: list[_Piece], path: str) -> pa.RecordBatch:
    texts = ["".join(p.parts) for p in pieces]
    rows = []
    for piece, text, found in zip(
        pieces, texts, _tokenizer(path).encode_batch(texts, add_special_tokens=False)
    ):
        tokens = np.array(found.offsets, np.int32).reshape(-1, 2)
        masks = overlaps(tokens, np.array(piece.spans, np.int32).reshape(-1, 2))
        rows.append((
            piece.conv_id, piece.position, piece.whole, len(piece.parts), text,
            np.array(found.ids, np.int32), *(m.astype(np.int32) for m in masks),
        ))
    lists = pa.list_(pa.int32())
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), lists, lists, lists, lists)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)],
        ["conv_id", "position", "whole", "n_turns", "formatted", "token_ids", "loss_tokens",
         "loss_starts", "loss_ends"],
    )


def _pieces(batches: Iterator[pa.RecordBatch], loss_roles: Sequence[str]) -> Iterator[_Piece]:
    """Renderings of the sorted rows; those at a border of the task are not known to be whole."""
    number = TaskContext.get().partitionId() << 32
    piece = None
    for batch in batches:
        columns = [batch[name].to_pylist() for name in ("conv_id", "role", "text")]
        for conv_id, role, text in zip(*columns):
            same = piece is not None and piece.conv_id == conv_id
            if same and piece.size >= PIECE_CHARS:
                piece.whole = False
            if not same or piece.size >= PIECE_CHARS:
                if piece is not None:
                    yield piece
                following, number = _Piece(conv_id, number), number + 1
                following.whole = not same and piece is not None
                piece = following
            piece.add(role or "", text or "", (role or "") in loss_roles)
    if piece is not None:
        piece.whole = False
        yield piece


def format_conversations(
    turns: DataFrame, tokenizer: str, loss_roles: Sequence[str] = LOSS_ROLES
) -> DataFrame:
    """``conv_id, turn, role, text`` to renderings with token ids and loss masks.

    ``loss_tokens`` numbers the tokens under the loss, ``loss_starts`` and
    ``loss_ends`` are what of their characters lies in the texts of ``loss_roles``.
    Pieces of a conversation follow each other by ``position``; ``whole`` marks
    conversations known to be in one piece.
    """
    roles = tuple(loss_roles)

    def render(batches):
        waiting, size = [], 0
        for piece in _pieces(batches, roles):
            waiting.append(piece)
            size += piece.size
            if size >= _AT_ONCE:
                yield _encoded(waiting, tokenizer)
                waiting, size = [], 0
        if waiting:
            yield _encoded(waiting, tokenizer)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    # The head of a text orders as the text does, and is all that border samples hold.
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(render, FORMATTED)


class _Reading:
    """What has been read of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: np.ndarray, ends: np.ndarray) -> None:
        for role, text in read_turns(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        text = unescape(covered(formatted, starts, ends))
        self.loss.update(text.encode())
        self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run of pieces of one conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)], names
        )

    reading, done = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            conv_id = batch["conv_id"][i].as_py()
            if reading is None or reading.conv_id != conv_id:
                if reading is not None:
                    done.append(reading.row())
                reading = _Reading(conv_id)
            starts, ends = (batch[c][i].values.to_numpy() for c in ("loss_starts", "loss_ends"))
            reading.add(batch["formatted"][i].as_py(), starts, ends)
        if len(done) > 1000:
            yield table(done)
            done = []
    if reading is not None:
        yield table([*done, reading.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation its turns and the text under the loss mask, as counts and digests.

    Whole conversations are read where they lie; only the pieces of others are
    brought together, in order, and read as a stream, as a digest must be.
    """
    wanted = formatted.select("conv_id", "position", "whole", "formatted", "loss_starts", "loss_ends")
    pieces = wanted.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions(
        "conv_id", "position"
    )
    parts = (wanted.where("whole"), pieces)
    one, other = (p.drop("position", "whole").mapInArrow(_digests, _READ) for p in parts)
    return one.unionByName(other)
