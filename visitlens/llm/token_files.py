"""Token ids of a corpus in compressed binary files.

The ids of all documents are counted, a canonical Huffman code with codes of at
most ``huffman.LIMIT`` bits is made from the counts, and the documents are
written in ascending order of their ids. A file is a row of entries between
``SYNC`` marks:

* first ``TKH1``: number of symbols, compressed code lengths;
* then blocks ``TKB1`` of at most ``BLOCK`` ids: file number, ids before the
  block in this file, segments (document, number of ids, whether the document
  ends), bit offsets of every ``LANE``-th id, checksum, codes.

Each block is decoded by itself from the table that the lengths give, and from
any of its bit offsets. A document longer than a block goes on in the next one
of its file.

The files are written by Spark's text writer, one entry a row, so that only whole
files of successful tasks count.

Cases: a null or empty text has the end id only. Rows with equal ids are
ordered by their token ids; null ids come first. An empty table writes nothing.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm import huffman
from visitlens.llm.pieces import _blocks, ragged
from visitlens.llm.scratch import save, shared_folder

END_ID = 0
BLOCK = 1 << 18
LANE = 128
#: Ids that a file holds, about.
FILE_IDS = 8_000_000
#: Characters tokenized at once: the more, the fewer words come again in a later block.
BLOCK_CHARS = 3_000_000
SYNC = b"\xf1\x0d\xfe\xa7\x91\xc3\x5a\x0b"
#: Chunks whose ids a Python worker remembers.
REMEMBERED = 900_000
_SPACE = "\u0120"  # how the vocabulary writes a space
_HEAD = struct.Struct("<4sIIQIIII")
# Texts with a space at other white space or at an end, where there is no place to cut.
_WHITE = r"[\s\p{Z}\x{0B}\x{0C}\x{1C}-\x{1F}\x{85}]"
_ODD = rf"^ | $| {_WHITE}|{_WHITE} "
_BLANK = re.compile(r"\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


# ---- tokenizing ------------------------------------------------------------


class Encoder:
    """A byte-level BPE tokenizer that encodes each distinct word once.

    Its pattern always cuts before a single space between other characters, so
    the ids of a text are those of its words with the space before them. With
    ``added``, names of added tokens in a text are these tokens, as the library has
    it by default, and a text that holds one is encoded whole; else they are
    ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not added
        tokens = self._tokenizer.get_added_tokens_decoder().values() if added else ()
        names = [t.content for t in tokens]
        self._names = re.compile("|".join(map(re.escape, names))) if names else None
        # words in a row could make up a name with white space
        self._apart = any(_BLANK.search(n) for n in names)
        self.size = self._tokenizer.get_vocab_size()
        self._opens = np.zeros(self.size, dtype=bool)
        for token, i in self._tokenizer.get_vocab(with_added_tokens=False).items():
            self._opens[i] = token.startswith(_SPACE)
        self._words: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("i", e.ids).tobytes() for e in found]

    def _ids_of_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word with a space before it.

        Words are encoded many in a row, which costs a third less than one by one.
        Only the first id of such a word opens with a space, which tells where each
        begins. Words with white space of their own, or without anything, might not be
        cut there: they go one by one.
        """
        odd = [w for w in words if not w or self._apart or _BLANK.search(w)]
        told = dict(zip(odd, self._ids([" " + w for w in odd]), strict=True))
        plain = [w for w in words if w not in told] if odd else words
        parts = [plain[at : at + 500] for at in range(0, len(plain), 500)]
        found = self._tokenizer.encode_batch_fast(
            [" " + " ".join(part) for part in parts], add_special_tokens=False
        )
        for part, encoded in zip(parts, found, strict=True):
            ids = np.array(encoded.ids, np.int32)
            begins = np.flatnonzero(self._opens[ids])
            if len(begins) != len(part):  # another pattern than the one this relies on
                told.update(zip(part, self._ids([" " + w for w in part]), strict=True))
                continue
            cuts, raw = (4 * begins).tolist(), ids.tobytes()
            told.update(
                zip(part, (raw[b:e] for b, e in zip(cuts, [*cuts[1:], len(raw)], strict=True)))
            )
        return told

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All chunks of the texts, and where those of each text begin and how many they are."""
        odd = pc.match_substring_regex(texts, _ODD)
        if self._names:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self._names.pattern))
        odd = odd.to_numpy(zero_copy_only=False)
        flat, starts = [], np.zeros(len(texts), np.int64)
        counts, held = np.zeros(len(texts), np.int64), 0
        for mine in (~odd, odd):
            chosen = texts.filter(pa.array(mine))
            if mine is odd:
                lists = pa.array([self._cut_odd(t) for t in chosen.to_pylist()], pa.list_(pa.string()))
            else:
                lists = pc.split_pattern(chosen, " ")
            sizes = np.diff(lists.offsets.to_numpy())
            counts[mine], starts[mine] = sizes, held + np.cumsum(sizes) - sizes
            flat.append(lists.flatten().cast(pa.string()))
            held += int(sizes.sum())
        return pa.concat_arrays(flat), starts, counts

    def _cut_odd(self, text: str) -> list[str]:
        if self._names and self._names.search(text):
            return [text]
        return _CUT.split(text)

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with the end id; their numbers)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        flat, starts, counts = self._cut(pc.fill_null(texts, ""))
        first = np.zeros(len(flat), dtype=bool)
        first[starts] = True
        words = flat.filter(pa.array(~first)).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        told = self._ids_of_words([w for w in distinct if w not in self._words])
        ids = [self._words[w] if w in self._words else told[w] for w in distinct]
        if len(self._words) < REMEMBERED:  # the first words are the frequent ones
            self._words.update(told)
        # the first chunks have no space before them; the end id is a chunk too
        n = len(ids)
        ids += [*self._ids(flat.filter(pa.array(first)).to_pylist())]
        ids.append(np.array([END_ID], dtype=np.int32).tobytes())
        codes = np.empty(len(flat), dtype=np.int64)
        codes[~first] = words.indices.to_numpy()
        codes[first] = n + np.arange(first.sum())
        ends = np.cumsum(counts + 1)
        order = np.full(ends[-1] if len(ends) else 0, len(ids) - 1, dtype=np.int64)
        inner = np.ones(len(order), dtype=bool)
        inner[ends - 1] = False
        order[inner] = ragged(codes, starts, counts)
        sizes = np.array([len(b) // 4 for b in ids], dtype=np.int64)
        values = np.frombuffer(b"".join(ids), np.int32)
        out = ragged(values, (np.cumsum(sizes) - sizes)[order], sizes[order])
        upto = np.concatenate(([0], np.cumsum(sizes[order])))[np.concatenate(([0], ends))]
        return out, np.diff(upto)


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path, added=True)


@lru_cache(maxsize=1)
def _packers() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _squeeze(ids: np.ndarray) -> bytes:
    """Ids by byte planes, compressed, for the way to the sorted files."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _packers()[0].compress(planes)


def _restore(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_packers()[1].decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


_TOKENS = ["doc_id", "n_tokens", "ids"]


def _tokenize_and_count(docs: DataFrame, vocabulary: str) -> DataFrame:
    """A row for each text, and from each task one more: ``counts`` of all its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(vocabulary)
        counts = np.zeros(0, dtype=np.int64)
        for whole in batches:
            for batch in _blocks(whole, pc.utf8_length(whole.column("text")), BLOCK_CHARS):
                ids, sizes = encoder.encode(batch.column("text"))
                own = np.bincount(ids, minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
                ends = np.cumsum(sizes).tolist()
                parts = [_squeeze(ids[b:e]) for b, e in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                     pa.array(parts, pa.binary()), pa.nulls(len(parts), pa.binary())],
                    [*_TOKENS, "counts"],
                )
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([zlib.compress(counts.astype("<i8").tobytes())], pa.binary())],
            [*_TOKENS, "counts"],
        )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return named.mapInArrow(run, "doc_id long, n_tokens long, ids binary, counts binary")


def tokenize(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids) with the ids of each text, compressed."""
    return _tokenize_and_count(docs, vocabulary).where(F.col("ids").isNotNull()).select(*_TOKENS)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("counts").to_pylist():
            counts = np.frombuffer(zlib.decompress(data), "<i8")
            ids = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], ["id", "n"])


def _count_ids(counted: DataFrame) -> np.ndarray:
    """Global counts by id; there are as many as the vocabulary has ids."""
    parts = counted.where(F.col("counts").isNotNull()).select("counts")
    summed = parts.mapInArrow(_sum_counts, "id long, n long")
    rows = summed.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


# ---- writing ---------------------------------------------------------------


def file_header(lengths: np.ndarray) -> bytes:
    return b"TKH1" + struct.pack("<I", len(lengths)) + zlib.compress(lengths.tobytes(), 9)


def file_block(
    file_no: int, before: int, segments: list[tuple[int | None, int, bool]], ids: np.ndarray,
    codes: np.ndarray, lengths: np.ndarray,
) -> bytes:
    """One independent block; ``segments`` are (doc_id, number of ids, ends)."""
    packed, starts = huffman.pack(ids, codes, lengths)
    names = np.array([-1 if d is None else d for d, _, _ in segments], dtype="<i8")
    sizes = np.array([n for _, n, _ in segments], dtype="<u4")
    flags = np.array([(d is None) + 2 * e for d, _, e in segments], dtype=np.uint8)
    body = b"".join(
        (names.tobytes(), sizes.tobytes(), flags.tobytes(), starts[::LANE].astype("<u4").tobytes(),
         packed)
    )
    head = _HEAD.pack(
        b"TKB1", file_no, len(segments), before, len(ids), len(body), zlib.crc32(body), LANE
    )
    return head + body


def _write_blocks(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical_codes(lengths)
        file_no = TaskContext.get().partitionId()
        entry = lambda data: pa.RecordBatch.from_arrays(
            [pa.array([data], pa.binary())], ["entry"]
        )
        segments: list[tuple[int | None, int, bool]] = []
        parts: list[np.ndarray] = []
        held, before, begun = 0, 0, False

        def block() -> pa.RecordBatch:
            return entry(
                file_block(file_no, before, segments, np.concatenate(parts), codes, lengths)
            )

        for batch in batches:
            for doc_id, data in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True
            ):
                if not begun:
                    yield entry(file_header(lengths))
                    begun = True
                ids = _restore(data)
                while True:
                    piece = ids[: BLOCK - held]
                    ids = ids[len(piece) :]
                    segments.append((doc_id, len(piece), not len(ids)))
                    parts.append(piece)
                    held += len(piece)
                    if held == BLOCK:
                        yield block()
                        before += held
                        segments, parts, held = [], [], 0
                    if not len(ids):
                        break
        if held:
            yield block()

    return run


def write_token_files(docs: DataFrame, vocabulary: str, folder: str) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the files below ``folder``."""
    counted = save(_tokenize_and_count(docs, vocabulary))
    counts, tokens = _count_ids(counted), counted.where(F.col("ids").isNotNull())
    lengths = huffman.code_lengths(counts)
    files = max(1, -(-int(counts.sum()) // FILE_IDS))
    ordered = (
        tokens.select("doc_id", "ids").repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "ids")
    )
    entries = ordered.mapInArrow(_write_blocks(lengths), "entry binary")
    (
        entries.select(F.col("entry").cast("string").alias("value"))
        .write.option("lineSep", SYNC.decode("latin-1")).option("encoding", "ISO-8859-1")
        .text(folder)
    )


# ---- reading ---------------------------------------------------------------


def read_blocks(content: bytes) -> Iterator[tuple[int, int, list[tuple], np.ndarray]]:
    """(file number, ids before, segments, ids) of each block of a file."""
    if not content.startswith(b"TKH1"):
        raise ValueError("no token file")
    (symbols,) = struct.unpack_from("<I", content, 4)
    unpack = zlib.decompressobj()
    lengths = np.frombuffer(unpack.decompress(content[8:]), np.uint8)
    if len(lengths) != symbols:
        raise ValueError("damaged header")
    table = huffman.decoding_table(lengths)
    at = len(content) - len(unpack.unused_data) + len(SYNC)
    while at < len(content):
        magic, file_no, n, before, ids, size, crc, lane = _HEAD.unpack_from(content, at)
        at += _HEAD.size
        body = content[at : at + size]
        if magic != b"TKB1" or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        names = np.frombuffer(body, "<i8", n)
        sizes = np.frombuffer(body, "<u4", n, 8 * n)
        flags = np.frombuffer(body, np.uint8, n, 12 * n)
        lanes = -(-ids // lane)
        points = np.frombuffer(body, "<u4", lanes, 13 * n)
        values = huffman.unpack(body[13 * n + 4 * lanes :], ids, points, lane, table)
        segments = [
            (None if flag & 1 else doc, count, bool(flag & 2))
            for doc, count, flag in zip(names.tolist(), sizes.tolist(), flags.tolist(), strict=True)
        ]
        yield file_no, before, segments, values
        at += size + len(SYNC)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "file_no", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for content in batch.column("content").to_pylist():
            crc = n = 0
            for file_no, before, segments, ids in read_blocks(content):
                rows, at = [], 0
                raw = ids.astype("<u4").tobytes()
                for doc_id, count, ends in segments:
                    crc = zlib.crc32(raw[4 * at : 4 * (at + count)], crc)
                    at, n = at + count, n + count
                    if ends:
                        rows.append((doc_id, file_no, before + at - n, n, crc))
                        crc = n = 0
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names
                )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    found = save(
        files.mapInArrow(
            _describe, "doc_id long, file_no long, start long, n_tokens long, ids_crc32 long"
        )
    )
    # one row for each file
    sizes = found.groupBy("file_no").agg(F.max(F.col("start") + F.col("n_tokens")).alias("ids"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "file_no", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).cast("long").alias("offset")
    )
    return found.join(offsets, "file_no").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` written to files in the shared folder, and what those hold."""
    folder = shared_folder(docs.sparkSession)
    write_token_files(docs, vocabulary, folder)
    return read_token_files(docs.sparkSession, folder)
