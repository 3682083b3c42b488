"""SentencePiece encoding and decoding of whole texts, batched in numpy.

The distinct words of a batch are grouped by length; words of one length advance
together, one character at a time. Hashes of all substrings that end there probe
the sorted hashes of the pieces, and for each word the best last piece is kept as
a backpointer (Viterbi).

The path weight is that of the model's kind. The public model is a BPE model:
there a path counts 0 if each piece is what merging its own characters gives and
each two neighbours stay apart when their characters are merged together, and
minus infinity otherwise. Exactly one path counts 0, the model's own encoding; a
sum of piece scores would find another one. Unigram models use the sum.

Pieces never hold a space mark after another character, nor a line end, so texts
are cut there first; a word longer than ``LONG`` characters, or with several
space marks, is merged pair by pair. Characters without a piece become bytes.

Cases: a null or empty text has no ids and decodes to an empty text. Decoding
gives back every text, except that U+2581, the model's space mark, becomes a
space.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.shingles import mixed

MARK = "▁"
LONG = 48
BLOCK_CHARS = 3_000_000  # encoded at once: longer batches advance more words together
#: Words whose ids, and pairs of pieces whose verdict a Python worker remembers.
REMEMBERED = 500_000
PAIR_BITS = 21
_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_START, _UNKNOWN, _NONE = -1, -2, -3
_TOP = np.uint64(44)


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated stretches values[start : start + size]."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    return values[at + np.repeat(starts - (ends - sizes), sizes)]


def numbered(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """(number of each word, the distinct words in the order of their numbers)."""
    number = defaultdict(count().__next__)
    codes = np.fromiter((number[w] for w in words), dtype=np.int64, count=len(words))
    return codes, list(number)


def _hash(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of (n, length) code points, and the inverse powers."""
    length = chars.shape[1]
    up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(length, _BASE)])
    down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(length, _INVERSE)])
    sums = np.zeros((len(chars), length + 1), dtype=np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[:-1], axis=1, out=sums[:, 1:])
    return sums, down


def _code_points(words: list[str], length: int) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(-1, length)


class PieceTexts:
    """What each piece of a SentencePiece model stands for: all that decoding needs."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path, model_proto=proto)
        self._read(model)

    def _read(self, model) -> None:
        texts = []
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                texts.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(b"")
            else:
                text = model.id_to_piece(i).replace(MARK, " ")
                texts.append(text.encode("utf-8", "surrogatepass"))
        self._text_sizes = np.array([len(t) for t in texts])
        self._text_starts = np.cumsum(self._text_sizes) - self._text_sizes
        self._text_bytes = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts whose ids lie in a row, ``sizes`` of them each."""
        lengths = self._text_sizes[ids]
        raw = ragged(self._text_bytes, self._text_starts[ids], lengths).tobytes()
        upto = np.concatenate(([0], np.cumsum(lengths)))
        ends = upto[np.cumsum(sizes)].tolist()
        begins = [0, *ends[:-1]]
        # the first space only marks the start of a text
        return [
            raw[b:e].decode("utf-8", "replace")[1:] for b, e in zip(begins, ends, strict=True)
        ]


class PieceModel(PieceTexts):
    """Pieces of a SentencePiece model and the batched search over them."""

    def __init__(self, path: str | None = None, proto: bytes | None = None, bpe: bool = True):
        self.bpe = bpe
        super().__init__(path, proto)

    def _read(self, model) -> None:
        super()._read(model)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.scores = np.array([model.get_score(i) for i in range(n)])
        self._byte = np.full(256, -1, dtype=np.int32)
        self._unknown = model.unk_id()
        self.ids: dict[str, int] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self._byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self._unknown_score = self.scores[list(self.ids.values())].min() - 10.0
        self._sort_pieces()
        # a pair has one place in the table, and a later one of that place takes it over
        self._pairs = np.full(1 << PAIR_BITS, -1, dtype=np.int64)
        self._apart = np.zeros(1 << PAIR_BITS, dtype=bool)
        self._words: dict[str, bytes] = {}

    def _sort_pieces(self) -> None:
        by_length = defaultdict(list)
        for piece in self.ids:
            by_length[len(piece)].append(piece)
        keys, ids = [], []
        for length, pieces in by_length.items():
            sums, _ = _hash(_code_points(pieces, length))
            keys.append(mixed(sums[:, length] + np.uint64(length)))
            ids += [self.ids[p] for p in pieces]
        self.longest = max(by_length)
        joined = np.concatenate(keys)
        order = np.argsort(joined)
        self._keys, self._key_ids = joined[order], np.array(ids, dtype=np.int64)[order]
        self._some = np.zeros(1 << 20, dtype=bool)  # leading bits that a key has
        self._some[joined >> _TOP] = True
        self._whole = np.ones(len(self.pieces), dtype=bool)
        if self.bpe:
            for piece, i in self.ids.items():
                self._whole[i] = self.merge(piece) == [i]

    # ---- pair merging: single words ------------------------------------

    def merge(self, word: str) -> list[int]:
        """BPE of one word: merge the best pair, the leftmost of equals, until none."""
        parts: list[str | None] = list(word)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                joined = parts[i] + parts[j]
                piece = self.ids.get(joined)
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], i, j, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        out: list[int] = []
        for part in parts:
            if part is not None:
                piece = self.ids.get(part)
                out += [piece] if piece is not None else self._bytes_of(part)
        return out

    def _bytes_of(self, char: str) -> list[int]:
        """Byte pieces of a character without a piece, or the unknown piece."""
        found = self._byte[list(char.encode("utf-8", "surrogatepass"))].tolist()
        return found if min(found) >= 0 else [self._unknown]

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """True where merging the characters of two pieces gives the two again."""
        pairs = left * len(self.pieces) + right
        at = self._place(pairs)
        apart = self._apart[at]
        new = np.flatnonzero(self._pairs[at] != pairs)
        if len(new):
            unknown, own = np.unique(pairs[new], return_inverse=True)
            told = np.empty(len(unknown), dtype=bool)
            for i, pair in enumerate(unknown.tolist()):
                a, b = divmod(pair, len(self.pieces))
                told[i] = self.merge(self.pieces[a] + self.pieces[b]) == [a, b]
            apart[new] = told[own]
            places, first = np.unique(self._place(unknown), return_index=True)
            self._pairs[places], self._apart[places] = unknown[first], told[first]
        return apart

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * _BASE) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    # ---- Viterbi: words of one length ----------------------------------

    def _probe(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), _NONE, dtype=np.int64)
        rows = np.flatnonzero(self._some[keys >> _TOP])
        keys = keys[rows]
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        same = self._keys[at] == keys
        out[rows[same]] = self._key_ids[at[same]]
        return out

    def viterbi(self, words: list[str]) -> list[list[int]]:
        """Ids of words that all have the same number of characters."""
        length, n = len(words[0]), len(words)
        sums, down = _hash(_code_points(words, length))
        last = np.full((length + 1, n), _NONE, dtype=np.int64)
        size = np.zeros((length + 1, n), dtype=np.int64)
        weight = np.full((length + 1, n), -np.inf)
        last[0], weight[0] = _START, 0.0
        for end in range(1, length + 1):
            for m in range(1, min(end, self.longest) + 1):
                begin = end - m
                found = self._probe(
                    mixed((sums[:, end] - sums[:, begin]) * down[begin] + np.uint64(m))
                )
                if m == 1:
                    found = np.where(found == _NONE, _UNKNOWN, found)
                usable = (found != _NONE) & (weight[begin] > -np.inf)
                if self.bpe:
                    usable &= (found == _UNKNOWN) | self._whole[np.maximum(found, 0)]
                rows = np.flatnonzero(usable)
                if not len(rows):
                    continue
                piece, previous = found[rows], last[begin][rows]
                if self.bpe:
                    step = np.zeros(len(rows))
                    both = np.flatnonzero((piece >= 0) & (previous >= 0))
                    if len(both):
                        apart = self._stay_apart(previous[both], piece[both])
                        step[both[~apart]] = -np.inf
                else:
                    step = np.where(
                        piece >= 0, self.scores[np.maximum(piece, 0)], self._unknown_score
                    )
                total = weight[begin][rows] + step
                better = total > weight[end][rows]
                rows, total, piece = rows[better], total[better], piece[better]
                weight[end][rows], last[end][rows], size[end][rows] = total, piece, m
        return [self._back(words[i], last[:, i].tolist(), size[:, i].tolist()) for i in range(n)]

    def _back(self, word: str, last: list[int], size: list[int]) -> list[int]:
        out: list[int] = []
        end = len(word)
        while end:
            piece = last[end]
            out += [piece] if piece >= 0 else self._bytes_of(word[end - 1])[::-1]
            end -= size[end]
        return out[::-1]

    # ---- texts ---------------------------------------------------------

    def _ids_of(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, as the bytes of 32-bit integers."""
        told: dict[str, bytes] = {}
        by_length = defaultdict(list)
        for word in words:
            if self.bpe and (len(word) > LONG or MARK in word[1:]):
                told[word] = array("i", self.merge(word)).tobytes()
            else:
                by_length[len(word)].append(word)
        for group in by_length.values():
            for at in range(0, len(group), 20_000):
                block = group[at : at + 20_000]
                for word, ids in zip(block, self.viterbi(block), strict=True):
                    told[word] = array("i", ids).tobytes()
        return told

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        words: list[str] = []
        counts = []
        for text in texts:
            own = _WORD.findall(MARK + text.replace(" ", MARK)) if text else []
            words += own
            counts.append(len(own))
        codes, distinct = numbered(words)
        new = self._ids_of([w for w in distinct if w not in self._words])
        told = [self._words.get(w) or new[w] for w in distinct]
        if len(self._words) < REMEMBERED:  # the first words are the frequent ones
            self._words.update(new)
        sizes = np.array([len(t) // 4 for t in told], dtype=np.int64)
        ids = np.frombuffer(b"".join(told), np.int32)
        out = ragged(ids, (np.cumsum(sizes) - sizes)[codes], sizes[codes])
        upto = np.concatenate(([0], np.cumsum(sizes[codes])))
        ends = np.cumsum(np.array(counts, dtype=np.int64))
        return out, np.diff(upto[np.concatenate(([0], ends))])


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """The model of a file; a Python worker loads it once."""
    return PieceModel(path)


@lru_cache(maxsize=2)
def load_texts(path: str) -> PieceTexts:
    return PieceTexts(path)


def _blocks(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``sizes`` add up to about ``most``, to bound the memory."""
    at, held = 0, 0
    sizes = pc.fill_null(sizes, 0).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield batch.slice(at)


def encode(docs: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``piece_ids`` array<int> of each text."""
    chosen = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for whole in batches:
            for batch in _blocks(whole, pc.utf8_length(whole.column("text")), BLOCK_CHARS):
                ids, sizes = pieces.encode(batch.column("text").to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(keep))), lists], [*keep, "piece_ids"]
                )

    kept = docs.select(*keep).schema
    return chosen.mapInArrow(run, kept.add("piece_ids", T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``encoded`` and the ``text`` of its ``piece_ids``."""
    chosen = encoded.select(*keep, F.coalesce("piece_ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_texts(model)
        for whole in batches:
            lengths = whole.column(len(keep)).value_lengths()
            for batch in _blocks(whole, lengths, BLOCK_CHARS // 4):
                lists = batch.column(len(keep))
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                texts = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False), sizes)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())],
                    [*keep, "text"],
                )

    kept = encoded.select(*keep).schema
    return chosen.mapInArrow(run, kept.add("text", T.StringType()))
