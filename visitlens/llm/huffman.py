"""Canonical length-limited Huffman codes, vectorised."""

from __future__ import annotations

import numpy as np

LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, 0 where a count is 0.

    Package-merge: at each level the symbols are merged with pairs of the level
    below; the first 2n - 2 entries of the last level say how many of the
    lightest symbols each level lengthens.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = np.asarray(counts, dtype=np.float64)[order]
    levels = []
    packages = np.empty(0)
    for _ in range(limit):
        both = np.concatenate((weights, packages))
        merged = np.argsort(both, kind="stable")
        levels.append(merged < n)  # which entries are symbols
        both = both[merged]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:taken].sum())
        lengths[order[:symbols]] += 1
        taken = 2 * (taken - symbols)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if not len(order):
        return codes
    own = lengths[order].astype(np.int64)
    longest = int(own.max())
    # a code, filled up to the longest length, is the sum of what precedes it
    steps = np.left_shift(np.uint64(1), (longest - own).astype(np.uint64))
    codes[order] = (np.cumsum(steps) - steps) >> (longest - own).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, length) for each string of ``limit`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = np.left_shift(1, limit - lengths[order].astype(np.int64))
    symbols = np.zeros(1 << limit, dtype=np.int32)
    sizes = np.ones(1 << limit, dtype=np.int64)
    upto = int(spans.sum())
    symbols[:upto] = np.repeat(order, spans)
    sizes[:upto] = np.repeat(lengths[order], spans)
    return symbols, sizes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` in a row, most significant bit first, and the bit
    offset of each."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    words = np.zeros((int(ends[-1]) >> 6) + 2 if len(ids) else 0, dtype=np.uint64)
    if len(ids):
        at, room = starts >> 6, 64 - (starts & 63)
        over = size - room
        code = codes[ids]
        high = np.where(
            over > 0,
            code >> np.maximum(over, 0).astype(np.uint64),
            code << np.maximum(-over, 0).astype(np.uint64),
        )
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        words[at[first]] = np.bitwise_or.reduceat(high, first)
        split = np.flatnonzero(over > 0)
        words[at[split] + 1] |= code[split] << (64 - over[split]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts


def unpack(
    data: bytes, n: int, checkpoints: np.ndarray, step: int,
    table: tuple[np.ndarray, np.ndarray], limit: int = LIMIT,
) -> np.ndarray:
    """The ``n`` ids of ``pack``; every ``step``-th has its bit offset in
    ``checkpoints``, and all stretches between them are decoded side by side."""
    raw = np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    symbols, sizes = table
    at = checkpoints.astype(np.int64)
    out = np.zeros((len(at), step), dtype=np.int32)
    last = len(window) - 1
    for i in range(step):
        # the last stretch may be short: it reads on in the padding
        bits = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
        found = bits >> np.uint32(32 - limit)
        out[:, i] = symbols[found]
        at += sizes[found]
    return out.ravel()[:n]
