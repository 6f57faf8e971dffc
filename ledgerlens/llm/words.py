"""Texts as arrays: words, hashes and windows of a whole Arrow batch, without a Python object per word.

Batches are cut into slices of bounded size and number of texts. Where a text is longer
than a slice, ``pieces`` cuts it into overlapping parts, each window standing in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What separates words, U+0020 and U+0009 to U+000D, as a Java and DuckDB character class.
SEPARATOR_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SEPARATORS = [0x20, *range(0x09, 0x0E)]

#: Bounds of a slice. Working arrays hold up to a hundred bytes for each byte of it.
SLICE_BYTES = (1 << 18) - 1
SLICE_TEXTS = 256

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[SEPARATORS] = False

#: A 64-bit value for each byte.
BYTE_VALUES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the information of 64-bit values over all their bits; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=8)
def _powers(base: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, for as many places as a slice has."""
    out = np.empty(SLICE_BYTES + 1, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < len(out):
        step = min(filled, len(out) - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 2**64))
        filled += step
    return out


def _leaps(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` at the multiples of a slice's length, up to n."""
    size = SLICE_BYTES + 1
    return np.array([pow(base, size * k, 2**64) for k in range(n // size + 1)], dtype=np.uint64)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each values[start:end]; equal ranges hash equally wherever they stand."""
    base, size = _BASES[seed], SLICE_BYTES + 1
    inverse = pow(base, -1, 2**64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    for at, leap in zip(range(0, len(values), size), _leaps(base, len(values)), strict=False):
        part = values[at : at + size]
        sums[at + 1 : at + 1 + len(part)] = part * _powers(base)[: len(part)] * leap
    np.cumsum(sums, out=sums)
    found = (sums[ends] - sums[starts]) * _powers(inverse)[starts % size]
    if len(values) >= size:
        found *= _leaps(inverse, len(values))[starts // size]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(_BASES[(seed + 1) % 3]))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts in them, with the end; null is empty."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, texts: int = SLICE_TEXTS) -> Iterator[tuple[int, int]]:
    """Consecutive texts of at most ``most`` bytes together, and ``texts`` in number, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        last = min(last, n, first + texts)
        yield first, last
        first = last


def pieces(n: int, window: int, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Parts [begin, end) of n items that overlap by ``window`` - 1: every window stands whole in exactly one."""
    step = max(most - window + 1, window)
    for begin in range(0, max(n - window + 1, 1), step):
        yield begin, min(begin + step + window - 1, n)


class Words:
    """The words of some texts, numbered through."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD):
        """``data`` holds the texts one after the other, ``offsets`` where each begins, and the end."""
        inside = is_word[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]  # a word ends with its text
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        self.data = data
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Number of the first word of each text, and of all words at the end.
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(out):
            begin = int(self.starts[first])
            last = max(first + 1, int(np.searchsorted(self.ends, begin + SLICE_BYTES, side="right")))
            part = values[self.data[begin : int(self.ends[last - 1])]]
            out[first:last] = range_hashes(part, self.starts[first:last] - begin, self.ends[first:last] - begin)
            first = last
        return out

    def owners(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Every start of ``size`` consecutive items within one text."""
    room = np.maximum(np.diff(bounds) - size + 1, 0)
    total = int(room.sum())
    return np.arange(total) - np.repeat(np.cumsum(room) - room, room) + np.repeat(bounds[:-1], room)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values, in log2(size) passes."""
    out, span = values, 1
    while span < size:
        step = min(span, size - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def anchors(gram_hashes: np.ndarray, windows: np.ndarray, grams: int) -> np.ndarray:
    """For each window, the place of its least gram, the first one on a tie.

    Two windows of equal content have it at the same distance from their start, so
    that a repeated window can be found by its anchor alone. ``grams``: per window.
    """
    places = np.arange(len(gram_hashes), dtype=np.uint64)
    bits = np.uint64(max(1, int(len(gram_hashes)).bit_length()))
    keyed = (gram_hashes >> bits << bits) | places
    return (sliding_least(keyed, grams)[windows] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n items lie in one of the ranges."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
