"""Words and shingles of many texts at once, as arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in slices of about this many bytes.
SLICE_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)

_is_space = np.zeros(256, dtype=bool)
_is_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32


def _random_words(n: int, salt: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that depend on ``salt`` alone."""
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * _MIX
    return mix64(x) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on unsigned 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = _random_words(256, 1)
_OF_PLACE = _random_words(64, 2)
_OF_SHINGLE = _random_words(64, 3)


def _places(n: int) -> np.ndarray:
    global _OF_PLACE
    if n > len(_OF_PLACE):
        _OF_PLACE = _random_words(2 * n, 2)
    return _OF_PLACE


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of slices of a string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of the first of its words."""
    inside = ~_is_space[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | fresh[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (np.r_[~inside[1:], True] | fresh[1:])) + 1 if len(data) else starts
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of words, with A-Z as a-z or, without ``fold``, as they are."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
    at = place + np.repeat(starts, sizes)
    terms = _OF_BYTE[_lower[data[at]] if fold else data[at]] * _places(int(sizes.max()))[place]
    return mix64(np.add.reduceat(terms, before) + sizes.astype(np.uint64))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, from the hashes of the words."""
    runs = max(0, len(words) - n + 1)
    whole = np.full(runs, n, dtype=np.uint64)
    for k in range(n):
        whole += words[k : k + runs] * _OF_SHINGLE[k]
    return mix64(whole)


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``n`` words.

    A text of fewer words has its whole sequence as one; without words, none.
    """
    for _, data, offsets in slices(column):
        starts, ends, first = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        whole = run_hashes(words, n)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                yield np.unique(whole[a : b - n + 1])
            elif b > a:
                short = words[a:b] * _OF_SHINGLE[: b - a]
                yield mix64(np.array([short.sum() + np.uint64(b - a)], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
