"""Content hashes of words and shingles, vectorised over a column of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfwright.llm import textcols

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(64, np.uint64)
AT_ONCE = 1 << 20


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """_BASE to the powers 0 .. n - 1 or more."""
    global _POWERS
    while len(_POWERS) < n + 1 or _POWERS[1] == 1:
        grown = np.full(max(len(_POWERS) * 2, n + 1), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range (ascending, not empty, not overlapping), some ``AT_ONCE`` bytes at a time."""
    hashes = np.empty(len(starts), np.uint64)
    total = np.cumsum(ends - starts)
    first = 0
    while first < len(starts):
        done = int(total[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + AT_ONCE, "right")))
        hashes[first:last] = _hashes(data, starts[first:last], ends[first:last])
        first = last
    return hashes


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    chars = data[within + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    return scrambled(np.add.reduceat(chars * powers(int(lengths.max()))[within], first) + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k words in a row, over row borders as well; len(words) - k + 1 of them."""
    n = max(0, len(words) - k + 1)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total = total * _STEP + words[j : j + n]
    return scrambled(total)


def keys_of(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the numbers side by side: that of ``gram_hashes`` for these numbers, scrambled, in a row."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        total = total * _STEP + scrambled(c.astype(np.uint64))
    return scrambled(total)


def shingle_sets(column: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within a row, and the row bounds.

    A text of fewer than ``k`` words has one shingle, all of its words; one without words has none.
    """
    data, bounds = textcols.flat(column)
    if lower:
        data = textcols.lower_ascii(data)
    starts, ends, words = textcols.word_runs(data, bounds)
    hashed = word_hashes(data, starts, ends)
    counts = np.diff(words)
    grams = gram_hashes(hashed, k)
    row = textcols.owner(words)
    stop = words[1:][row] if len(row) else row
    inside = np.arange(len(hashed)) + k <= stop
    values, rows = grams[inside[: len(grams)]], row[inside]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        short = np.array([gram_hashes(hashed[words[i] : words[i + 1]], int(counts[i]))[0] for i in few], np.uint64)
        values, rows = np.concatenate([values, short]), np.concatenate([rows, few])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (np.diff(rows) != 0) | (np.diff(values) != 0)
    values, rows = values[fresh], rows[fresh]
    return values, np.searchsorted(rows, np.arange(len(counts) + 1))
