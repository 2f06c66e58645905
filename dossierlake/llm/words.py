"""Words of many texts at once: spans, 64-bit hashes and hashes of word windows."""

from __future__ import annotations

import numpy as np

# The white space of ASCII; every other byte belongs to a word.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x2545F4914F6CDD1D)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x + _STEP
    x ^= x >> np.uint64(30)
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, at least."""
    global _powers
    while len(_powers) < n:
        top = np.uint64(int(_powers[-1]) * int(_BASE) & ((1 << 64) - 1))
        _powers = np.concatenate([_powers, _powers * top])
    return _powers


def spans(
    data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; a word ends at a gap byte or with its row."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    word = ~gap[data]
    fresh = word.copy()
    fresh[1:] &= ~word[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    fresh[heads] = word[heads]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    before = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    letters = data[at + np.repeat(starts, lengths)].astype(np.uint64)
    letters += np.uint64(1)
    letters *= powers(int(lengths.max()))[at]
    return mix(np.add.reduceat(letters, before) ^ mix(lengths.astype(np.uint64)))


def window_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and index of the first word of every window of so many words of one row."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += words[i : i + n] * powers(width)[i]
    whole = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return mix(total[whole]), whole
