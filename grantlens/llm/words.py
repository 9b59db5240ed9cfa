"""Words of many texts at once: byte tables, boundaries and fingerprints in numpy."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that are no word bytes, in the two definitions in use (after lower-casing A-Z).
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
NOT_SPACE = ~_SPACES
ALPHANUMERIC = ~_PUNCTUATION

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))), dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}
KEPT = 4_000_000


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64, kept for the next call up to KEPT of them."""
    if len(_TABLES.get("up", ())) > n:
        return _TABLES["up"], _TABLES["down"]
    up, down = _powers(_BASE, n), _powers(_INVERSE, n)
    if n <= KEPT:
        _TABLES["up"], _TABLES["down"] = up, down
    return up, down


def forget() -> None:
    _TABLES.clear()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bounds(data: np.ndarray, marks: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and n + 1 marks into them for the texts between `marks`."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(marks), np.int64)
    word = inside[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = marks[(marks > 0) & (marks < len(data))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, marks)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the words data[starts:ends] (data in lower case)."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(prints: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each `width` consecutive words; the result is width - 1 shorter."""
    n = len(prints) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out *= _BASE
        out += prints[i:i + n]
    return mixed(out)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] values), then the same for the next ones."""
    size = np.asarray(size, np.int64)
    end = np.cumsum(size)
    if not len(end) or not end[-1]:
        return np.zeros(0, np.int64)
    return np.arange(end[-1], dtype=np.int64) + np.repeat(np.asarray(first, np.int64) - (end - size), size)
