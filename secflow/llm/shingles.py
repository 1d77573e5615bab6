"""Word shingle hashes of many texts at once (numpy), shared by the shingle operators.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.  A word's hash is a
polynomial over its bytes, taken from prefix sums; a shingle's hash mixes its words' hashes.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]), dtype=np.uint64)
                      for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes], space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text with the total appended).

    ``space`` marks the bytes between words; the byte 0x20 must be one of them.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    begin = ends - np.array([len(t) + 1 for t in texts], dtype=np.int64) if texts else ends
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    edge = np.diff(np.concatenate([[True], space[data], [True]]).astype(np.int8))
    lo, hi = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)],
                            np.cumsum((_FOLD[data].astype(np.uint64) + np.uint64(1)) * power[:len(data)],
                                      dtype=np.uint64)])
    hashes = mix((total[hi] - total[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))
    return hashes, np.concatenate([np.searchsorted(lo, begin), [len(lo)]])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter (none if empty)."""
    n = len(words)
    if n == 0:
        return words
    span = min(size, n)
    acc = np.full(n - span + 1, np.uint64(span))
    for i in range(span):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + words[i:n - span + 1 + i])
    return acc
