"""Word and shingle hashes of whole texts, by array operations.

Words are runs of ASCII letters, digits and non-ASCII characters of the lower-cased text. A text of fewer than `width`
words is one shingle of all its words; one without words has none.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_U = np.uint64
_LETTERS = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_POWERS = np.ones(64, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def word_hashes(text: str | None) -> np.ndarray:
    global _POWERS
    b = np.frombuffer((text or "").lower().encode().translate(_SEPARATE), np.uint8)
    inside = b != 32
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1]))) if len(b) else np.empty(0, np.int64)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = np.diff(np.append(starts, len(b)))
    offset = np.arange(starts[0], len(b)) - np.repeat(starts, lengths)
    need = int(offset.max()) + 1
    if need > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * need, _BASE))))
    elif len(_POWERS) == 64 and _POWERS[1] == 1:
        _POWERS = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(1023, _BASE))))
        return word_hashes(text)
    terms = np.where(inside[starts[0] :], _LETTERS[b[starts[0] :]] * _POWERS[offset], _U(0))
    return mixed(np.add.reduceat(terms, starts - starts[0]))


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash for each run of `width` words, in order."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n] * _BASE
    for j in range(1, width):
        out += words[j : n + j]
        out *= _BASE
    out += _U(width)
    return mixed(out)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """In ascending order."""
    out = np.sort(hashes)
    first = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=first[1:])
    return out[first]


_places = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def fingerprint(words: np.ndarray) -> tuple[int, int]:
    """128 bits of the word sequence, as two signed integers."""
    n = len(words)
    if n > len(_places[0]):
        at = np.arange(1, max(2 * n, 1024) + 1, dtype=np.uint64)
        _places[:] = at * _BASE, mixed(at)
    a = mixed(words + _places[0][:n]).sum(dtype=np.uint64)
    b = mixed(words ^ _places[1][:n]).sum(dtype=np.uint64)
    return tuple(np.array([a, b], np.uint64).view(np.int64).tolist())
