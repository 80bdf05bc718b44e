"""Hashed byte n-gram features of whole texts, and linear models fitted to them on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Number of hashed features; a power of two.
DIM = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letters_only() -> bytes:
    """A table that turns ASCII bytes other than letters into spaces."""
    return bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def ngram_counts(data: bytes, dim: int = DIM) -> np.ndarray:
    """Counts of a text's hashed byte 1-, 2- and 3-grams."""
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint64)
    one, two, three = b, b[:-1] << np.uint64(8) | b[1:], b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    shift = np.uint64(64 - (dim - 1).bit_length())
    keys = np.concatenate((one + np.uint64(1 << 32), two + np.uint64(1 << 33), three))
    return np.bincount(((keys + np.uint64(1)) * _MIX >> shift).astype(np.int64), minlength=dim)


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, of length 1 (0 for no counts)."""
    x = np.sqrt(counts.astype(np.float32))
    return x / max(float(np.linalg.norm(x)), 1e-9)


def matrix(rows: list[bytes], dim: int = DIM) -> np.ndarray:
    return np.stack([unit(ngram_counts(r, dim)) for r in rows]) if rows else np.zeros((0, dim), np.float32)


def gathered(vectors: pa.ChunkedArray, dim: int = DIM) -> np.ndarray:
    """Counts that tasks sent as bytes of 32-bit floats, as unit rows."""
    x = np.empty((len(vectors), dim), np.float32)
    at = 0
    for chunk in vectors.chunks:
        for v in chunk:
            x[at] = unit(np.frombuffer(v.as_buffer(), np.float32))
            at += 1
    return x


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 200) -> np.ndarray:
    """Linear SVM, y in {-1, 1}, or 0 for rows that don't count: weights and bias for the squared hinge loss with classes
    in balance."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), np.where(y < 0, 0.5 / max((y < 0).sum(), 1), 0)).astype(np.float32)
    return _descend(x, lambda z: -2 * cost * share * y * np.maximum(0, 1 - y * z), 4 * cost, steps)


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, cost: float = 200.0, steps: int = 300) -> np.ndarray:
    """Logistic regression on soft targets in 0..1: weights and bias."""
    weight = (weight / max(weight.sum(), 1e-9)).astype(np.float32)
    return _descend(x, lambda z: cost * weight * (1 / (1 + np.exp(-z)) - target), cost, steps)


def _descend(x: np.ndarray, slope, curve: float, steps: int) -> np.ndarray:
    """Accelerated gradient descent for a loss of x @ w + b plus (|w|^2 + b^2) / 2; curve bounds the loss's curvature."""
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    rate = 1 / (curve + 1)
    for t in range(steps):
        s = slope(x @ v[:-1] + v[-1]).astype(np.float32)
        step = v - rate * (np.append(s @ x, s.sum()) + v)
        v = step + t / (t + 3) * (step - w)
        w = step
    return w.astype(np.float32)


def margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]
