"""Krichevsky-Trofimov estimates from counts of zeros and ones."""

from __future__ import annotations

import math

import numpy as np

SMALL = 1 << 16


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after seven steps of the recurrence."""
    shift = np.zeros_like(x)
    for k in range(7):
        shift += np.log(x + k)
    y = x + 7
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


HALVES = _log_gamma(np.arange(SMALL) + 0.5) - _log_gamma(np.array([0.5]))
WHOLES = _log_gamma(np.arange(SMALL) + 1.0)


def _pick(table: np.ndarray, counts: np.ndarray, offset: float, base: float) -> np.ndarray:
    small = counts < SMALL
    out = table[np.where(small, counts, 0)]
    if not small.all():
        out[~small] = _log_gamma(counts[~small] + offset) - base
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    base = float(_log_gamma(np.array([0.5]))[0])
    return _pick(HALVES, zeros, 0.5, base) + _pick(HALVES, ones, 0.5, base) - _pick(WHOLES, zeros + ones, 1.0, 0.0)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Probability of a one after these counts."""
    return (ones + 0.5) / (zeros + ones + 1.0)
