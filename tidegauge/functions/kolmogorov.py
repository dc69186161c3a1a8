"""Exact and near-exact p-values of the Kolmogorov-Smirnov statistic: functions of three numbers."""

from __future__ import annotations

import math

import numpy as np

EXACT_ROWS = 10_000  # fixed value: two samples of at most so many rows each are counted exactly
#: Samples up to this size get the matrix recursion, larger ones the expansion (good to 1e-7 from there).
MATRIX_ROWS = 1000
#: Where 2 * rows * gap**2 exceeds this, p is under 1e-8.
CERTAIN = 20.0


def two_sample_p(gap: float, base_rows: int, now_rows: int) -> float:
    """Probability that two samples of one distribution differ by at least ``gap``.

    Samples of up to ``EXACT_ROWS`` rows are counted; beyond that the gap is judged like that of one
    sample of ``base_rows * now_rows / (base_rows + now_rows)`` rows, rounded.
    """
    effective = base_rows * now_rows / (base_rows + now_rows)
    if 2 * effective * gap * gap > CERTAIN:
        return 0.0
    if max(base_rows, now_rows) <= EXACT_ROWS:
        return lattice_p(round(gap * base_rows * now_rows), base_rows, now_rows)
    return one_sample_p(gap, max(1, round(effective)))


def lattice_p(gap: int, m: int, n: int) -> float:
    """Share of the lattice paths from (0, 0) to (m, n) on which ``abs(i * n - j * m)`` reaches ``gap``.

    Works along the diagonals i + j = s: the share of paths to a point that have stayed inside comes
    from the two points before it, and only points inside are kept.
    """
    if gap <= 0:
        return 1.0
    low, inside = 0, np.ones(1)
    for s in range(1, m + n + 1):
        first = max(0, s - n, (s * m - gap) // (m + n) + 1)
        last = min(m, s, -((-s * m - gap) // (m + n)) - 1)
        if last < first:
            return 1.0
        i = np.arange(first, last + 1)
        padded = np.zeros(last - first + 2)  # the diagonal before, from first - 1 to last
        begin, end = max(low, first - 1), min(low + len(inside), last + 1)
        if begin < end:
            padded[begin - first + 1:end - first + 1] = inside[begin - low:end - low]
        inside = (padded[:-1] * i + padded[1:] * (s - i)) / s
        low = first
    return float(min(1.0, max(0.0, 1.0 - inside[m - low])))


def one_sample_p(gap: float, rows: int) -> float:
    """Probability that a sample of ``rows`` differs from its distribution by at least ``gap``."""
    if gap >= 1:
        return 0.0
    if 2 * rows * gap * gap > CERTAIN:
        return 0.0
    below = _matrix_cdf(gap, rows) if rows <= MATRIX_ROWS else _expansion_cdf(gap, rows)
    return float(min(1.0, max(0.0, 1.0 - below)))


def _matrix_cdf(gap: float, rows: int) -> float:
    """Durbin's matrix, multiplied ``rows`` times into a vector; ``rows! / rows**rows`` is dealt evenly to the steps."""
    k = math.floor(rows * gap) + 1
    size, h = 2 * k - 1, k - rows * gap
    shares = np.cumprod(1 / np.maximum(np.arange(size + 1), 1))  # 1 / i!
    at = np.arange(size)
    over = at[:, None] - at[None, :] + 1
    step = np.where(over >= 0, shares[np.maximum(over, 0)], 0.0)
    edge = h ** np.arange(1, size + 1) * shares[1:]
    step[:, 0] -= edge
    step[size - 1] -= edge[::-1]
    if 2 * h > 1:
        step[size - 1, 0] += (2 * h - 1) ** size * shares[size]
    scale = math.exp((math.lgamma(rows + 1) - rows * math.log(rows)) / rows)
    vector = np.zeros(size)
    vector[k - 1] = 1.0
    for _ in range(rows):
        vector = step @ vector * scale
    return float(vector[k - 1])


def _expansion_cdf(gap: float, rows: int) -> float:
    """The limit distribution and its next three terms in 1 / sqrt(rows) (Pelz and Good)."""
    z = math.sqrt(rows) * gap
    pi2 = math.pi**2
    odd = np.arange(1, 2 * math.ceil(16 * z / math.pi) + 2, 2, dtype=float) ** 2 * pi2 / 4  # (k + 1/2)**2 pi**2
    whole = np.arange(1, math.ceil(16 * z / math.pi) + 2, dtype=float) ** 2 * pi2
    weight, full = np.exp(-odd / (2 * z * z)), np.exp(-whole / (2 * z * z))
    root = math.sqrt(2 * math.pi)
    # Sums over all whole k, so terms of odd and whole stand for two each, but for whole k = 0.
    terms = [
        root / z * weight.sum(),
        root / (6 * z**4) * ((odd - z * z) * weight).sum(),
        root / (72 * z**7) * ((6 * z**6 + 2 * z**4 + (2 * z**4 - 5 * z**2) * odd + (1 - 2 * z**2) * odd**2) * weight).sum()
        - root / (36 * z**3) * (whole * full).sum(),
        root / (6480 * z**10) * ((-30 * z**6 - 90 * z**8 + (135 * z**4 - 96 * z**6) * odd + (212 * z**4 - 60 * z**2) * odd**2
                                  + (5 - 30 * z**2) * odd**3) * weight).sum()
        + root / (216 * z**6) * ((3 * z * z * whole - whole**2) * full).sum(),
    ]
    return sum(term / rows ** (i / 2) for i, term in enumerate(terms))
