"""Exact null distribution of the Mann-Whitney U.

Without ties the counts of U are the coefficients of a Gaussian binomial, a product
and a quotient of short polynomials.  With ties the distribution is the one given the
sizes of the tied groups, by the shift algorithm: the groups are dealt out from the
least value up, and choosing members for the smaller sample shifts its U.  Both are
kept as probabilities in doubles, so no integer width limits the sample sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def mw_exact_sf_np(u: float, m: int, n: int) -> float:
    """P(U >= u) under the null for sample sizes m, n without ties."""
    k, big = sorted((int(m), int(n)))
    most = k * big
    low = math.ceil(u)
    if low <= 0:
        return 1.0
    if low > most:
        return 0.0
    if 2 * low <= most:  # U is symmetric: take the shorter tail
        return 1.0 - mw_exact_sf_np(most - low + 1, m, n)
    size = most - low + 1  # P(U >= low) = P(U <= most - low)
    p = np.zeros(size)
    p[0] = 1.0
    for i in range(1, k + 1):
        # divide by 1 - q^i, multiply by 1 - q^(big + i), scale by i / (big + i)
        blocks = np.concatenate([p, np.zeros(-size % i)]).reshape(-1, i)
        p = np.cumsum(blocks, axis=0).reshape(-1)[:size]
        if big + i < size:
            p[big + i :] = p[big + i :] - p[: size - big - i]
        p *= i / (big + i)
    return float(p.sum())


def mw_exact_ties_sf_np(u: float, m: int, n: int, tied: list[int]) -> float:
    """P(U >= u) for the first of two samples of sizes m and n, given the sizes of the
    groups of equal values in ascending order.  U counts a tie as a half.

    Time grows with groups * min(m, n) ** 2 * max(m, n), memory with
    min(m, n) ** 2 * max(m, n)."""
    if m > n:  # U of the first sample from that of the second: P(m n - U2 >= u)
        return 1.0 - mw_exact_ties_sf_np(m * n - u + 0.5, n, m, tied)
    size = 2 * m * n + 1  # doubled U
    state = np.zeros((m + 1, size))
    state[0, 0] = 1.0
    below, total = 0, m + n
    for t in tied:
        after = np.zeros_like(state)
        for k in range(max(0, m - (total - below)), min(m, below) + 1):
            ways = math.comb(total - below, m - k)
            for i in range(max(0, m - k - (total - below - t)), min(t, m - k) + 1):
                shift = 2 * i * (below - k) + i * (t - i)
                p = math.comb(t, i) * math.comb(total - below - t, m - k - i) / ways
                after[k + i, shift:] += p * state[k, : size - shift]
        state, below = after, below + t
    return float(min(1.0, state[m, max(0, math.ceil(2 * u - 1e-9)) :].sum()))


@F.pandas_udf(DoubleType())
def _mw_exact_udf(u: pd.Series, m: pd.Series, n: pd.Series, tied: pd.Series) -> pd.Series:
    def tail(u: float, m: int, n: int, tied: list[int]) -> float:
        if pd.isna(u) or not m or not n:
            return np.nan
        return mw_exact_sf_np(u, m, n) if max(tied) == 1 else mw_exact_ties_sf_np(u, int(m), int(n), [int(t) for t in tied])

    return pd.Series([tail(*row) for row in zip(u, m, n, tied)], dtype="float64")


def mw_exact_sf(u: Column, m: Column, n: Column, tied: Column) -> Column:
    """P(U >= u) for the one row of a test; ``tied`` holds the sizes of the groups of
    equal values in ascending order.  NULL without values in a sample."""
    p = _mw_exact_udf(u.cast("double"), m.cast("long"), n.cast("long"), tied.cast("array<long>"))
    return F.when(~F.isnan(p), p)
