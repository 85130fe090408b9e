"""Tail probabilities of test statistics, vectorised over Arrow batches.

Each function takes whole columns of statistics: special functions by series and
continued fractions that all rows walk together, exact tests by numpy
recursions over one table or one (n, m, statistic) each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ``method="auto"``: largest sample for which the two-sample KS test is exact
KS_EXACT_MAX = 10_000
#: the rank-sum test is exact when the smaller group has at most this many cells and no ties
RANK_SUM_EXACT_MAX = 8
#: log ratio below which two tables count as equally likely
FISHER_SLACK = 1e-7
_TINY, _CLOSE = 1e-300, 1e-15


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in x.tolist()])


def _walk(first: np.ndarray, term) -> np.ndarray:
    """A continued fraction first + a1 / (b1 + a2 / (b2 + ...)), ``term(k)`` giving (a, b), until no row moves."""
    value = np.where(first == 0, _TINY, first)
    c, d = value.copy(), np.zeros_like(value)
    k = 1
    while True:
        a, b = term(k)
        d = b + a * d
        d = 1.0 / np.where(d == 0, _TINY, d)
        c = b + a / c
        c = np.where(c == 0, _TINY, c)
        value = value * c * d
        if k > 2 and np.all(np.abs(c * d - 1.0) < _CLOSE * 4):
            return value
        k += 1


def regularized_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """I_x(a, b) for 0 <= x <= 1."""
    swap = x > (a + 1) / (a + b + 2)
    y, p, q = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)

    def term(k: int):
        m = k // 2
        if k == 1:
            return np.ones_like(y), np.ones_like(y)
        j = k - 1
        m = j // 2
        top = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)) if j % 2 == 0 else -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        return top, np.ones_like(y)

    with np.errstate(divide="ignore"):
        front = np.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(y) + q * np.log1p(-y))
    value = np.where(y <= 0, 0.0, front * _walk(np.zeros_like(y), term) / p)
    return np.where(swap, 1 - value, value)


def upper_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Q(a, x): by the series of its complement up to the mean, by a continued fraction beyond."""
    out = np.ones_like(x)
    with np.errstate(divide="ignore"):
        front = np.exp(a * np.log(x) - x - _log_gamma(a))
    low = (x < a + 1) & (x > 0)
    if low.any():
        s, y = a[low], x[low]
        total = term = 1 / s
        k = 0
        while np.any(term > total * _CLOSE):
            k += 1
            term = term * y / (s + k)
            total = total + term
        out[low] = 1 - front[low] * total
    high = x >= a + 1
    if high.any():
        s, y = a[high], x[high]
        out[high] = front[high] * _walk(np.zeros_like(y), lambda k: (np.ones_like(y), y + 1 - s) if k == 1 else ((k - 1) * (s - (k - 1)), y + 2 * k - 1 - s))
    return out


def _over_known(fn, *columns: pd.Series) -> pd.Series:
    """``fn`` on the rows without a missing argument; the others stay missing."""
    known = ~np.logical_or.reduce([c.isna().to_numpy() for c in columns])
    out = np.full(len(known), np.nan)
    if known.any():
        out[known] = fn(*[c.to_numpy(float)[known] for c in columns])
    return pd.Series(out).where(known, None).astype("float64")


@F.pandas_udf(T.DoubleType())
def _student(t: pd.Series, df: pd.Series) -> pd.Series:
    return _over_known(lambda t, df: np.where(t == 0, 1.0, regularized_beta(df / (df + t * t), df / 2, np.full(len(t), 0.5))), t, df)


@F.pandas_udf(T.DoubleType())
def _normal(z: pd.Series) -> pd.Series:
    return _over_known(lambda z: np.array([math.erfc(v / 2**0.5) / 2 for v in z.tolist()]), z)


@F.pandas_udf(T.DoubleType())
def _chi2(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _over_known(lambda x, dof: upper_gamma(dof / 2, np.maximum(x, 0.0) / 2), x, dof.where(dof > 0))


def _missing_as_null(p: Column) -> Column:
    return F.when(~F.isnan(p), p)


def student_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t."""
    return _missing_as_null(_student(t.cast("double"), df.cast("double")))


def normal_upper(z: Column) -> Column:
    """P(Z >= z)."""
    return _missing_as_null(_normal(z.cast("double")))


def chi2_upper(x: Column, dof: Column) -> Column:
    """P(X >= x) for chi-square."""
    return _missing_as_null(_chi2(x.cast("double"), dof.cast("double")))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Exact two-sided p-value of a 2x2 table: all tables with its margins that are no likelier.

    The hypergeometric weights grow from the mode outwards by the ratio of
    neighbouring tables; beyond 40 standard deviations they vanish in doubles.
    """
    row, col, n = a + b, a + c, a + b + c + d
    lo, hi = max(0, row + col - n), min(row, col)
    if lo == hi:
        return 1.0
    mode = min(max((row + 1) * (col + 1) // (n + 2), lo), hi)
    spread = math.sqrt(row * col / n * (n - row) / n * (n - col) / max(n - 1, 1))
    lo, hi = max(lo, mode - int(40 * spread) - 50), min(hi, mode + int(40 * spread) + 50)
    if not lo <= a <= hi:
        return 0.0
    x = np.arange(lo, hi, dtype=float)
    steps = np.log(row - x) + np.log(col - x) - np.log(x + 1) - np.log(n - row - col + x + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return float(min(1.0, weights[logs <= logs[a - lo] + FISHER_SLACK].sum() / weights.sum()))


@F.pandas_udf(T.DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    tables = zip(*(v.astype("int64").tolist() for v in (a, b, c, d)))
    solved: dict[tuple[int, ...], float] = {}
    return pd.Series([solved[t] if t in solved else solved.setdefault(t, fisher_two_sided(*t)) for t in tables], dtype="float64")


def correlation_two_sided(r: Column, n: Column) -> Column:
    """p-value of a (rank) correlation from t with n - 2 degrees of freedom."""
    free = (n - 2).cast("double")
    t = r * F.sqrt(free / F.greatest((1 - r) * (1 + r), F.lit(1e-300)))
    return F.when(F.abs(r) >= 1.0, F.lit(0.0)).otherwise(student_two_sided(t, free))


def ks_exact(n: int, m: int, d: float) -> float:
    """P(D >= d) for two continuous samples of sizes n and m.

    On the lattice of merged orders, where D n m is a whole number, P(i, j) is
    the chance that a random path to (i, j) has left the band: 1 outside it,
    (i P(i-1, j) + j P(i, j-1)) / (i + j) inside.  Each row of the smaller sample
    is one cumulative sum of positive terms, so small tails keep their relative
    accuracy; it is cut where its weights would overflow.
    """
    if n == 0 or m == 0 or d != d:
        return float("nan")
    rows, size = min(n, m), max(n, m)
    reach = int(round(d * n * m))
    if reach <= 0:
        return 1.0
    at = np.arange(size + 1)
    last = np.where(at * rows >= reach, 1.0, 0.0)
    for i in range(1, rows + 1):
        # inside: |i size - j rows| < reach
        lo, hi = max(0, (i * size - reach) // rows + 1), min(size, -((-i * size - reach) // rows) - 1)
        row = np.ones(size + 1)
        carry = 1.0
        if lo == 0:
            carry = row[0] = last[0]
            lo = 1
        j = at[lo : hi + 1].astype(float)
        growth = np.cumsum(np.log1p(i / j))
        came = i * last[lo : hi + 1] / (i + j)
        start = 0
        while start < len(j):
            base = growth[start - 1] if start else 0.0
            stop = int(np.searchsorted(growth, base + 600.0, "right"))
            stop = max(stop, start + 1)
            weight = np.exp(growth[start:stop] - base)
            row[lo + start : lo + stop] = (carry + np.cumsum(weight * came[start:stop])) / weight
            carry, start = row[lo + stop - 1], stop
        last = row
    return float(min(max(last[size], 0.0), 1.0))


def ks_limit(n: int, m: int, d: float) -> float:
    """Limiting two-sided KS tail for large samples."""
    x = np.sqrt(n * m / (n + m)) * d
    if x < 0.2:
        return 1.0
    k = np.arange(1, 101)
    return float(min(1.0, max(0.0, 2.0 * np.sum((-1.0) ** (k - 1) * np.exp(-2.0 * (k * x) ** 2)))))


def ks_two_sided(n: Column, m: Column, d: Column, method: str = "auto") -> Column:
    """Two-sided two-sample KS p-value.

    ``method``: "exact", "limit" (the limiting distribution), or "auto", exact
    up to ``KS_EXACT_MAX`` cells per group and the limiting form beyond.
    """
    largest = {"exact": math.inf, "limit": 0, "auto": KS_EXACT_MAX}[method]

    @F.pandas_udf(T.DoubleType())
    def tail(n: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:
        rows = zip(n, m, d)
        return pd.Series([None if pd.isna(a) or pd.isna(b) or pd.isna(x) else (ks_exact if max(a, b) <= largest else ks_limit)(int(a), int(b), float(x)) for a, b, x in rows], dtype="float64")

    return tail(n, m, d)


def rank_sum_distribution(n: int, m: int) -> np.ndarray:
    """Probability of every value 0..n*m of the rank-sum statistic U without ties.

    Coefficients of the Gaussian binomial: multiply by (1 - q^(m+i)) and divide by
    (1 - q^i) for i = 1..n, normalised at each step by the binomial ratio.
    """
    size = n * m + 1
    f = np.zeros(size)
    f[0] = 1.0
    for i in range(1, n + 1):
        up = m + i
        if up < size:
            g = f.copy()
            g[up:] -= f[:-up]
            f = g
        for start in range(i):
            f[start::i] = np.cumsum(f[start::i])
        f *= i / (m + i)
    return np.clip(f, 0.0, None)


@F.pandas_udf(T.DoubleType())
def rank_sum_exact_less(n: pd.Series, m: pd.Series, u: pd.Series) -> pd.Series:
    """P(U <= u) without ties, for groups of which one is small."""
    out = []
    for a, b, x in zip(n, m, u):
        if pd.isna(x) or pd.isna(a) or pd.isna(b) or a < 1 or b < 1:
            out.append(None)
            continue
        small, large = sorted((int(a), int(b)))
        out.append(float(min(1.0, rank_sum_distribution(small, large)[: int(np.floor(x)) + 1].sum())))
    return pd.Series(out, dtype="float64")


def rank_sum_less(n: Column, m: Column, u: Column, ties: Column) -> Column:
    """One-sided rank-sum p-value (first group smaller); ``ties`` is the sum of t^3 - t over tie groups."""
    exact = (F.least(n, m) <= RANK_SUM_EXACT_MAX) & (ties == 0)
    # Python functions are evaluated for every row, so rows for the normal tail are masked out
    return F.when(exact, rank_sum_exact_less(n, m, F.when(exact, u))).otherwise(_rank_sum_normal(n, m, u, ties, two_sided=False))


def rank_sum_two_sided(n: Column, m: Column, u: Column, ties: Column) -> Column:
    exact = (F.least(n, m) <= RANK_SUM_EXACT_MAX) & (ties == 0)
    low = F.least(u, n * m - u)
    p = F.least(F.lit(1.0), 2 * rank_sum_exact_less(n, m, F.when(exact, low)))
    return F.when(exact, p).otherwise(_rank_sum_normal(n, m, u, ties, two_sided=True))


def _rank_sum_normal(n: Column, m: Column, u: Column, ties: Column, two_sided: bool) -> Column:
    """Tie-corrected normal tail with a continuity correction of one half."""
    n, m, u = n.cast("double"), m.cast("double"), u.cast("double")
    total = n + m
    var = n * m / 12 * (total + 1 - ties.cast("double") / (total * (total - 1)))
    mean = n * m / 2
    if two_sided:
        z = (F.greatest(u, n * m - u) - mean - 0.5) / F.sqrt(var)
        p = F.least(F.lit(1.0), 2 * normal_upper(z))
    else:
        z = (mean - u - 0.5) / F.sqrt(var)
        p = normal_upper(z)
    # all values tied: no spread, no evidence against the null
    return F.when(var > 0, p).when(n * m > 0, F.lit(1.0))
