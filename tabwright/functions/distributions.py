"""Tail probabilities and quantiles for rows that are already aggregated.

Spark has no Student-t, chi-square or F distribution, so these are Arrow-batched
pandas UDFs; they only ever see one row per test.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tabwright.shipping import ship_active

_NORMAL = NormalDist()
#: Degrees of freedom beyond which the expansion around the normal tail is exact to 1e-12.
NEARLY_NORMAL = 1e6


def normal_quantile(p: float) -> float:
    return _NORMAL.inv_cdf(p)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), for arrays.

    Values leave as they converge; one that does not is an error, not a guess.
    """
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) > tiny, d, tiny)
    h = d.copy()
    left = np.arange(len(x))
    out = np.empty_like(x)
    for m in range(1, 1_000_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) > tiny, d, tiny)
            c = 1.0 + num / c
            c = np.where(np.abs(c) > tiny, c, tiny)
            h = h * (d * c)
        done = np.abs(d * c - 1.0) < 1e-15
        if done.any():
            out[left[done]] = h[done]
            a, b, x, c, d, h, left = (v[~done] for v in (a, b, x, c, d, h, left))
        if not len(left):
            return out
    raise ArithmeticError("the incomplete beta function does not converge")


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the beta function; for a half beside something large by a series, as log-gammas would cancel."""
    large, small = np.maximum(a, b), np.minimum(a, b)
    series = (small == 0.5) & (large > 50)
    out = np.array([math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y) for x, y in zip(a.tolist(), b.tolist())])
    r = 1.0 / large
    ratio = 1 - r / 8 + r**2 / 128 + 5 * r**3 / 1024 - 21 * r**4 / 32768 - 399 * r**5 / 262144  # G(n + 1/2) / (G(n) sqrt(n))
    return np.where(series, 0.5 * math.log(math.pi) - 0.5 * np.log(large) - np.log(ratio), out)


def _beta_split(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, log_x: np.ndarray, log_y: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function at x, given y = 1 - x and both logarithms without rounding."""
    front = np.exp(a * log_x + b * log_y - _log_beta(a, b))
    low = x < (a + 1.0) / (a + b + 2.0)
    out = np.empty_like(x)
    if low.any():
        out[low] = front[low] * _beta_fraction(a[low], b[low], x[low]) / a[low]
    if (~low).any():
        out[~low] = 1.0 - front[~low] * _beta_fraction(b[~low], a[~low], y[~low]) / b[~low]
    return out


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    v = [np.array([float(n)]) for n in (a, b, x, 1.0 - x, math.log(x), math.log1p(-x))]
    return float(_beta_split(*v)[0])


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    log_front = -x + s * math.log(x) - math.lgamma(s)
    if x < s + 1.0:
        term = total = 1.0 / s
        n = s
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - math.exp(log_front) * total
    tiny = 1e-300
    b = x + 1.0 - s
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - s)
        b += 2.0
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return math.exp(log_front) * h


def t_two_sided(t, df):
    """P(|T| >= |t|) for numbers or arrays; 1e-9 and better for any degrees of freedom."""
    t, df = np.broadcast_arrays(np.asarray(t, np.float64), np.asarray(df, np.float64))
    flat, n = np.abs(t).ravel(), df.ravel()
    out = np.where(flat == 0, 1.0, 0.0)
    many = n > NEARLY_NORMAL
    for k in np.flatnonzero(many & (flat > 0)).tolist():
        x, v = float(flat[k]), float(n[k])
        z = x * (1 - (x * x + 1) / (4 * v) + (13 * x**4 + 8 * x * x + 3) / (96 * v * v)) if x < 40 else x
        out[k] = math.erfc(z / math.sqrt(2.0))
    at = np.flatnonzero((flat > 0) & np.isfinite(flat) & ~many)
    if len(at):
        with np.errstate(over="ignore", under="ignore"):
            share = flat[at] * (flat[at] / n[at])  # t^2 / df
            y = share / (1.0 + share)
            log_y = np.log(flat[at]) + np.log(flat[at] / n[at]) - np.log1p(share)
            out[at] = _beta_split(n[at] / 2.0, np.full(len(at), 0.5), 1.0 / (1.0 + share), y, -np.log1p(share), log_y)
    return float(out[0]) if t.ndim == 0 else out.reshape(t.shape)


def t_upper(t, df):
    half = np.asarray(t_two_sided(t, df)) / 2.0
    out = np.where(np.asarray(t) >= 0, half, 1.0 - half)
    return float(out) if out.ndim == 0 else out


def t_quantile(p: float, df):
    """Inverse of the Student-t CDF by bisection, all degrees of freedom at once."""
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    n = np.atleast_1d(np.asarray(df, np.float64))
    low, high = np.zeros(len(n)), np.ones(len(n))
    while (far := t_upper(high, n) > 1.0 - p).any():
        high = np.where(far, 2.0 * high, high)
    for _ in range(200):
        middle = (low + high) / 2.0
        if ((middle == low) | (middle == high)).all():
            break
        above = t_upper(middle, n) > 1.0 - p
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    out = (low + high) / 2.0
    return float(out[0]) if np.ndim(df) == 0 else out


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def p_from(upper, statistic, alternative: str):
    if alternative == "two-sided":
        return 2.0 * upper(abs(statistic))
    if alternative == "greater":
        return upper(statistic)
    if alternative == "less":
        return upper(-statistic)
    raise ValueError(f"Unknown alternative: {alternative}")


def check_alternative(alternative: str) -> str:
    ship_active()
    p_from(normal_upper, 0.0, alternative)
    return alternative


def _usable(*xs) -> bool:
    return all(x is not None and x == x for x in xs)


def t_p_value(statistic: Column, df: Column, alternative: str = "two-sided") -> Column:
    check_alternative(alternative)

    @F.pandas_udf(DoubleType())
    def run(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=ts.index, dtype="float64")
        usable = ts.notna() & dfs.notna() & (dfs > 0)
        if usable.any():
            t, v = ts[usable].to_numpy(), dfs[usable].to_numpy()
            out[usable] = p_from(lambda x: t_upper(x, v), t, alternative)
        return out

    return run(statistic.cast("double"), df.cast("double"))


def z_p_value(statistic: Column, alternative: str = "two-sided") -> Column:
    check_alternative(alternative)

    @F.pandas_udf(DoubleType())
    def run(zs: pd.Series) -> pd.Series:
        return pd.Series([p_from(normal_upper, z, alternative) if _usable(z) else None for z in zs], dtype="float64")

    return run(statistic.cast("double"))


def chi2_p_value(statistic: Column, df: Column) -> Column:
    ship_active()

    @F.pandas_udf(DoubleType())
    def run(xs: pd.Series, dfs: pd.Series) -> pd.Series:
        return pd.Series(
            [gamma_upper(v / 2.0, x / 2.0) if _usable(x, v) and v > 0 else None for x, v in zip(xs, dfs)], dtype="float64"
        )

    return run(statistic.cast("double"), df.cast("double"))


def t_critical(df: Column, confidence: float = 0.95) -> Column:
    ship_active()
    tail = 1.0 - (1.0 - confidence) / 2.0

    @F.pandas_udf(DoubleType())
    def run(dfs: pd.Series) -> pd.Series:
        known = np.unique(dfs[dfs > 0])
        values = dict(zip(known.tolist(), t_quantile(tail, known).tolist() if len(known) else []))
        return pd.Series([values.get(v) for v in dfs], dtype="float64")

    return run(df.cast("double"))
