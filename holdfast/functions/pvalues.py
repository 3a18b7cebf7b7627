"""p-values of the two drift tests: a few numbers per column, after Spark has done the counting.

Two-sample Kolmogorov-Smirnov: exact path count while both samples are small, else the
one-sample distribution at the effective size (Marsaglia, Tsang and Wang 2003; corrected limit
series after Vrbik 2018). Chi-square: finite sums for whole degrees of freedom.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Both samples up to this size: exact two-sample p-value (fixed value).
EXACT_UP_TO = 10_000
#: Largest matrix half-width used for the exact one-sample distribution.
MATRIX_UP_TO = 200


def ks_exact(d: float, n1: int, n2: int) -> float:
    """Chance that two samples of these sizes differ by d or more.

    Draws the pooled values one by one and follows how many came from the first sample. What
    steps over the bound is added up as it happens, so small chances keep their precision.
    """
    g = math.gcd(n1, n2)
    a, b = n1 // g, n2 // g
    # After i draws from the first and j from the second sample the gap is |i*b - j*a| / lcm.
    bound = round(d * a * b * g)
    if bound == 0:
        return 1.0
    total = n1 + n2
    inside, low, lost = np.ones(1), 0, 0.0
    for drawn in range(total):
        i = np.arange(low, low + len(inside))
        first = inside * (n1 - i) / (total - drawn)
        fresh = np.zeros(len(inside) + 1)
        fresh[1:] = first
        fresh[:-1] += inside - first
        step = drawn + 1
        # Rounding may leave a trace on counts that the second sample cannot reach.
        fresh[: max(0, step - n2 - low)] = 0.0
        keep_low = max(low, (step * a - bound) // (a + b) + 1)
        keep_high = min(low + len(inside), -((-(step * a + bound)) // (a + b)) - 1)
        if keep_high < keep_low:
            return 1.0
        cut, end = keep_low - low, keep_high - low + 1
        lost += fresh[:cut].sum() + fresh[end:].sum()
        inside, low = fresh[cut:end], keep_low
    return float(min(1.0, lost))


def _one_sample_cdf(n: int, d: float) -> float:
    """Exact chance that a one-sample statistic of size n stays below d, by a matrix power."""
    k = math.floor(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    rows, cols = np.indices((m, m))
    matrix = (rows - cols + 1 >= 0).astype(float)
    powers = h ** np.arange(1, m + 1)
    matrix[:, 0] -= powers
    matrix[-1, :] -= powers[::-1]
    matrix[-1, 0] += (2 * h - 1) ** m if 2 * h > 1 else 0.0
    gaps = rows - cols + 1
    logs = np.array([math.lgamma(x + 1) for x in range(m + 1)])
    matrix = np.where(gaps > 0, matrix * np.exp(-logs[np.clip(gaps, 0, m)]), matrix)
    result, result_log = np.eye(m), 0.0
    base, base_log, power = matrix, 0.0, n
    while power:
        if power & 1:
            result, result_log = result @ base, result_log + base_log
            top = np.abs(result).max()
            result, result_log = result / top, result_log + math.log(top)
        base, base_log = base @ base, 2 * base_log
        top = np.abs(base).max()
        base, base_log = base / top, base_log + math.log(top)
        power >>= 1
    centre = result[k - 1, k - 1]
    if centre <= 0.0:
        return 0.0
    log_p = math.log(centre) + result_log + math.lgamma(n + 1) - n * math.log(n)
    return min(1.0, math.exp(log_p))


def ks_limit(d: float, n: int) -> float:
    """Chance of a one-sample statistic of d or more at size n."""
    if d <= 0.0:
        return 1.0
    if d >= 1.0:
        return 0.0
    if math.floor(n * d) + 1 <= MATRIX_UP_TO and n * d * d < 7.0:
        return max(0.0, 1.0 - _one_sample_cdf(n, d))
    root = math.sqrt(n)
    z = d * root + 1.0 / (6.0 * root) + (d * root - 1.0) / (4.0 * n)
    if z < 0.3:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * z * z) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))


def ks_p_value(d: float, n1: int, n2: int) -> float:
    """p-value of a two-sample Kolmogorov-Smirnov statistic."""
    if max(n1, n2) <= EXACT_UP_TO:
        return ks_exact(d, n1, n2)
    return ks_limit(d, round(n1 * n2 / (n1 + n2)))


def chi2_p_value(x: float, dof: int) -> float:
    """Chance of a chi-square value of x or more."""
    if x <= 0.0:
        return 1.0
    half = x / 2.0
    if dof % 2 == 0:
        logs = [k * math.log(half) - math.lgamma(k + 1) - half for k in range(dof // 2)]
        head = 0.0
    else:
        steps = range(1, (dof - 1) // 2 + 1)
        logs = [(k - 0.5) * math.log(half) - math.lgamma(k + 0.5) - half for k in steps]
        head = math.erfc(math.sqrt(half))
    return min(1.0, head + math.fsum(math.exp(v) for v in logs))


@F.pandas_udf(T.DoubleType())
def ks_p_values(statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """p-value per compared column: a handful of rows, not data rows."""
    found = [
        None if pd.isna(d) else ks_p_value(float(d), int(a), int(b))
        for d, a, b in zip(statistic, n_ref, n_cur)
    ]
    return pd.Series(found, dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_p_values(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    """p-value per compared column: a handful of rows, not data rows."""
    found = [
        None if pd.isna(x) else chi2_p_value(float(x), int(k)) for x, k in zip(statistic, dof)
    ]
    return pd.Series(found, dtype="float64")


# Ship these functions with the task, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
