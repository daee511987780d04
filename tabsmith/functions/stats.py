"""Test-statistic tails: Kolmogorov p-value and chi-square survival function.

Both run on tables of one row per feature, after the distributed work.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The chi-square UDF below runs in Python workers.  Pickling this module by value
# makes the UDF self-contained, so workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample KS p-value (Kolmogorov limit law).

    ``lam = D*sqrt(n*m/(n+m))``; ``p = 2*sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lam^2)``,
    clipped to [0, 1] and 1 for lam < 0.2 (the series is 1 to double
    precision there).  scipy switches to an exact law for samples up to 10,000;
    this engine always uses the limit law.
    """
    lam = d * F.sqrt((n * m).cast("double") / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


#: From here on the uniform expansion is exact to double precision.
LARGE_SHAPE = 1e4


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): uniform expansion for large ``a``,
    else series or continued fraction until they stop changing."""
    if x is None or a is None or math.isnan(x) or math.isnan(a):
        return float("nan")
    if x <= 0:
        return 1.0
    if a >= LARGE_SHAPE:
        return _gammaincc_large(a, x)
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, delta = a, 1.0 / a, 1.0 / a
        while abs(delta) >= abs(s) * 1e-16:
            ap += 1.0
            delta *= x / ap
            s += delta
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    i, change = 0, 0.0
    while abs(change - 1.0) >= 4e-16:
        i += 1
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        if abs(d) < tiny:
            d = tiny
        c = b + an / c
        if abs(c) < tiny:
            c = tiny
        d = 1.0 / d
        change = d * c
        h *= change
    return math.exp(-x + a * math.log(x) - gln) * h


def _gammaincc_large(a: float, x: float) -> float:
    """Temme's expansion: erfc of the scaled distance from the mean, and two correction terms."""
    mu = x / a - 1.0
    half = mu - math.log1p(mu) if abs(mu) > 1e-3 else mu * mu * (0.5 - mu * (1 / 3 - mu * (0.25 - mu * (0.2 - mu / 6))))
    eta = math.copysign(math.sqrt(2.0 * half), mu)
    if abs(eta) > 0.02:
        c0 = 1.0 / mu - 1.0 / eta
        c1 = 1.0 / eta ** 3 - 1.0 / mu ** 3 - 1.0 / mu ** 2 - 1.0 / (12.0 * mu)
    else:   # the same by their power series, where the quotients cancel
        c0 = -1 / 3 + eta * (1 / 12 + eta * (-2 / 135 + eta * (1 / 864 + eta / 2835)))
        c1 = -1 / 540 + eta * (-1 / 288 + eta / 378)
    power = -0.5 * a * eta * eta
    tail = math.exp(power) / math.sqrt(2.0 * math.pi * a) * (c0 + c1 / a) if power > -745 else 0.0
    return min(1.0, max(0.0, 0.5 * math.erfc(eta * math.sqrt(a / 2.0)) + tail))


@F.pandas_udf(DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Chi-square survival function Q(dof/2, stat/2); dof 0 gives p = 1."""
    out = np.empty(len(stat))
    for i, (x, k) in enumerate(zip(stat.to_numpy(dtype=float), dof.to_numpy(dtype=float))):
        if math.isnan(x) or math.isnan(k):
            out[i] = np.nan
        elif k <= 0:
            out[i] = 1.0
        else:
            out[i] = _gammaincc(k / 2.0, x / 2.0)
    return pd.Series(out)
