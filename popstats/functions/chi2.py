"""Upper tail of the chi-square distribution, for p-values.

Spark SQL has no chi-square CDF, so the tail probability
``Q(dof/2, statistic/2)`` (regularised upper incomplete gamma function) is
computed by a vectorised pandas UDF.  It only ever runs on the final,
already aggregated statistics (one row per test), never on input rows.
Series for x < a + 1, continued fraction (modified Lentz) otherwise.  Either
needs some multiple of sqrt(a) terms; where the sum has not converged within
that many (or within ``_MOST_TERMS``), the p-value is NULL, never a partial sum.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300
_MOST_TERMS = 5_000_000


def _terms(a: float) -> int:
    return min(_MOST_TERMS, 1000 + int(20 * math.sqrt(a)))


def _upper_gamma_q(a: float, x: float) -> float:
    if not (a > 0) or not (x >= 0) or math.isnan(x):
        return float("nan")
    if x == 0:
        return 1.0
    log_front = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(_terms(a)):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        else:
            return float("nan")
        return max(0.0, 1.0 - total * math.exp(log_front))
    b = x + 1 - a
    c = 1 / _TINY
    d = 1 / b
    h = d
    for i in range(1, _terms(a)):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < _EPS:
            break
    else:
        return float("nan")
    return min(1.0, math.exp(log_front) * h)


def chi2_sf(statistic: float, dof: float) -> float:
    """P(X >= statistic) for X ~ chi-square with ``dof`` degrees of freedom."""
    if statistic is None or dof is None or dof <= 0:
        return float("nan")
    return _upper_gamma_q(dof / 2.0, statistic / 2.0)


@F.pandas_udf(DoubleType())
def _chi2_sf_udf(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    out = np.empty(len(statistic))
    for i, (s, d) in enumerate(zip(statistic, dof)):
        out[i] = np.nan if (pd.isna(s) or pd.isna(d)) else chi2_sf(float(s), float(d))
    return pd.Series(out)


def chi2_p_value(statistic: Column, dof: Column) -> Column:
    """Column expression: p-value of a chi-square statistic (NULL when undefined)."""
    p = _chi2_sf_udf(statistic.cast("double"), dof.cast("double"))
    return F.when(F.isnan(p), F.lit(None).cast("double")).otherwise(p)
