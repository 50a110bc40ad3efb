"""Column expressions for statistics that Spark has no built-in for.

Everything here returns a ``pyspark.sql.Column`` so it stays inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational Chebyshev erfc approximation
# (Numerical Recipes "erfcc", relative error < 1.2e-7), lowest order first.
ERFC_COEFFS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)

# Anderson-Darling critical values for the normal case with
# estimated mean and variance, significance 15 %, 10 %, 5 %, 2.5 %, 1 %.
AD_NORMAL_CRITICAL = (0.576, 0.656, 0.787, 0.918, 1.092)
AD_5PCT_INDEX = 2

LN_HALF = math.log(0.5)
SQRT2 = math.sqrt(2.0)


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _erfc_poly(t: Column) -> Column:
    acc = _lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        acc = _lit(c) + t * acc
    return acc


def log_half_erfc(u: Column) -> Column:
    """ln(erfc(u) / 2), finite for large |u| (tail evaluated in log space)."""
    a = F.abs(u)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * a)
    log_tail = F.log(t) - a * a + _erfc_poly(t)  # ln(erfc(|u|))
    return F.when(u >= 0, F.lit(LN_HALF) + log_tail).otherwise(
        F.log(F.lit(1.0) - F.lit(0.5) * F.exp(log_tail))
    )


def log_norm_cdf(z: Column) -> Column:
    """ln Phi(z)."""
    return log_half_erfc(-z / F.lit(SQRT2))


def log_norm_sf(z: Column) -> Column:
    """ln(1 - Phi(z))."""
    return log_half_erfc(z / F.lit(SQRT2))


def ad_critical(n: Column, level_index: int = AD_5PCT_INDEX) -> Column:
    """Critical value of A^2 at the chosen level for sample size n."""
    nd = F.when(n > 0, n.cast("double"))  # no values: no critical value (and no ANSI division error)
    return F.round(_lit(AD_NORMAL_CRITICAL[level_index]) / (F.lit(1.0) + F.lit(4.0) / nd - F.lit(25.0) / (nd * nd)), 3)


def unbiased_skew(n: Column, g1: Column, var_pop: Column) -> Column:
    """Bias-corrected sample skewness G1 from Spark's population g1.

    0 for a constant column and NULL for fewer than 3 values (pandas rules).
    """
    nd = n.cast("double")
    corr = F.sqrt(nd * (nd - 1)) / (nd - 2)
    return F.when(nd < 3, F.lit(None).cast("double")).when(var_pop == 0, F.lit(0.0)).otherwise(g1 * corr)


def unbiased_kurt(n: Column, g2: Column, var_pop: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from Spark's population excess g2."""
    nd = n.cast("double")
    val = ((nd + 1) * g2 + 6) * (nd - 1) / ((nd - 2) * (nd - 3))
    return F.when(nd < 4, F.lit(None).cast("double")).when(var_pop == 0, F.lit(0.0)).otherwise(val)


def mcc_from_counts(tp: Column, tn: Column, fp: Column, fn: Column) -> Column:
    """Matthews correlation from confusion counts; 0 when any margin is 0."""
    tp, tn, fp, fn = (c.cast("double") for c in (tp, tn, fp, fn))
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return F.coalesce(F.try_divide(tp * tn - fp * fn, F.when(den > 0, den)), F.lit(0.0))


def round6(c: Column) -> Column:
    """Round to 6 decimals and fold -0.0 into 0.0 (report / oracle hygiene)."""
    return F.round(c, 6) + F.lit(0.0)
