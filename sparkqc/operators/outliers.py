"""Outlier bounds, reports and capping.

Fit tables are tiny (one row per column); they are joined to the long shape
(Spark broadcasts them by measured size under AQE) or turned into literals for
a single wide ``select`` with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.operators.profile import moments, per_column, quantiles


def iqr_bounds(long: DataFrame, fold: float = 1.5, col: str = "col", value: str = "v") -> DataFrame:
    """O1: ``(col, lower, upper)`` = Q1 - fold*IQR, Q3 + fold*IQR (linear quantiles)."""
    q = quantiles(long, (0.25, 0.75), col, value, names=("q1", "q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select(col, (F.col("q1") - F.lit(fold) * iqr).alias("lower"), (F.col("q3") + F.lit(fold) * iqr).alias("upper"))


def gaussian_bounds(long: DataFrame, fold: float = 3.0, ddof: int = 0, col: str = "col", value: str = "v") -> DataFrame:
    """O2 (ddof=0, population std) and the capper's fit (ddof=1): mean -/+ fold*std."""
    m = moments(long, col, value)
    sd = F.col("std_pop") if ddof == 0 else F.col("std_samp")
    return m.select(col, (F.col("mean") - F.lit(fold) * sd).alias("lower"), (F.col("mean") + F.lit(fold) * sd).alias("upper"))


def outlier_report(long: DataFrame, bounds: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """O3: ``(col, n_outliers, prop_outliers)``; strict comparisons, proportion rounded half-even to 4."""
    v = F.col(value)
    j = long.join(per_column(bounds), col)
    is_out = (v < F.col("lower")) | (v > F.col("upper"))
    return j.groupBy(col).agg(
        F.count_if(is_out).alias("n_outliers"),
        F.bround(F.count_if(is_out) / F.count(F.lit(1)), 4).alias("prop_outliers"),
    )


def fit_capper(long: DataFrame, method: str, fold: float | None = None, col: str = "col", value: str = "v") -> DataFrame:
    """O4 fit: 'iqr' (fold 1.5) or 'gaussian' (fold 3, *sample* std) bounds per column."""
    if method == "iqr":
        return iqr_bounds(long, 1.5 if fold is None else fold, col, value)
    if method == "gaussian":
        return gaussian_bounds(long, 3.0 if fold is None else fold, ddof=1, col=col, value=value)
    raise ValueError(f"unknown capping method {method!r}")


def capped(v, lo, hi):
    """Winsorise with a NULL guard (least/greatest skip NULLs in Spark)."""
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(v, lo), hi))


def cap_long(long: DataFrame, fit: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """O4 apply on long: columns without a fit row pass unchanged."""
    j = long.join(per_column(fit.select(col, F.col("lower").alias("_lo"), F.col("upper").alias("_hi"))), col, "left")
    out = F.when(F.col("_lo").isNull(), F.col(value)).otherwise(capped(F.col(value), F.col("_lo"), F.col("_hi")))
    return j.withColumn(value, out).drop("_lo", "_hi")


def cap_wide(df: DataFrame, fit_rows: dict[str, tuple[float, float]]) -> DataFrame:
    """O4 apply on wide: one projection, no shuffle. ``fit_rows`` = {col: (lower, upper)}."""
    cols = []
    for c in df.columns:
        if c in fit_rows:
            lo, hi = fit_rows[c]
            cols.append(capped(F.col(c), F.lit(float(lo)), F.lit(float(hi))).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def collect_fit(fit: DataFrame, col: str = "col") -> dict[str, tuple[float, float]]:
    """Fit tables have one row per column (bounded by the schema width)."""
    return {str(r[col]): (r["lower"], r["upper"]) for r in fit.collect()}
