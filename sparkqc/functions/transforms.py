"""Normalising transforms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candidate transform names, in the order they are tried.
TRANSFORM_TYPES = ("logarithmic", "reciprocal", "square-root", "yeo-johnson", "square")


def log_t(v: Column) -> Column:
    """Natural log (only applied to columns whose values are all > 0)."""
    return F.when(v > 0, F.log(v))


def reciprocal_t(v: Column) -> Column:
    """1/x (only applied to columns without zeros)."""
    return F.try_divide(F.lit(1.0), v)


def sqrt_t(v: Column) -> Column:
    """x^0.5; a negative gives NULL here, which disqualifies the column."""
    return F.when(v >= 0, F.sqrt(v))


def square_t(v: Column) -> Column:
    """T4: x^2."""
    return v * v


def yeo_johnson_t(v: Column, lam) -> Column:
    """T5: Yeo-Johnson with parameter ``lam`` (float or Column)."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(v)).otherwise((F.pow(v + 1, lam) - 1) / lam)
    two = F.lit(2.0) - lam
    neg = F.when(F.abs(two) < 1e-12, -F.log1p(-v)).otherwise(-(F.pow(-v + 1, two) - 1) / two)
    return F.when(v.isNull(), F.lit(None).cast("double")).when(v >= 0, pos).otherwise(neg)


def apply_named(kind: Column | str, v: Column, lam: Column | None = None) -> Column:
    """Dispatch on a transform name held in a column (or a literal name, of which only its own transform is built)."""
    lam = lam if lam is not None else F.lit(None).cast("double")
    if isinstance(kind, str):
        named = {"logarithmic": log_t, "reciprocal": reciprocal_t, "square-root": sqrt_t, "yeo-johnson": lambda x: yeo_johnson_t(x, lam), "square": square_t}
        return named.get(kind, lambda x: x)(v)
    return (F.when(kind == "logarithmic", log_t(v))
            .when(kind == "reciprocal", reciprocal_t(v))
            .when(kind == "square-root", sqrt_t(v))
            .when(kind == "yeo-johnson", yeo_johnson_t(v, lam))
            .when(kind == "square", square_t(v))
            .otherwise(v))
