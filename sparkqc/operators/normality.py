"""Anderson-Darling normality test per column (A7) and the normal split.

A^2 needs the rank of every value. Ties are collapsed to (col, v, count), ranks
come from ``ranking.cumulative_sums`` (skew-safe), and for a distinct value with
cumulative counts lo < rank <= hi and z = (v - mean) / sd:

    A^2 = -n - (1/n) * sum_v [ (hi^2 - lo^2) ln Phi(z) + ((n - lo)^2 - (n - hi)^2) ln(1 - Phi(z)) ]

so the whole test is two aggregations and one ranking, with no sort of a
column inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.functions.stats import ad_critical, log_norm_cdf, log_norm_sf
from sparkqc.operators.profile import keys, per_column, ranked_values


def anderson_normal(long: DataFrame, col="col", value: str = "v") -> DataFrame:
    """``(col..., n, a2, crit, is_normal)``; mean and ddof-1 std fitted per column.

    A constant column has no defined statistic (a2 NULL) and counts as normal,
    like the reference where ``nan > crit`` is false.
    """
    k = keys(col)
    stats = long.groupBy(*k).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    sd = F.when(F.col("_sd") > 0, F.col("_sd"))
    r = ranked_values(long, k, value).join(per_column(stats), k).withColumn("_z", (F.col(value) - F.col("_mean")) / sd)  # a term names it fifty times
    z = F.col("_z")
    n = F.col("n").cast("double")
    lo = F.col("cum_before").cast("double")
    hi = lo + F.col("c").cast("double")
    term = (hi * hi - lo * lo) * log_norm_cdf(z) + ((n - lo) * (n - lo) - (n - hi) * (n - hi)) * log_norm_sf(z)
    out = r.groupBy(*k).agg(F.first("n").alias("n"), F.sum(term).alias("_s"))
    nn = F.when(F.col("n") > 0, F.col("n").cast("double"))
    a2 = -nn - F.col("_s") / nn
    return (out.withColumn("a2", a2).withColumn("crit", ad_critical(F.col("n")))
            .withColumn("is_normal", F.coalesce(~(F.col("a2") > F.col("crit")), F.lit(True)))
            .drop("_s"))


def normal_split(ad: DataFrame, col: str = "col") -> tuple[list, list]:
    """(normal, non-normal) column ids; one row per column (schema-bounded)."""
    rows = ad.select(col, "is_normal").collect()
    normal = sorted(r[col] for r in rows if r["is_normal"])
    other = sorted(r[col] for r in rows if not r["is_normal"])
    return normal, other
