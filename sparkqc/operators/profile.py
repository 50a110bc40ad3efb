"""Column profiling on the long shape ``(ids..., col, v)``.

Every function is a partial (map-side combined) aggregation keyed by the
column id, so a column holding a third of all cells still only ships one small
buffer per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.functions.stats import unbiased_kurt, unbiased_skew
from sparkqc.operators.ranking import cumulative_sums


def keys(col) -> list[str]:
    """A column id may be one name or several (e.g. column and candidate transform)."""
    return [col] if isinstance(col, str) else list(col)


def missing_profile(long: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """A1: ``(col, n_missing, prop_missing)``."""
    return long.groupBy(*keys(col)).agg(
        F.count_if(F.col(value).isNull()).alias("n_missing"),
        (F.count_if(F.col(value).isNull()) / F.count(F.lit(1))).alias("prop_missing"),
    )


def rows_with_missing(long: DataFrame, key: str, col: str = "col", value: str = "v") -> DataFrame:
    """Keys of rows with at least one NULL feature, with how many."""
    return (long.groupBy(key).agg(F.count_if(F.col(value).isNull()).alias("n_missing"))
            .where(F.col("n_missing") > 0))


def rows_with_missing_wide(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """P7 on the wide shape: a plain filter, no shuffle."""
    from functools import reduce
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in features])
    return df.where(cond)


def moments(long: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """A3 (+A5, A6): n, mean, sample/population std, min, max, bias-corrected skew and kurtosis."""
    v = F.col(value)
    agg = long.groupBy(*keys(col)).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std_samp"),
        F.stddev_pop(v).alias("std_pop"),
        F.var_pop(v).alias("var_pop"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.skewness(v).alias("_g1"),
        F.kurtosis(v).alias("_g2"),
    )
    return (agg.withColumn("skew", unbiased_skew(F.col("n"), F.col("_g1"), F.col("var_pop")))
            .withColumn("kurt", unbiased_kurt(F.col("n"), F.col("_g2"), F.col("var_pop")))
            .drop("_g1", "_g2"))


def value_counts(long: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """Distinct (col, v) with multiplicity ``c``; collapses ties before any ranking.

    NULL cells form one row per column with ``c = 0``, so a column without any
    value still appears (with NULL statistics) and never counts as data.
    """
    return long.groupBy(*keys(col), value).agg(F.count(F.col(value)).alias("c"))


def ranked_values(long: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """``(col, v, c, cum_before, n)``: each distinct value with the number of smaller values
    (``n`` = non-NULL values of the column)."""
    return cumulative_sums(value_counts(long, col, value), keys(col), [F.asc_nulls_first(value)], weight="c",
                           out_before="cum_before", out_total="n")


def _qname(p: float) -> str:
    return "q" + ("%g" % (p * 100)).replace(".", "_")


def quantiles(long: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), col: str = "col", value: str = "v",
              names: Sequence[str] | None = None) -> DataFrame:
    """A4: exact linear-interpolation quantiles per column (pandas / numpy 'linear').

    Built on ranked distinct values, so no task ever holds a whole column.
    """
    names = list(names) if names else [_qname(p) for p in probs]
    r = ranked_values(long, col, value)
    nd = F.col("n").cast("double")
    aggs = []
    lo, hi = F.col("cum_before"), F.col("cum_before") + F.col("c")
    for p, nm in zip(probs, names):
        h = (nd - 1) * F.lit(float(p))
        k0 = F.floor(h)
        k1 = F.least(k0 + 1, F.col("n") - 1)
        aggs.append(F.max(F.when((lo <= k0) & (k0 < hi), F.col(value))).alias(f"_{nm}_a"))
        aggs.append(F.max(F.when((lo <= k1) & (k1 < hi), F.col(value))).alias(f"_{nm}_b"))
        aggs.append(F.first(h - k0).alias(f"_{nm}_t"))
    out = r.groupBy(*keys(col)).agg(F.first("n").alias("n"), *aggs)
    for nm in names:
        a, b, t = F.col(f"_{nm}_a"), F.col(f"_{nm}_b"), F.col(f"_{nm}_t")
        out = out.withColumn(nm, F.when(t == 0, a).otherwise(a + (b - a) * t)).drop(f"_{nm}_a", f"_{nm}_b", f"_{nm}_t")
    return out


def approx_quantiles(long: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), col: str = "col", value: str = "v",
                     names: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """A4 switch for very large data: bounded-memory sketch (``percentile_approx``)."""
    names = list(names) if names else [_qname(p) for p in probs]
    arr = F.percentile_approx(value, list(probs), accuracy).alias("_q")
    out = long.groupBy(*keys(col)).agg(F.count(value).alias("n"), arr)
    return out.select(*keys(col), "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)]).drop("_q")


def class_counts(df: DataFrame, label: str = "y") -> DataFrame:
    """Class frequency and the 'balanced' weight n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    from pyspark.sql import Window
    tot = Window.partitionBy(F.lit(0))  # k rows only: the number of classes
    return (counts.withColumn("n", F.sum("n_c").over(tot)).withColumn("k", F.count(F.lit(1)).over(tot))
            .withColumn("weight", F.col("n") / (F.col("k") * F.col("n_c"))).drop("k"))


def per_column(fit: DataFrame) -> DataFrame:
    """Broadcast a fit / statistics table keyed by column id.

    Its size is bounded by the schema (one row per column, or per column and
    candidate), never by the data, so broadcasting it is always safe and keeps
    the big long-shaped side from being shuffled or broadcast by a misestimate.
    """
    return F.broadcast(fit)


def small_table(df: DataFrame) -> DataFrame:
    """Materialise a schema-bounded result (one row per column or class) once, so
    plans that use it several times do not recompute its inputs."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
