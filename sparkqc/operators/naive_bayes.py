"""Gaussian naive Bayes as relational operators.

Fit is one aggregation by (class, column); scoring joins the per-column model
(#columns x #classes rows, schema-bounded) to the long rows and sums log
densities per (row, class). ``var_smoothing`` adds ``smoothing * max column
variance`` to every variance, which Spark ML's NaiveBayes does not offer.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fit_gaussian_nb(long: DataFrame, label: str = "y", col: str = "col", value: str = "v", key: str = "key",
                    var_smoothing: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """Returns ``(model (col, class, theta, var), priors (class, log_prior))``."""
    max_var = long.groupBy(col).agg(F.var_pop(value).alias("_v")).agg(F.max("_v")).first()[0] or 0.0  # one number
    per = long.groupBy(col, F.col(label).alias("class")).agg(F.avg(value).alias("theta"), F.var_pop(value).alias("_var"))
    model = per.select(col, "class", "theta", (F.col("_var") + F.lit(var_smoothing * max_var)).alias("var"))
    rows = long.select(key, label).distinct()
    pri = rows.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))  # one row per class
    priors = pri.select("class", F.log(F.col("_n") / total).alias("log_prior"))
    return model, priors


def score_gaussian_nb(long: DataFrame, model: DataFrame, priors: DataFrame, key: str = "key", col: str = "col",
                      value: str = "v") -> DataFrame:
    """``(key, pred, jll)``: argmax over classes of the joint log likelihood (ties to the smaller class)."""
    lp = -0.5 * F.log(F.lit(2 * math.pi) * F.col("var")) - 0.5 * (F.col(value) - F.col("theta")) ** 2 / F.col("var")
    # the model has one row per (column, class): bounded by the schema, safe to broadcast
    jll = (long.join(F.broadcast(model), col).groupBy(key, "class").agg(F.sum(lp).alias("_ll"))
           .join(priors, "class").withColumn("jll", F.col("_ll") + F.col("log_prior")))
    best = jll.groupBy(key).agg(F.max(F.struct(F.col("jll").alias("jll"), (-F.col("class")).alias("nc"))).alias("_b"))
    return best.select(key, (-F.col("_b")["nc"]).alias("pred"), F.col("_b")["jll"].alias("jll"))
