"""Projections, constant columns, ANOVA ranking and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.operators.profile import keys, per_column

# Model families that are fed scaled features (all others get raw values).
SCALED_FAMILIES = ("LogisticRegression", "LinearSVC", "KNeighborsClassifier", "MultilayerPerceptronClassifier")


# ------------------------------------------------------------------ P1 - P8

def drop_columns(df: DataFrame, cols: Sequence[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """Drop columns and return the ``(Columns_Removed, Reason)`` log."""
    log = df.sparkSession.createDataFrame([(c, reason) for c in cols], "Columns_Removed string, Reason string")
    return df.drop(*cols), log


def split_features_label(df: DataFrame, label: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """X / y projections; the key stays in both so they can be re-joined."""
    ks = [key] if key else []
    return df.drop(label), df.select(*ks, label)


def recode_label(df: DataFrame, label: str, old=-1, new=0) -> DataFrame:
    """replace(-1, 0) on the label."""
    return df.withColumn(label, F.when(F.col(label) == old, F.lit(new)).otherwise(F.col(label)))


def replay_drops(df: DataFrame, drop_log: DataFrame,
                 reasons: Sequence[str] = ("Irrelevant column", "More than 80% missing values")) -> DataFrame:
    """Drop the columns logged in training for the given reasons (log rows are schema-bounded)."""
    names = [r[0] for r in drop_log.where(F.col("Reason").isin(list(reasons))).select("Columns_Removed").collect()]
    return df.drop(*names)


def reorder_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P5: realign to a given order."""
    return df.select(*cols)


def choose_scaled(model_kind: str, scaled, raw):
    """Plan-time branch on model family (frames, or the names of scaled and raw columns)."""
    return scaled if model_kind in SCALED_FAMILIES else raw


def constant_columns(long: DataFrame, col="col", value: str = "v") -> DataFrame:
    """P8 fit: columns with a single distinct value, ``min <=> max`` (a cheap aggregate)."""
    k = keys(col)
    return long.groupBy(*k).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx")).where(
        F.col("_mn").eqNullSafe(F.col("_mx"))).select(*k)


def drop_constant_long(long: DataFrame, constants: DataFrame, col="col") -> DataFrame:
    """P8 apply on long: anti join with the (tiny) list."""
    return long.join(constants, keys(col), "left_anti")


# ---------------------------------------------------------------------- A9

def anova_f(long: DataFrame, label: str, col="col", value: str = "v") -> DataFrame:
    """One-way ANOVA F per column against the label: ``(col, f, df_between, df_within)``.

    Two-level aggregation: per (col, class) moments with map-side combine,
    then the closed form over the k class rows of each column.
    """
    k = keys(col)
    g = long.where(F.col(value).isNotNull()).groupBy(*k, label).agg(
        F.count(F.lit(1)).alias("n_g"), F.avg(value).alias("m_g"), F.var_pop(value).alias("v_g"))
    w = Window.partitionBy(*k)  # k classes per column
    g = g.withColumn("_N", F.sum("n_g").over(w)).withColumn("_grand", F.sum(F.col("n_g") * F.col("m_g")).over(w) / F.col("_N"))
    agg = g.groupBy(*k).agg(
        F.first("_N").alias("N"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n_g") * (F.col("m_g") - F.col("_grand")) * (F.col("m_g") - F.col("_grand"))).alias("ssb"),
        F.sum(F.col("n_g") * F.col("v_g")).alias("ssw"))
    dfb = F.col("k") - 1
    dfw = F.col("N") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("ssb"), dfb), F.when(F.col("ssw") > 0, F.try_divide(F.col("ssw"), dfw)))
    return agg.select(*k, f.alias("f"), dfb.alias("df_between"), dfw.alias("df_within"))


def select_k_best(anova: DataFrame, k: int, col: str = "col") -> DataFrame:
    """the k columns with the largest F (ties by column id); Spark runs this as a
    bounded top-k (TakeOrderedAndProject), never a global sort."""
    return anova.where(F.col("f").isNotNull()).orderBy(F.desc("f"), F.asc(col)).limit(k)


def ranked_features(anova: DataFrame, col: str = "col") -> list:
    """Rank once, take prefixes: one ordered column list (schema-bounded) for all k."""
    return [r[col] for r in anova.where(F.col("f").isNotNull()).orderBy(F.desc("f"), F.asc(col)).select(col).collect()]


# ----------------------------------------------------------------- F1 - F3

def fit_standardiser(long: DataFrame, col="col", value: str = "v") -> DataFrame:
    """F1 fit: mean and population std; a zero std is replaced by 1."""
    k = keys(col)
    return long.groupBy(*k).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("_sd")).select(
        *k, "mean", F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0)).alias("scale"))


def fit_minmax(long: DataFrame, col="col", value: str = "v") -> DataFrame:
    """F2 fit: ``(col, mean=min, scale=max-min)`` with a zero range replaced by 1."""
    k = keys(col)
    return long.groupBy(*k).agg(F.min(value).alias("mean"), (F.max(value) - F.min(value)).alias("_r")).select(
        *k, "mean", F.when(F.col("_r") > 0, F.col("_r")).otherwise(F.lit(1.0)).alias("scale"))


def apply_affine_long(long: DataFrame, fit: DataFrame, col="col", value: str = "v") -> DataFrame:
    """(v - mean) / scale with the per-column fit joined (tiny side); unfitted columns unchanged."""
    k = keys(col)
    j = long.join(per_column(fit.select(*k, F.col("mean").alias("_m"), F.col("scale").alias("_s"))), k, "left")
    return j.withColumn(value, F.when(F.col("_m").isNull(), F.col(value)).otherwise((F.col(value) - F.col("_m")) / F.col("_s"))).drop("_m", "_s")


def fit_scale_split(long: DataFrame, normal_cols: Sequence, col="col", value: str = "v") -> DataFrame:
    """F3 fit: standardiser on normal columns, min-max on the rest, as one fit table."""
    k = keys(col)
    is_normal = F.col(k[0]).isin(list(normal_cols))
    std = fit_standardiser(long.where(is_normal), col, value).withColumn("scaler", F.lit("standard"))
    mm = fit_minmax(long.where(~is_normal), col, value).withColumn("scaler", F.lit("minmax"))
    return std.unionByName(mm)


def affine(col: str, fit: dict[str, tuple[float, float]]) -> Column:
    """F1-F3 apply on wide: one column by its literal (mean, scale) pair."""
    return (F.col(col) - F.lit(float(fit[col][0]))) / F.lit(float(fit[col][1]))
