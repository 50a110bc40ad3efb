"""Normalising-transform search and replay.

The search ranks every column once. Moments of all candidates come from one
pass over the rows, their Anderson-Darling sums from one pass over the ranked
distinct values: a monotone candidate keeps or reverses the order. Only squares
of columns with both signs are ranked anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkqc.functions.stats import ad_critical, log_norm_cdf, log_norm_sf, unbiased_kurt, unbiased_skew
from sparkqc.functions.transforms import TRANSFORM_TYPES, apply_named, yeo_johnson_t
from sparkqc.operators.profile import keys, per_column, ranked_values, small_table
from sparkqc.operators.ranking import cumulative_sums
from sparkqc.session import spread


def _yj_llf_by_grid(long: DataFrame, k: list[str], value: str, lam_col) -> DataFrame:
    """log-likelihood of Yeo-Johnson for every (col, lam) row produced by ``lam_col``."""
    v = F.col(value)
    ex = long.where(v.isNotNull()).select(*k, v.alias("_x"), F.explode(lam_col).alias("lam"))
    t = yeo_johnson_t(F.col("_x"), F.col("lam"))
    g = ex.groupBy(*k, "lam").agg(
        F.count(F.lit(1)).alias("_n"), F.var_pop(t).alias("_var"),
        F.sum(F.signum("_x") * F.log1p(F.abs("_x"))).alias("_slog"))
    llf = -F.col("_n") / 2 * F.log(F.col("_var")) + (F.col("lam") - 1) * F.col("_slog")
    return g.withColumn("llf", F.when(F.col("_var") > 0, llf))


def fit_yeo_johnson(long: DataFrame, col="col", value: str = "v",
                    start: float = -4.0, stop: float = 4.0, step: float = 0.25, refinements: int = 2,
                    points: int = 10) -> DataFrame:
    """T5 fit: ``(col, lam)`` maximising the Yeo-Johnson profile log-likelihood.

    A coarse grid for all columns in one pass, then ``refinements`` passes of a
    10x finer grid around each column's best value (one scan each).
    """
    k = keys(col)
    long = spread(long.select(*k, value))
    n_steps = int(round((stop - start) / step))
    grid = F.array(*[F.lit(start + i * step) for i in range(n_steps + 1)])
    best = small_table(_yj_llf_by_grid(long, k, value, grid).groupBy(*k)
                       .agg(F.max_by("lam", F.struct(F.col("llf").isNotNull(), F.col("llf"), -F.abs("lam"))).alias("lam")))
    for _ in range(refinements):
        fine = step / points
        local = F.transform(F.sequence(F.lit(-points), F.lit(points)), lambda i: F.col("_best") + i.cast("double") * F.lit(fine))
        cand = long.join(per_column(best.withColumnRenamed("lam", "_best")), k)
        best = small_table(_yj_llf_by_grid(cand, k, value, local).groupBy(*k)
                           .agg(F.max_by("lam", F.struct(F.col("llf").isNotNull(), F.col("llf"), -F.abs("lam"))).alias("lam")))
        step = fine
    return best


def score_transforms(train: DataFrame, test: DataFrame | None = None, col="col", value: str = "v",
                     types: Sequence[str] = TRANSFORM_TYPES, yj: DataFrame | None = None) -> DataFrame:
    """``(col, type, n, a2, crit, skew, kurt)`` for every non-raising candidate.

    A candidate is skipped (no row) when it would raise on train *or* test:
    logarithmic with a value <= 0, reciprocal with a 0. Square root of a
    negative yields a row whose a2 is NULL (never selected).
    """
    k = keys(col)
    v = F.col(value)
    train = spread(train.select(*k, value))
    sides = train.select(*k, v.alias(value), F.lit(True).alias("_train"))
    if test is not None:
        sides = sides.unionByName(test.select(*k, v.alias(value), F.lit(False).alias("_train")))
    own = F.when(F.col("_train"), v)
    gate = small_table(sides.groupBy(*k).agg(
        F.min(value).alias("_min"), F.count_if(v == 0).alias("_zeros"), F.min(own).alias("_least"), F.max(own).alias("_most"),
        F.count_if(own < 0).alias("_n_neg"), F.count_if(own > 0).alias("_n_pos")))
    lam = None
    if "yeo-johnson" in types:
        yj = small_table(yj if yj is not None else fit_yeo_johnson(train, k, value))
        train = train.join(per_column(yj.withColumnRenamed("lam", "_lam")), k, "left")
        lam = F.col("_lam")
    # statistics of every candidate in one pass over the rows
    t_of = {t: apply_named(t, v, lam) for t in types}
    stats = small_table(train.groupBy(*k).agg(*[a for t, x in t_of.items() for a in (
        F.count(x).alias(f"n_{t}"), F.avg(x).alias(f"mean_{t}"), F.stddev_samp(x).alias(f"sd_{t}"), F.var_pop(x).alias(f"var_{t}"),
        F.skewness(x).alias(f"g1_{t}"), F.kurtosis(x).alias(f"g2_{t}"))]).join(per_column(gate), k))
    # the values are ranked once; a monotone candidate keeps or reverses that order
    ranked = ranked_values(train.drop("_lam"), k, value).join(per_column(stats), k).where(v.isNotNull())
    if lam is not None:
        ranked = ranked.join(per_column(yj.withColumnRenamed("lam", "_lam")), k, "left")
    mixed = (F.col("_least") < 0) & (F.col("_most") > 0)
    before, after = F.col("cum_before"), F.col("n") - F.col("cum_before") - F.col("c")
    # reciprocals: negative values first, each sign in reversed order
    flipped = F.when(v < 0, F.col("_n_neg") - before - F.col("c")).otherwise(F.col("_n_neg") + after)
    place = {"reciprocal": flipped, "square": F.when(F.col("_most") <= 0, after).otherwise(before)}
    scored = ranked.withColumns({f"z_{t}": _z(t_of[t], t) for t in types})  # columns of their own: a term names its z fifty times
    sums = scored.groupBy(*k).agg(*[F.sum(_ad_term(t, place.get(t, before), F.col("c"))).alias(f"s_{t}") for t in types])
    if "square" in types:  # squares of both signs interleave: rank them anew
        both = ranked.where(mixed).groupBy(*k, (v * v).alias("_sq")).agg(F.sum("c").alias("c"), F.first("n_square").alias("n_square"),
                                                                        F.first("mean_square").alias("mean_square"), F.first("sd_square").alias("sd_square"))
        again = cumulative_sums(both, k, ["_sq"], weight="c").withColumn("z_square", _z(F.col("_sq"), "square")).groupBy(*k).agg(
            F.sum(_ad_term("square", F.col("cum_before"), F.col("c"))).alias("_s_sq"))
        sums = sums.join(again, k, "left").withColumn("s_square", F.coalesce("_s_sq", "s_square")).drop("_s_sq")
    wide = stats.join(per_column(sums), k, "left")
    nn = lambda t: F.when(F.col(f"n_{t}") > 0, F.col(f"n_{t}").cast("double"))
    raises = {"logarithmic": F.col("_min") <= 0, "reciprocal": F.col("_zeros") > 0}
    rows = [F.struct(
        F.lit(t).alias("type"), F.col(f"n_{t}").alias("n"),
        F.when(F.lit(t != "square-root") | (F.col("_n_neg") == 0), -nn(t) - F.col(f"s_{t}") / nn(t)).alias("a2"), ad_critical(F.col(f"n_{t}")).alias("crit"),
        unbiased_skew(F.col(f"n_{t}"), F.col(f"g1_{t}"), F.col(f"var_{t}")).alias("skew"), unbiased_kurt(F.col(f"n_{t}"), F.col(f"g2_{t}"), F.col(f"var_{t}")).alias("kurt"),
        F.coalesce(~raises.get(t, F.lit(False)), F.lit(True)).alias("ok")) for t in types]
    return wide.select(*k, F.explode(F.array(*rows)).alias("r")).where("r.ok").select(*k, "r.type", "r.n", "r.a2", "r.crit", "r.skew", "r.kurt")


def _z(value: Column, kind: str) -> Column:
    """A candidate's value in deviations from its mean."""
    return (value - F.col(f"mean_{kind}")) / F.when(F.col(f"sd_{kind}") > 0, F.col(f"sd_{kind}"))


def _ad_term(kind: str, before: Column, count: Column) -> Column:
    """A value's part of the Anderson-Darling sum of one candidate, from its column ``z_``."""
    n, lo = F.col(f"n_{kind}").cast("double"), before.cast("double")
    hi = lo + count.cast("double")
    z = F.col(f"z_{kind}")
    return (hi * hi - lo * lo) * log_norm_cdf(z) + ((n - lo) * (n - lo) - (n - hi) * (n - hi)) * log_norm_sf(z)


def pick_transform(scores: DataFrame, col="col", rule: str = "alphabetical") -> DataFrame:
    """Per column, among candidates with a2 < crit.

    ``alphabetical`` reproduces the reference (min of each field on its own:
    first type name, smallest statistic); ``best`` takes the type of the
    smallest statistic.
    """
    k = keys(col)
    ok = scores.where(F.col("a2") < F.col("crit"))
    if rule == "alphabetical":
        return ok.groupBy(*k).agg(F.min("type").alias("type"), F.min("a2").alias("a2"))
    if rule == "best":
        return ok.groupBy(*k).agg(F.min_by("type", F.struct("a2", "type")).alias("type"), F.min("a2").alias("a2"))
    raise ValueError(rule)


def apply_transforms_long(long: DataFrame, plan: DataFrame, col="col", value: str = "v",
                          yj: DataFrame | None = None) -> DataFrame:
    """T8 on long: join the per-column plan (tiny) and transform; unlisted columns unchanged."""
    k = keys(col)
    p = plan.select(*k, F.col("type").alias("_type"))
    if yj is not None:
        p = p.join(yj.withColumnRenamed("lam", "_lam"), k, "left")
    else:
        p = p.withColumn("_lam", F.lit(None).cast("double"))
    j = long.join(per_column(p), k, "left")
    return j.withColumn(value, F.when(F.col("_type").isNull(), F.col(value))
                        .otherwise(apply_named(F.col("_type"), F.col(value), F.col("_lam")))).drop("_type", "_lam")


def apply_transforms_wide(df: DataFrame, plan: dict[str, tuple[str, float | None]]) -> DataFrame:
    """T8 on wide: one projection; ``plan`` = {column: (type, lam)} from the fit table."""
    out = []
    for c in df.columns:
        if c in plan:
            t, lam = plan[c]
            out.append(apply_named(t, F.col(c), F.lit(lam) if lam is not None else None).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
