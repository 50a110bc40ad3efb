"""Outliers, imputation plan, transforms, constant columns (traps of SURVEY 4.3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.operators import features, missing, outliers
from sparkqc.operators import transforms as tops


def long_df(spark, cols):
    rows = [(i, c, None if v is None else float(v)) for c, vals in cols.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k long, col string, v double")


def test_capper_keeps_nulls_and_is_idempotent(spark):
    df = long_df(spark, {"a": [1, 2, 3, 4, 100, None], "b": [5, 5, 5, 5, 5, 50]})
    fit = outliers.fit_capper(df, "iqr")
    capped = outliers.cap_long(df, fit)
    got = {(r.col, r.k): r.v for r in capped.collect()}
    assert got[("a", 5)] is None  # NULL is not capped to a bound
    q1, q3 = np.quantile([1, 2, 3, 4, 100], [.25, .75])
    assert got[("a", 4)] == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert got[("b", 5)] == 5.0  # IQR 0 with one spike: becomes constant
    twice = outliers.cap_long(capped, fit)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, capped.collect()))
    const = [r.col for r in features.constant_columns(capped).collect()]
    assert const == ["b"]  # P8 after O4


def test_gaussian_bounds_population_vs_capper_sample(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0]
    df = long_df(spark, {"x": x})
    b = outliers.gaussian_bounds(df).first()
    c = outliers.fit_capper(df, "gaussian").first()
    assert b.upper == pytest.approx(3 + 3 * np.std(x))
    assert c.upper == pytest.approx(3 + 3 * np.std(x, ddof=1))


def test_outlier_report_strict_and_rounded(spark):
    df = long_df(spark, {"a": [0, 1, 2, 3, 10]})
    bounds = spark.createDataFrame([("a", 0.0, 3.0)], "col string, lower double, upper double")
    r = outliers.outlier_report(df, bounds).first()
    assert r.n_outliers == 1 and r.prop_outliers == 0.2


def test_impute_plan_branches(spark):
    n = 100
    rng = np.random.default_rng(0)
    cols = {
        "co1": [None if i % 9 == 0 else float(rng.normal()) for i in range(n)],
        "co2": [None if i % 9 == 0 else float(rng.normal()) for i in range(n)],
        "mostly": [None if i % 10 < 9 else float(rng.normal()) for i in range(n)],
        "sym": [None if i % 11 == 3 else float(v) for i, v in enumerate(rng.normal(size=n))],
        "skewed": [None if i % 13 == 5 else float(math.exp(3 * v)) for i, v in enumerate(rng.normal(size=n))],
        "full": list(rng.normal(size=n)),
    }
    plan = {r.col: r.strategy for r in missing.impute_plan(long_df(spark, cols), "k").collect()}
    assert plan == {"co1": "iterative", "co2": "iterative", "mostly": "drop", "sym": "mean", "skewed": "median"}


def test_impute_plan_follows_the_order_of_the_columns(spark):
    """Sensor2 (85 % missing) goes before Sensor10 (75 % missing, within it) is looked at, though "Sensor10" < "Sensor2"."""
    v = np.random.default_rng(1).normal(size=200)
    cols = {"Sensor2": [None if i % 20 < 17 else float(x) for i, x in enumerate(v)], "Sensor10": [None if i % 20 < 15 else float(i % 20) for i, x in enumerate(v)], "Sensor11": list(map(float, v))}
    plan = lambda order: {r.col: r.strategy for r in missing.impute_plan(long_df(spark, cols), "k", order=order).collect()}
    assert plan(["Sensor2", "Sensor10", "Sensor11"]) == {"Sensor2": "drop", "Sensor10": "mean"}
    assert plan(["Sensor10", "Sensor2", "Sensor11"]) == {"Sensor2": "drop", "Sensor10": "iterative"}


def test_missingness_corr_against_numpy(spark):
    n = 60
    a = [None if i % 3 == 0 else 1.0 for i in range(n)]
    b = [None if i % 3 == 0 or i % 5 == 0 else 1.0 for i in range(n)]
    c = [None if i % 7 == 0 else 1.0 for i in range(n)]
    df = long_df(spark, {"a": a, "b": b, "c": c})
    got = {(r.col_a, r.col_b): r.r for r in missing.missingness_corr(df, "k").collect()}
    m = np.array([[v is None for v in x] for x in (a, b, c)], dtype=float)
    ref = np.corrcoef(m)
    names = ["a", "b", "c"]
    for i in range(3):
        for j in range(3):
            assert got[(names[i], names[j])] == pytest.approx(ref[i, j])



def test_missingness_corr_many_holes_per_row(spark):
    """Rows with up to ten NULL cells: every pair, both orders and the diagonal."""
    rng = np.random.default_rng(7)
    names = [f"c{i}" for i in range(10)]
    mask = rng.random((10, 200)) < np.linspace(0.1, 0.6, 10)[:, None]
    df = long_df(spark, {nm: [None if mask[i, r] else 1.0 for r in range(200)] for i, nm in enumerate(names)})
    got = {(r.col_a, r.col_b): r.r for r in missing.missingness_corr(df, "k").collect()}
    ref = np.corrcoef(mask.astype(float))
    assert len(got) == 100
    for i in range(10):
        for j in range(10):
            assert got[(names[i], names[j])] == pytest.approx(ref[i, j])

def test_transform_gating_on_train_and_test(spark):
    train = long_df(spark, {"pos": [1, 2, 3, 4, 5], "zero": [0, 1, 2, 3, 4], "neg": [-1, 1, 2, 3, 4],
                            "negtest": [1, 2, 3, 4, 5]})
    test = long_df(spark, {"pos": [1, 2], "zero": [1, 2], "neg": [1, 2], "negtest": [-3, 2]})
    s = tops.score_transforms(train, test, types=("logarithmic", "reciprocal", "square-root", "square"))
    got = {(r.col, r.type): r.a2 for r in s.collect()}
    assert ("zero", "logarithmic") not in got and ("zero", "reciprocal") not in got
    assert ("neg", "logarithmic") not in got and ("neg", "reciprocal") in got
    assert ("negtest", "logarithmic") not in got            # a negative only in test still disqualifies log
    assert got[("neg", "square-root")] is None              # NaN statistic: never selected
    assert ("pos", "logarithmic") in got and ("pos", "square") in got


def test_pick_transform_rules(spark):
    rows = [("c", "square", 0.2, 0.7), ("c", "logarithmic", 0.5, 0.7), ("c", "reciprocal", 0.9, 0.7)]
    s = spark.createDataFrame(rows, "col string, type string, a2 double, crit double")
    a = tops.pick_transform(s, "col", "alphabetical").first()
    b = tops.pick_transform(s, "col", "best").first()
    assert (a.type, a.a2) == ("logarithmic", 0.2)  # independent minima, as the reference does
    assert (b.type, b.a2) == ("square", 0.2)


def test_yeo_johnson_fit_matches_grid_maximum(spark):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(size=400)) - 0.5

    def yj(v, lam):
        out = np.empty_like(v)
        p = v >= 0
        out[p] = np.log1p(v[p]) if abs(lam) < 1e-12 else ((v[p] + 1) ** lam - 1) / lam
        out[~p] = -np.log1p(-v[~p]) if abs(lam - 2) < 1e-12 else -((-v[~p] + 1) ** (2 - lam) - 1) / (2 - lam)
        return out

    def llf(lam):
        return -len(x) / 2 * np.log(yj(x, lam).var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    grid = np.arange(-4, 4.0001, 0.0025)
    ref = grid[np.argmax([llf(g) for g in grid])]
    lam = tops.fit_yeo_johnson(long_df(spark, {"x": list(x)})).first().lam
    assert lam == pytest.approx(ref, abs=0.01)


def test_apply_transforms_wide_and_long_agree(spark):
    df = spark.createDataFrame([(1, 4.0, 9.0), (2, 16.0, 25.0)], "k long, a double, b double")
    plan = {"a": ("square-root", None)}
    wide = {r.k: (r.a, r.b) for r in tops.apply_transforms_wide(df, plan).collect()}
    assert wide == {1: (2.0, 9.0), 2: (4.0, 25.0)}
    lg = long_df(spark, {"a": [4.0, 16.0], "b": [9.0, 25.0]})
    p = spark.createDataFrame([("a", "square-root")], "col string, type string")
    got = {(r.col, r.k): r.v for r in tops.apply_transforms_long(lg, p).collect()}
    assert got[("a", 1)] == 4.0 and got[("b", 0)] == 9.0


def test_scalers(spark):
    lg = long_df(spark, {"a": [1, 2, 3], "c": [5, 5, 5]})
    std = {(r.col, r.k): r.v for r in features.apply_affine_long(lg, features.fit_standardiser(lg)).collect()}
    assert std[("a", 0)] == pytest.approx((1 - 2) / np.std([1, 2, 3]))
    assert std[("c", 1)] == 0.0  # zero std -> scale 1
    mm = {(r.col, r.k): r.v for r in features.apply_affine_long(lg, features.fit_minmax(lg)).collect()}
    assert mm[("a", 2)] == 1.0 and mm[("c", 0)] == 0.0


def test_anova_matches_closed_form(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 80)
    x = rng.normal(size=80) + y
    df = spark.createDataFrame([(i, int(a), "x", float(b)) for i, (a, b) in enumerate(zip(y, x))], "k long, y int, col string, v double")
    f = features.anova_f(df, "y").first().f
    g = [x[y == c] for c in (0, 1)]
    grand = x.mean()
    ssb = sum(len(a) * (a.mean() - grand) ** 2 for a in g)
    ssw = sum(((a - a.mean()) ** 2).sum() for a in g)
    assert f == pytest.approx((ssb / 1) / (ssw / (80 - 2)))
    assert F is not None


def test_missing_pairs_over_many_slices(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from sparkqc.operators import missing

    n = 100_000  # four slices of 32,768 rows
    lg = spark.range(n).select(F.col("id").alias("k"), F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.when(F.col("id") % d != 0, 1.0).alias("v")) for c, d in (("a", 2), ("b", 3), ("c", 7), ("d", n + 1))])).alias("x"))
    lg = lg.select("k", "x.*")
    i = np.arange(n)
    want = np.corrcoef([i % 2 == 0, i % 3 == 0, i % 7 == 0, i == 0])
    for slot in ("k", None):
        got = {(r.col_a, r.col_b): r.r for r in missing.missingness_corr(lg, "k", slot=slot).collect()}
        assert len(got) == 16 and all(abs(got["abcd"[a], "abcd"[b]] - want[a, b]) < 1e-9 for a in range(4) for b in range(4))
