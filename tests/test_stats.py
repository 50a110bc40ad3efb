"""Profiling, ranking, quantiles, normality: hand-made frames and numpy references."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkqc.operators import normality, profile, ranking


def long_df(spark, cols):
    rows = [(i, c, None if v is None else float(v)) for c, vals in cols.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k long, col string, v double")


def np_quantile(x, q):
    return float(np.quantile(np.asarray(x, dtype=float), q))


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = {"a": list(rng.normal(size=101)), "b": [1, 1, 1, 2, 2, 5, 9, 9], "c": [3.0], "d": [7, None, 1, None, 4]}
    df = long_df(spark, data)
    got = {r.col: r for r in profile.quantiles(df, (0.25, 0.5, 0.75), names=("q1", "q2", "q3")).collect()}
    for c, vals in data.items():
        x = [v for v in vals if v is not None]
        for nm, q in (("q1", .25), ("q2", .5), ("q3", .75)):
            assert got[c][nm] == pytest.approx(np_quantile(x, q), rel=1e-12, abs=1e-12), (c, nm)


def test_range_ranks_equal_window_ranks(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), rng.integers(0, 50, 500))]
    df = spark.createDataFrame(rows, "g long, v double").groupBy("g", "v").count()
    w = Window.partitionBy("g")
    by_window = df.select("g", "v", F.coalesce(F.sum("count").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"), F.sum("count").over(w).alias("n"))
    a = {(r.g, r.v): (r.b, r.n) for r in by_window.collect()}
    b = {(r.g, r.v): (r.cum_before, r.group_total) for r in ranking.cumulative_sums(df, ["g"], ["v"], "count").collect()}
    assert a == b


def test_running_max(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in zip(rng.permutation(200), rng.random(200))]
    df = spark.createDataFrame(rows, "a double, b double")
    w = {r.a: r.max_before for r in ranking.running_max_before(df, [], [F.desc("a")], "b").collect()}
    srt = sorted(rows, key=lambda t: -t[0])
    best = None
    for a, b in srt:
        assert w[a] == best
        best = b if best is None else max(best, b)


def test_moments_bias_corrections_and_constant(spark):
    x = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = long_df(spark, {"x": x, "const": [4, 4, 4, 4]})
    m = {r.col: r for r in profile.moments(df).collect()}
    n = len(x)
    a = np.asarray(x)
    m2, m3, m4 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean(), ((a - a.mean()) ** 4).mean()
    g1 = m3 / m2 ** 1.5
    g2 = m4 / m2 ** 2 - 3
    assert m["x"].skew == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))
    assert m["x"].kurt == pytest.approx(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))
    assert m["const"].skew == 0.0 and m["const"].kurt == 0.0  # pandas rule, no ANSI error


def ad_reference(x):
    """Anderson-Darling A^2 against a normal with fitted mean and ddof-1 std (exact erfc)."""
    x = np.sort(np.asarray(x, dtype=float))
    n = len(x)
    w = (x - x.mean()) / x.std(ddof=1)
    cdf = np.array([0.5 * math.erfc(-t / math.sqrt(2)) for t in w])
    sf = np.array([0.5 * math.erfc(t / math.sqrt(2)) for t in w])
    i = np.arange(1, n + 1)
    return -n - np.sum((2 * i - 1) / n * (np.log(cdf) + np.log(sf[::-1])))


def test_anderson_matches_reference_formula(spark):
    rng = np.random.default_rng(4)
    data = {"norm": list(rng.normal(size=300)), "expo": list(np.exp(rng.normal(size=300) * 2)),
            "ties": [1, 1, 2, 2, 2, 3, 4, 4, 5, 9] * 5, "const": [2.0] * 20}
    got = {r.col: r for r in normality.anderson_normal(long_df(spark, data)).collect()}
    for c in ("norm", "expo", "ties"):
        assert got[c].a2 == pytest.approx(ad_reference(data[c]), rel=1e-5)
    n = 300
    assert got["norm"].crit == round(0.787 / (1 + 4 / n - 25 / n / n), 3)
    assert got["norm"].is_normal and not got["expo"].is_normal
    assert got["const"].a2 is None and got["const"].is_normal  # constant column counts as normal


def test_missing_profile_and_rows(spark):
    df = long_df(spark, {"a": [1, None, 3], "b": [None, None, 1]})
    p = {r.col: (r.n_missing, r.prop_missing) for r in profile.missing_profile(df).collect()}
    assert p == {"a": (1, pytest.approx(1 / 3)), "b": (2, pytest.approx(2 / 3))}
    rows = {r.k: r.n_missing for r in profile.rows_with_missing(df, "k").collect()}
    assert rows == {0: 1, 1: 2}


def test_class_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 37 else 0) for i in range(837)], "k int, y int")
    w = {r.y: r.weight for r in profile.class_counts(df, "y").collect()}
    assert w[1] == pytest.approx(837 / (2 * 37)) and w[0] == pytest.approx(837 / (2 * 800))


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(9)
    x = list(rng.normal(size=2000))
    df = long_df(spark, {"a": x})
    a = profile.approx_quantiles(df, (0.25, 0.5, 0.75), names=("q1", "q2", "q3")).first()
    for nm, q in (("q1", .25), ("q2", .5), ("q3", .75)):
        assert abs(a[nm] - np_quantile(x, q)) < 0.01


def test_all_null_column_keeps_a_row(spark):
    df = long_df(spark, {"a": [1, 2, 3, 4], "empty": [None, None, None]})
    q = {r.col: r for r in profile.quantiles(df, (0.5,), names=("med",)).collect()}
    assert q["a"].med == 2.5 and q["empty"].med is None and q["empty"].n == 0
    ad = {r.col: r for r in normality.anderson_normal(df).collect()}
    assert ad["empty"].a2 is None and ad["a"].n == 4
