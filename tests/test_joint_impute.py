import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.operators.joint_impute import apply_joint, fill, fit_joint_imputer


def frame(spark, x, extra=""):
    names = ", ".join(f"f{j} double" for j in range(x.shape[1]))
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, f"id long, {names}").repartition(3)


def gappy(seed, n=300, p=6, share=0.2):
    rng = np.random.default_rng(seed)
    whole = rng.normal(size=(n, 3)) @ rng.normal(size=(3, p)) * 2 + rng.normal(size=(n, p)) * 0.3 + np.arange(p)
    x = whole.copy()
    x[rng.random((n, p)) < share] = np.nan
    return whole, x


def twin(x, rounds, prior):
    """Dense expectation and maximisation, row by row, from the covariance's side."""
    centre, scale = np.nanmean(x, 0), np.nanstd(x, 0)
    z, p = (x - centre) / scale, x.shape[1]
    mean, cov = np.zeros(p), np.eye(p)

    def expect():
        full, extra = z.copy(), np.zeros((p, p))
        for i, row in enumerate(z):
            m = np.isnan(row)
            slope = cov[np.ix_(m, ~m)] @ np.linalg.inv(cov[np.ix_(~m, ~m)])
            full[i, m] = mean[m] + slope @ (row[~m] - mean[~m])
            extra[np.ix_(m, m)] += cov[np.ix_(m, m)] - slope @ cov[np.ix_(~m, m)]
        return full, extra

    for _ in range(rounds):
        full, extra = expect()
        mean = full.mean(0)
        cov = ((full - mean).T @ (full - mean) + extra + prior * np.eye(p)) / (len(x) + prior) + 1e-10 * np.eye(p)
    return expect()[0] * scale + centre


@pytest.mark.parametrize("prior", [0.0, 20.0])
def test_equals_the_dense_twin(spark, prior):
    _, x = gappy(1)
    cols = [f"f{j}" for j in range(6)]
    df = frame(spark, x)
    fit = fit_joint_imputer(df, cols, max_iter=6, prior_rows=prior, tol=0)
    got = np.array([tuple(r)[1:] for r in apply_joint(df, fit).orderBy("id").collect()])
    assert fit.iterations == 6 and np.allclose(got, twin(x, 6, prior), atol=1e-8)
    assert (got[~np.isnan(x)] == x[~np.isnan(x)]).all()


def test_fills_are_the_fixed_point_of_column_sweeps():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(5, 5))
    precision, mean = a @ a.T + np.eye(5), rng.normal(size=5)
    x = rng.normal(size=(40, 5))
    x[rng.random((40, 5)) < 0.4] = np.nan
    got, _ = fill(x, mean, precision)
    swept = np.where(np.isnan(x), mean, x)
    for _ in range(500):
        for t in range(5):
            others = [j for j in range(5) if j != t]
            value = mean[t] - (swept[:, others] - mean[others]) @ precision[others, t] / precision[t, t]
            swept[:, t] = np.where(np.isnan(x[:, t]), value, swept[:, t])
    assert np.allclose(got, swept, atol=1e-9)


def test_nearer_than_means_and_variances_are_kept(spark):
    whole, x = gappy(3, n=800, share=0.3)
    cols = [f"f{j}" for j in range(6)]
    fit = fit_joint_imputer(frame(spark, x), cols, max_iter=60)
    got = np.array([tuple(r)[1:] for r in apply_joint(frame(spark, x), fit).orderBy("id").collect()])
    gaps = np.isnan(x)
    plain = np.where(gaps, np.nanmean(x, 0), x)
    assert ((got - whole)[gaps] ** 2).mean() < 0.25 * ((plain - whole)[gaps] ** 2).mean()
    variances = np.diag(np.linalg.inv(np.array(fit.precision))) * np.array(fit.scale) ** 2
    assert np.allclose(variances, whole.var(0), rtol=0.15)


def test_odd_columns_rows_and_tables(spark):
    rows = [(1, 1.0, 7.0, None, "a"), (1, 2.0, None, None, "b"), (None, None, None, None, None), (2, float("nan"), 7.0, None, "c"), (2, 4.0, 7.0, None, "c")]
    df = spark.createDataFrame(rows, "id long, a double, constant double, empty double, `_n` string").withColumn("c0", F.lit("clash"))
    fit = fit_joint_imputer(df, ["a", "constant", "empty"])
    got = [tuple(r) for r in apply_joint(df, fit).collect()]
    assert sorted(map(str, [(r[0], r[4], r[5]) for r in got])) == sorted(map(str, [(r[0], r[4], "clash") for r in rows]))
    assert all(r[2] == pytest.approx(7.0) and r[3] == pytest.approx(0.0) and np.isfinite(r[1]) for r in got)
    assert sorted(r[1] for r in got if r[1] in (1.0, 2.0, 4.0)) == [1.0, 2.0, 4.0]
    none = fit_joint_imputer(df.limit(0), ["a", "constant"])
    assert apply_joint(df.limit(0), none).count() == 0 and {r["a"] for r in apply_joint(df.where("a is null"), none).collect()} == {0.0}
    assert apply_joint(df, fit_joint_imputer(df, [])) is df


def test_a_whole_integer_column_and_one_shuffle_free_pass(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (2, None, 5.0), (3, 6, 7.0)], "id long, k int, v double")
    out = apply_joint(df, fit_joint_imputer(df, ["k", "v"], prior_rows=0.01))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: round(r["k"], 1) for r in out.collect()} == {1: 2.0, 2: 4.0, 3: 6.0}
