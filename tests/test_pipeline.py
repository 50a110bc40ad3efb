"""Iterative imputation, naive Bayes, scoring plan shape and the driver contract."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from sparkqc.operators import learn, naive_bayes
from sparkqc.operators.iterative import apply_iterative, fit_iterative_imputer
from sparkqc.plans import fixtures as fx


def corr_holes(spark, sf):
    """x_j = 0.3 e_j + e_{61 + (j-1) % 4}, j = 1..60; x1, x2 NULL when vec_id % 9 = 0 (true value kept)."""
    emb = fx.table(spark, sf, "embeddings")
    e = lambda i: F.col("embedding")[i - 1].cast("double")
    cols = []
    for j in range(1, 61):
        x = F.lit(0.3) * e(j) + e(61 + (j - 1) % 4)
        if j <= 2:
            cols.append(x.alias(f"t{j}"))
            x = F.when(F.col("vec_id") % 9 == 0, F.lit(None).cast("double")).otherwise(x)
        cols.append(x.alias(f"x{j}"))
    return emb.select("vec_id", *cols)


def test_iterative_beats_mean_fill_on_correlated_columns(spark):
    df = corr_holes(spark, SF01)
    feats = [f"x{j}" for j in range(1, 61)]
    fit, out = fit_iterative_imputer(df.drop("t1", "t2"), feats, max_iter=5)
    truth = df.select("vec_id", "t1", "t2", F.col("x1").isNull().alias("m"))
    j = out.join(truth, "vec_id").where("m").toPandas()
    assert out.where(F.col("x1").isNull() | F.col("x2").isNull()).count() == 0
    rmse = np.sqrt(np.mean((j["x1"] - j["t1"]) ** 2))
    mean_fill = fit.means["x1"]
    rmse_mean = np.sqrt(np.mean((mean_fill - j["t1"]) ** 2))
    assert rmse < 0.5 * rmse_mean
    # observed cells unchanged; replay on the same rows gives the same values
    obs = out.join(df.select("vec_id", F.col("x3").alias("o3")), "vec_id").where(F.col("x3") != F.col("o3")).count()
    assert obs == 0
    replay = apply_iterative(df.drop("t1", "t2"), fit).join(out.select("vec_id", F.col("x1").alias("f1")), "vec_id")
    assert replay.where(F.abs(F.col("x1") - F.col("f1")) > 1e-9).count() == 0


def test_gaussian_nb_relational_equals_wide(spark):
    lg = fx.long_view(spark, SF001)
    model, priors = naive_bayes.fit_gaussian_nb(lg, "y", "pos", "v", "vec_id")
    rel = {r.vec_id: r.pred for r in naive_bayes.score_gaussian_nb(lg, model, priors, "vec_id", "pos", "v").collect()}
    wide = fx.wide_view(spark, SF001)
    feats = [f"e{i}" for i in range(1, 65)]
    m = learn.fit_gaussian_nb_wide(wide, feats, "y")
    w = {r.vec_id: int(r.prediction) for r in m.transform(wide, feats).collect()}
    agree = sum(rel[k] == w[k] for k in rel) / len(rel)
    assert agree > 0.99


def test_adaboost_learns(spark):
    wide = fx.wide_view(spark, SF001)
    feats = [f"e{i}" for i in range(1, 9)]
    df = learn.assemble(wide, feats)
    m = learn.fit_adaboost(df, "y", learning_rate=0.5, n_rounds=3)
    assert 1 <= len(m.stumps) <= 3
    pred = m.transform(df)
    assert set(r.prediction for r in pred.select("prediction").distinct().collect()) <= {0.0, 1.0}


def test_driver_contract_keys_and_entry(spark):
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) == {"col", "n_outliers", "prop_outliers"}


def test_scoring_projection_has_no_exchange(spark):
    """X1 replay after dedup is projections only: no Exchange in the physical plan."""
    from sparkqc.plans.train import PreprocessFit

    wide = fx.wide_view(spark, SF001)
    prep = PreprocessFit("vec_id", "y", [f"e{i}" for i in range(1, 65)], simple_fill={"e1": 0.0},
                         fallback_fill={f"e{i}": 0.0 for i in range(1, 65)}, cap_iqr={"e2": (-1.0, 1.0)},
                         constant=["e3"], transforms={"e4": ("square", None)})
    plan = prep.apply(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_knn_blocks_equal_single_block(spark):
    from sparkqc.operators import knn

    w = fx.wide_view(spark, SF001).join(fx.table(spark, SF001, "embeddings").select("vec_id", "label"), "vec_id")
    feats = [f"e{i}" for i in range(1, 65)]
    one = knn.knn_neighbours(w, w, "vec_id", feats, "label", k=3, exclude_self=True)
    many = knn.knn_neighbours(w, w, "vec_id", feats, "label", k=3, exclude_self=True, block_rows=120)
    a = sorted((r.q_key, r.r_key, r.rank) for r in one.collect())
    b = sorted((r.q_key, r.r_key, r.rank) for r in many.collect())
    assert a == b and len(a) == 3 * w.count()
    # brute force for a few queries
    pdf = w.toPandas().set_index("vec_id")
    x = pdf[feats].to_numpy()
    ids = pdf.index.to_numpy()
    for qi in range(5):
        d = np.sqrt(((x - x[qi]) ** 2).sum(axis=1))
        d[qi] = np.inf
        order = sorted(range(len(ids)), key=lambda j: (d[j], ids[j]))[:3]
        assert [ids[j] for j in order] == [r for q, r, _ in sorted(a, key=lambda t: (t[0], t[2])) if q == ids[qi]]
    votes = {r.q_key: r.pred for r in knn.knn_vote(one).collect()}
    assert set(votes.values()) <= set(pdf["label"].unique())


def test_score_stream_equals_batch(spark, tmpdir_path):
    """R2: the fitted chain runs unchanged on a stream (parquet file source)."""
    import os

    from sparkqc.plans.train import PreprocessFit
    from sparkqc.streaming.stream import score_stream

    src = os.path.join(tmpdir_path, "src")
    fx.wide_view(spark, SF001).write.parquet(src)
    prep = PreprocessFit("vec_id", "y", [f"e{i}" for i in range(1, 65)], fallback_fill={"e1": 0.0},
                         cap_iqr={"e2": (-0.1, 0.1)}, transforms={"e3": ("square", None)})
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = os.path.join(tmpdir_path, "out")
    q = score_stream(stream, prep.apply, out, os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).select("vec_id", "e2", "e3").collect()))
    want = sorted(map(tuple, prep.apply(spark.read.parquet(src)).select("vec_id", "e2", "e3").collect()))
    assert got == want


def test_full_scoring_chain_on_stream(spark, tmpdir_path):
    """R2 with X2: preprocessing replay + scaling + a Spark ML model on a file stream."""
    import os

    from sparkqc.operators import learn
    from sparkqc.plans import score as sc
    from sparkqc.plans.train import PreprocessFit, model_frame
    from sparkqc.streaming.stream import score_stream

    wide = fx.wide_view(spark, SF001)
    feats = ["e1", "e2", "e3", "e4"]
    prep = PreprocessFit("vec_id", "y", [f"e{i}" for i in range(1, 65)], fallback_fill={c: 0.0 for c in feats})
    scaler = {c: (0.0, 1.0) for c in feats}
    frame, use = model_frame(wide, scaler, feats, "LinearSVC", keep=("vec_id", "y"))
    model = learn.fit_model("LinearSVC", {"C": 1.0}, learn.assemble(frame, use), use, "y", max_iter=5)
    sm = sc.ScoringModel(prep, scaler, feats, "LinearSVC", model)
    src = os.path.join(tmpdir_path, "src")
    wide.drop("y").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = os.path.join(tmpdir_path, "out")
    q = score_stream(stream, lambda d: sc.score(prep.apply(d), sm), out, os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(120)
    got = sorted((r.vec_id, r.Pred_Output) for r in spark.read.parquet(out).collect())
    want = sorted((r.vec_id, r.Pred_Output) for r in sc.score(prep.apply(spark.read.parquet(src)), sm).collect())
    assert got == want and len(got) == wide.count()


@pytest.mark.parametrize("family,params", [("GaussianNB", {"var_smoothing": 1e-9}),
                                           ("AdaBoostClassifier", {"learning_rate": 0.5, "n_rounds": 2}),
                                           ("KNeighborsClassifier", {"n_neighbors": 3, "p": 2}),
                                           ("LinearSVC", {"C": 1.0})])
def test_model_save_load_roundtrip(spark, tmpdir_path, family, params):
    import os

    wide = fx.wide_view(spark, SF001)
    feats = ["e1", "e2", "e3"]
    df = learn.assemble(wide.select("vec_id", "y", *feats), feats)
    m = learn.fit_model(family, params, df, feats, "y", max_iter=5, key="vec_id")
    path = os.path.join(tmpdir_path, "m")
    learn.save_model(m, path)
    back = learn.load_model(spark, family, path)
    a = sorted((r.vec_id, r.pred) for r in learn.predict(m, df).select("vec_id", "pred").collect())
    b = sorted((r.vec_id, r.pred) for r in learn.predict(back, df).select("vec_id", "pred").collect())
    assert a == b
