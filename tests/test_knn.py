"""The kNN join with pivot bounds against brute force, on clustered, tied, repeated and missing rows."""

import math

import numpy as np
import pytest

from sparkqc.operators import knn

SCHEMA = "id long, a double, b double, c double, label int, _x string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(queries, rows, k, p, exclude_self):
    ok = [r for r in rows if all(v is not None and math.isfinite(v) for v in r[1:4])]
    out = []
    for q in queries:
        if all(v is not None and math.isfinite(v) for v in q[1:4]):
            d = []
            for r in ok:
                if not (exclude_self and q[0] is not None and q[0] == r[0]):
                    s = 0.0
                    for x, y in zip(q[1:4], r[1:4]):
                        s += (x - y) * (x - y) if p == 2 else float(np.abs(np.float64(x - y)) ** p)
                    d.append((s ** (1.0 / p), r[0] is None, r[0] or 0))
            out += [(q[0], None if null else i, rank + 1, round(dist, 9)) for rank, (dist, null, i) in enumerate(sorted(d)[:k])]
    return sorted(out, key=str)


def got(nb):
    return sorted([(r.q_key, r.r_key, r["rank"], round(r.dist, 9)) for r in nb.collect()], key=str)


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-50, 50, (12, 3)) * 20
    return [(i, *(float(v) for v in centres[rng.integers(12)] + rng.normal(size=3)), int(rng.integers(3)), "x") for i in range(n)]


@pytest.mark.parametrize("p", [0.5, 1.0, 2.0, 3.0])
def test_equals_brute_force_for_any_order(spark, p):
    rows = clustered(400)
    df = frame(spark, rows)
    found = knn.knn_neighbours(df, df, "id", ["a", "b", "c"], "label", k=4, p=p, exclude_self=True, block_rows=40)
    assert got(found) == brute(rows, rows, 4, p, True)


def test_ties_repeats_missing_values_and_hot_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *(float(v) for v in rng.integers(0, 4, 3)), 1, None) for i in range(150)]
    rows += [(1000 + i, 2.0, 2.0, 2.0, 0, None) for i in range(90)]                       # a third are equal
    rows += [(7, 9.0, 9.0, 9.0, 2, None), (7, 9.0, 9.0, 9.5, 2, None), (8, 1.0, 1.0, 1.0, 0, None)]  # keys that stand twice
    rows += [(None, 3.0, 3.0, 3.5, 1, None)]
    rows += [(2000, None, 1.0, 1.0, 1, None), (2001, float("nan"), 1.0, 1.0, 1, None), (2002, float("inf"), 1.0, 1.0, 1, None)]
    df = frame(spark, rows)
    for own in (True, False):
        found = knn.knn_neighbours(df, df, "id", ["a", "b", "c"], "label", k=5, exclude_self=own, block_rows=25)
        assert got(found) == brute(rows, rows, 5, 2.0, own)


def test_few_rows_and_empty_sides(spark):
    rows = clustered(3)
    df, none = frame(spark, rows), frame(spark, [])
    assert got(knn.knn_neighbours(df, df, "id", ["a", "b", "c"], "label", k=9, exclude_self=True)) == brute(rows, rows, 9, 2.0, True)
    for q, r in ((none, df), (df, none), (none, none)):
        out = knn.knn_neighbours(q, r, "id", ["a", "b", "c"], "label")
        assert out.count() == 0 and out.columns == ["q_key", "r_key", "dist", "r_label", "rank"]
    with pytest.raises(ValueError):
        knn.knn_neighbours(df, df, "id", ["a", "b", "c"], "label", p=0)


def test_rows_with_clusters_go_to_few_groups(spark):
    df = frame(spark, clustered(3000, seed=5))
    q = knn._rows(df, "id", "bigint", ["a", "b", "c"])
    plan = knn.plan_join(q, q, 5, 2.0, True, 100)
    assert len(plan.starts) > 20
    assert plan.copies_per_row < len(plan.starts) / 5


@pytest.mark.parametrize("width,p", [(64, 2.0), (16, 1.0), (6, 3.0), (5, 2.5)])
def test_screened_block_equals_all_sums(width, p):
    rng = np.random.default_rng(7)
    q, r = rng.normal(size=(300, width)) * 1e-3 + 50, rng.normal(size=(2500, width)) * 1e-3 + 50
    r[40:80], q[:90] = r[10], r[:90]
    sums = knn._sums(q, r, p)
    order = np.argsort(sums, axis=1, kind="stable")[:, :5]
    best, at = knn._k_nearest(q, r, 5, p)
    assert (at == order).all() and (best == np.take_along_axis(sums, order, 1)).all()


def test_copies_of_a_row_do_not_grow_with_small_blocks(spark):
    rng = np.random.default_rng(11)
    rows = [(i, *(float(v) for v in x), 1, None) for i, x in enumerate(rng.normal(size=(9000, 3)))]
    wide = frame(spark, rows).selectExpr("id", "label", *[f"rand({i}) AS x{i}" for i in range(24)]).localCheckpoint()  # no bounds help here
    feats = [f"x{i}" for i in range(24)]
    q = knn._rows(wide, "id", "bigint", feats)
    plan = knn._plan(q, q, 5, 2.0, True, None, knn.MAX_PIVOTS, 24)
    assert plan.copies_per_row <= knn.MAX_COPIES


@pytest.mark.parametrize("block_rows", [60, None])
def test_lists_without_each_part_equal_separate_joins(spark, block_rows):
    rows = clustered(500, seed=9)
    rows += [(600 + i, *rows[3][1:4], 2, "x") for i in range(30)]  # equal rows in all parts
    df = frame(spark, rows).selectExpr("*", "int(id % 3) + 1 AS part").localCheckpoint()
    feats = ["a", "b", "c"]
    found = knn.knn_neighbours_without(df, df, "id", feats, "label", "part", (1, 2, 3), k=4, p=1.0, block_rows=block_rows)
    for v in (None, 1, 2, 3):
        alone = knn.knn_neighbours(df, df if v is None else df.where(f"part <> {v}"), "id", feats, "label", k=4, p=1.0)
        assert got(found.where("without IS NULL" if v is None else f"without = {v}")) == got(alone)


def test_knn_trial_joins_once_and_scores_as_single_models(spark, monkeypatch):
    from sparkqc.operators import evaluate, learn
    from pyspark.sql import functions as F

    df = frame(spark, clustered(360, seed=4)).selectExpr("id", "int(label > 0) AS y", "a", "b", "c", "int(id % 3) + 1 AS fold").localCheckpoint()
    train, test = df.where("id % 7 > 0"), df.where("id % 7 = 0")
    params, feats = {"n_neighbors": 3, "weights": "distance", "p": 1}, ["a", "b", "c"]
    joins, join = [], knn._joined
    monkeypatch.setattr(knn, "_joined", lambda *a: joins.append(1) or join(*a))
    got_metrics = learn.evaluate_trial("KNeighborsClassifier", params, train, test, feats, "y", k=3, key="id").metrics
    assert len(joins) == 1
    preds = []
    for f in (1, 2, 3):
        model = learn.fit_model("KNeighborsClassifier", params, train.where(F.col("fold") != f), feats, "y", key="id")
        for side, part in (("train", train.where(F.col("fold") != f)), ("val", train.where(F.col("fold") == f))):
            preds.append(learn.predict(model, part).select("y", "pred", F.lit(f).alias("fold"), F.lit(side).alias("side")))
    every = preds[0]
    for more in preds[1:]:
        every = every.unionByName(more)
    cv = {r["side"]: r for r in evaluate.cv_scores(every).collect()}
    for side in ("train", "val"):
        assert got_metrics[f"{side}_matthews_corrcoef"] == pytest.approx(cv[side]["mcc"])
        assert got_metrics[f"{side}_recall_score"] == pytest.approx(cv[side]["macro_recall"])
    whole = learn.fit_model("KNeighborsClassifier", params, train, feats, "y", key="id")
    alone = evaluate.mcc(learn.predict(whole, test)).first()["mcc"]
    assert got_metrics["test_matthews_corrcoef"] == pytest.approx(alone)
