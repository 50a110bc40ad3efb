"""Regularised boosting, cost-complexity pruning and the feed-forward network against plain references."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.operators import boosting as bo
from sparkqc.operators import growing, learn, network, pruning, split
from sparkqc.operators.trees import Tree

FEATURES = ["a", "b", "c"]


def frame(spark, n=240, seed=0, holes=0.06):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=n)) > 0.7).astype(int)
    x[rng.random(x.shape) < holes] = np.nan
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y int").repartition(3), x, y


def reference_tree(bins, g, h, pen, depth):
    """Exhaustive search over (column, bin, way), node by node."""
    def best(rows):
        total = (g[rows].sum(), h[rows].sum())
        score = lambda p: -(2 * p[0] * (w := pen.weight(*p)) + (p[1] + pen.lambda_) * w * w + 2 * pen.alpha * abs(w))
        found = []
        for c in range(bins.shape[1]):
            b = bins[rows, c]
            for cut in sorted(set(b[b > 0])):
                for way in (False, True) if (b == 0).any() else (False,):
                    left = ((b <= cut) & (b > 0)) | ((b == 0) & way)
                    lo, hi = (g[rows][left].sum(), h[rows][left].sum()), (g[rows][~left].sum(), h[rows][~left].sum())
                    if lo[1] >= pen.min_child_weight and hi[1] >= pen.min_child_weight:
                        found.append((score(lo) + score(hi) - score(total), -c, -cut, left))
        return max(found, key=lambda f: (round(f[0], 9), f[1], f[2]), default=None)

    def grow(rows, d):
        s = best(rows) if d else None
        if s is None or s[0] <= 1e-6:
            return None, pen.weight(g[rows].sum(), h[rows].sum()), rows
        sides = grow(rows[s[3]], d - 1), grow(rows[~s[3]], d - 1)
        if s[0] < pen.gamma and all(x[0] is None for x in sides):
            return None, pen.weight(g[rows].sum(), h[rows].sum()), rows
        return sides, None, rows

    out = np.zeros(len(g))

    def fill(node):
        if node[0] is None:
            out[node[2]] = node[1]
        else:
            fill(node[0][0]), fill(node[0][1])

    fill(grow(np.arange(len(g)), depth))
    return out


@pytest.mark.parametrize("penalty", [bo.Penalty(), bo.Penalty(2.0, 0.7, 1.5, 3.0, 0.4)])
def test_boosted_margins_equal_reference(spark, penalty):
    df, x, y = frame(spark)
    cuts = bo.quantile_cuts(df, FEATURES, 12)
    for i, c in enumerate(FEATURES):
        known = np.sort(x[:, i][~np.isnan(x[:, i])])
        assert cuts[c] == sorted(set(cuts[c])) and set(cuts[c]) <= set(known.tolist()) and len(cuts[c]) <= 11 and cuts[c][-1] < known[-1]
    model = bo.fit_boosted_trees(df, FEATURES, "y", 0.4, penalty, rounds=3, max_depth=3, max_bins=12, cuts=cuts, checkpoint_every=2)
    bins = np.stack([np.where(np.isnan(x[:, i]), 0, np.searchsorted(cuts[c], np.nan_to_num(x[:, i]), side="left") + 1) for i, c in enumerate(FEATURES)], 1)
    margin = np.zeros(len(y))
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + 0.4 * reference_tree(bins, p - y, p * (1 - p), penalty, 3)
    got = {r["k"]: r["margin"] for r in model.margins(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], margin, atol=1e-9)


def test_boosting_samples_rows_and_columns_by_seed(spark):
    df, _, y = frame(spark)
    kw = dict(rounds=2, max_depth=2, max_bins=8, colsample_bytree=0.67, colsample_bynode=0.5, subsample=0.6, cuts=bo.quantile_cuts(df, FEATURES, 8))
    one, same, other = (bo.fit_boosted_trees(df.repartition(n), FEATURES, "y", seed=s, **kw) for n, s in ((2, 1), (5, 1), (2, 2)))
    shape = lambda m: [(t.feature.tolist(), t.threshold.tolist()) for t in m.trees]
    assert shape(one) == shape(same) != shape(other)
    draw = np.random.default_rng(0).integers(-2**63, 2**63 - 1, 20_000)
    assert abs(bo._drawn(draw, 5, 0.3).mean() - 0.3) < 0.02


def test_boosting_without_rows_or_values(spark):
    df, _, _ = frame(spark, 20)
    assert bo.fit_boosted_trees(df.where("k < 0"), FEATURES, "y", rounds=1).trees[0].leaves == 1
    assert bo.fit_boosted_trees(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y", rounds=1).trees[0].leaves == 1


def test_linear_booster_approaches_the_logistic_fit(spark):
    df, x, y = frame(spark, holes=0.0)
    model = bo.fit_boosted_linear(df, FEATURES, "y", 0.7, bo.Penalty(lambda_=2.0), rounds=25)
    z = x @ np.array(model.weights) + model.bias
    p = 1 / (1 + np.exp(-z))
    assert np.allclose((p - y) @ x + 2.0 * np.array(model.weights), 0, atol=1e-2) and abs((p - y).sum()) < 1e-2


def test_boosted_model_is_saved_whole(spark, tmpdir_path):
    df, _, _ = frame(spark, 60)
    model = learn.fit_model("RegularisedBoosting", {"rounds": 2, "max_depth": 2}, learn.assemble(df.na.fill(0.0), FEATURES), FEATURES, "y")
    learn.save_model(model, f"{tmpdir_path}/m")
    again = learn.load_model(spark, "RegularisedBoosting", f"{tmpdir_path}/m")
    one, two = ({r["k"]: r["margin"] for r in m.margins(df).collect()} for m in (model, again))
    assert one == two


# ------------------------------------------------------------------ pruning

def hand_tree():
    """Root 100 rows (50:50); left 60 (45:15) with leaves 40 (36:4) and 20 (9:11); right leaf 40 (5:35)."""
    counts = np.array([[50, 50], [45, 15], [5, 35], [36, 4], [9, 11]], float)
    share = counts / counts.sum(1)[:, None]
    ints = lambda *v: np.array(v, np.int64)
    return pruning.NodeTable(ints(-1, 0, 0, 1, 1), ints(1, 3, -1, -1, -1), ints(2, 4, -1, -1, -1), ints(0, 1, -1, -1, -1), np.array([0.0, 1.0, 0, 0, 0]), counts.sum(1), 1 - (share ** 2).sum(1), share)


def test_path_of_a_hand_worked_tree():
    t = hand_tree()
    # R(left) = .6 * .375 = .225; its leaves .4 * .18 + .2 * .495 = .171; g = .054
    # then R(root) = .5; left .225, right .4 * .21875 = .0875; g = .5 - .3125 = .1875
    assert np.allclose(pruning.pruning_path(t), [0, 0.054, 0.1875])
    assert [len(pruning.prune(t, a).parent) for a in (0.0, 0.05, 0.0541, 0.18, 0.19)] == [5, 5, 3, 3, 1]
    assert pruning.prune(t, 0.06).value.tolist() == t.value[[0, 1, 2]].tolist()


def test_pruned_predictions_and_saved_rows(spark, tmpdir_path):
    df = spark.createDataFrame([(0, -1.0, 0.0), (1, -1.0, 2.0), (2, 1.0, 0.0), (3, -1.0, None)], "k long, u double, v double")
    pred = lambda m: [r["prediction"] for r in m.transform(df).orderBy("k").collect()]
    models = [pruning.PrunedTrees(["u", "v"], [pruning.prune(hand_tree(), a)]) for a in (0.0, 0.1, 1.0)]
    assert [pred(m) for m in models] == [[0, 1, 1, 1], [0, 0, 1, 0], [0, 0, 0, 0]]
    learn.save_model(models[0], f"{tmpdir_path}/p")
    assert pred(learn.load_model(spark, "DecisionTreeClassifier", f"{tmpdir_path}/p")) == [0, 1, 1, 1]
    assert pruning.as_frame(spark, [hand_tree()]).count() == 5


@pytest.mark.parametrize("family", ["DecisionTreeClassifier", "RandomForestClassifier"])
def test_pruning_at_zero_keeps_spark_predictions(spark, family):
    df, _, _ = frame(spark, holes=0.0)
    data, _ = learn.with_balanced_weight(learn.assemble(df, FEATURES), "y")
    est = learn.make_estimator(family, {"maxDepth": 6, "numTrees": 5}, 1.0, 3, "y").fit(data)
    mine = pruning.PrunedTrees(FEATURES, pruning.node_tables(est)).transform(data).select("k", F.col("prediction").alias("mine"))
    assert est.transform(data).join(mine, "k").where("prediction <> mine").count() == 0
    alphas = learn.pruning_alphas(df, FEATURES, "y")
    assert alphas[0] == 0 and alphas == sorted(alphas) and len(alphas) > 3
    params = learn.sample_params(family, random.Random(1), 3, alphas)
    assert params["ccp_alpha"] in alphas[:-1]
    full, cut = (learn.fit_model(family, {"ccp_alpha": a, "numTrees": 3}, data, FEATURES, "y") for a in (0.0, alphas[-2]))
    assert sum(len(t.parent) for t in cut.tables) < sum(len(t.parent) for t in full.tables)


def test_measured_tree_counts_rows(spark):
    df, x, y = frame(spark, holes=0.0)
    tree = Tree(np.array([0, -1, -1]), np.array([0.1, 0, 0]), np.zeros(3, bool), np.array([1, -1, -1]), np.array([2, -1, -1]), np.zeros((3, 1)))
    t = pruning.measured(tree, df.union(df.limit(3).withColumn("y", F.lit(None).cast("int"))), FEATURES, "y", 2)
    left = x[:, 0] <= 0.1
    assert t.weight.tolist() == [len(y), left.sum(), (~left).sum()]
    assert np.allclose(t.value[1], [1 - y[left].mean(), y[left].mean()])


# ------------------------------------------------------------------ network

@pytest.mark.parametrize("activation", network.ACTIVATIONS)
@pytest.mark.parametrize("norm", [False, True])
def test_gradients_by_finite_differences(activation, norm):
    rng = np.random.default_rng(3)
    layers = network.Layers((4, 3), activation, "he_normal", "glorot_uniform", norm)
    weights = [w + 0.1 * rng.normal(size=w.shape) for w in network.initial_weights(layers, 5, 1)]
    x, y = rng.normal(size=(20, 5)), (rng.random(20) > 0.5).astype(float)
    loss = lambda flat: network.gradients(layers, network._shaped(flat, weights), x, y, rng)[0]
    flat, exact = network._flat(weights), network._flat(network.gradients(layers, weights, x, y, rng)[1])
    for i in range(len(flat)):
        e = np.zeros(len(flat))
        e[i] = 1e-6
        assert abs((loss(flat + e) - loss(flat - e)) / 2e-6 - exact[i]) < 1e-6


def test_network_learns_and_reruns_agree(spark, tmpdir_path):
    df, x, y = frame(spark)
    layers = network.Layers((16,), "relu", dropout=0.1)
    fit = lambda d, seed=4: network.fit_network(d, FEATURES, "y", layers, epochs=3, batch_size=80, learning_rate=0.02, seed=seed)
    one, same, other = fit(df), fit(df.repartition(5)), fit(df, 5)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(one.weights, same.weights, strict=True))
    assert not np.allclose(one.weights[0], other.weights[0])
    got = {r["k"]: r["probability"] for r in one.probabilities(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], network.forward(layers, one.weights, [], x))
    assert np.mean([(got[i] > 0.5) == y[i] for i in range(len(y))]) > 0.7
    learn.save_model(one, f"{tmpdir_path}/n")
    again = learn.load_model(spark, "FeedForwardNetwork", f"{tmpdir_path}/n")
    assert {r["k"]: r["probability"] for r in again.probabilities(df).collect()} == got


def test_network_stops_early_and_without_rows(spark):
    df, _, _ = frame(spark, 60)
    worse = df.withColumn("y", 1 - F.col("y"))
    assert network.fit_network(df, FEATURES, "y", network.Layers((8,)), epochs=9, validation=worse, patience=1, learning_rate=0.05).epochs < 9
    empty = network.fit_network(df.where("k < 0"), FEATURES, "y", network.Layers((8,), batch_normalization=True))
    assert empty.epochs == 0 and empty.transform(df).count() == 60


def test_search_space_of_new_families():
    rng = random.Random(0)
    for _ in range(30):
        p = learn.sample_params("FeedForwardNetwork", rng)
        assert all(u % 32 == 0 and 32 <= u <= 640 for u in p["units"]) and 1 <= len(p["units"]) <= 3 and 0 <= p["dropout"] <= 0.5
        q = learn.sample_params("RegularisedBoosting", rng)
        assert 0 <= q["eta"] <= 0.01 and 1 <= q["gamma"] <= 50 and 1 <= q["lambda"] <= 2 and q["booster"] in ("gbtree", "gblinear")


def test_split_keeps_rows_without_label(spark):
    rows = [(i, None if i % 3 == 0 else i % 2) for i in range(90)]
    got = split.stratified_split(spark.createDataFrame(rows, "k long, y int"), "y", "k", 0.2).groupBy("y", "split").count().collect()
    assert sum(r["count"] for r in got) == 90 and {(r["y"], r["split"]): r["count"] for r in got}[None, "test"] == 6
    assert split.stratified_split(spark.createDataFrame([(1, None), (2, None)], "k long, y int"), "y", "k").count() == 2


# ------------------------------------------------------- bounded growth

def noisy(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    y = ((x[:, 0] > 0.3) ^ (rng.random(n) < 0.3)).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(n)], "k long, y int, " + ", ".join(f"{c} double" for c in FEATURES)).repartition(3, "k")
    return learn.with_balanced_weight(learn.assemble(df, FEATURES), "y")[0].localCheckpoint()


def test_growth_stops_where_pruning_would(spark):
    data, alpha = noisy(spark), 0.004
    whole = growing.grow(data, FEATURES, "y", learn.WEIGHT, 0.0, key="k")[0]
    short = growing.grow(data, FEATURES, "y", learn.WEIGHT, alpha, key="k")[0]
    assert len(short.parent) < len(whole.parent) * 0.8
    inner = short.feature >= 0
    assert (short.impurity * short.weight / short.weight[0])[inner].min() > alpha
    one, two = pruning.prune(whole, alpha), pruning.prune(short, alpha)
    key = lambda t: sorted(zip(t.feature.tolist(), t.threshold.tolist(), np.round(t.weight, 9).tolist()))
    assert key(one) == key(two) and len(one.parent) > 3


def test_growth_gains_like_spark(spark):
    data = noisy(spark)
    mine, theirs = growing.grow(data, FEATURES, "y", learn.WEIGHT, 0.0, key="k", depth=3)[0], pruning.node_tables(learn.make_estimator("DecisionTreeClassifier", {"maxDepth": 3}, 1.0, 3, "y").fit(data))[0]
    assert (mine.feature[0], round(mine.threshold[0], 9), round(mine.weight[0], 6)) == (theirs.feature[0], round(theirs.threshold[0], 9), round(theirs.weight[0], 6))
    seen = {(f, round(t, 9), round(w, 6)) for f, t, w in zip(mine.feature.tolist(), mine.threshold.tolist(), mine.weight.tolist())}
    assert {(f, round(t, 9), round(w, 6)) for f, t, w in zip(theirs.feature.tolist(), theirs.threshold.tolist(), theirs.weight.tolist()) if f >= 0} <= seen


def test_forest_draws_are_poisson_and_reruns_agree(spark, monkeypatch):
    draws = growing._poisson(np.arange(200_000), 3, 42)
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02
    data = noisy(spark)
    grow = lambda d: [t.rows() for t in growing.grow(d, FEATURES, "y", learn.WEIGHT, 0.01, 4, True, key="k")]
    one, two = grow(data), grow(data.repartition(5))
    same = lambda a, b: [(r[1:6], round(r[6], 9), round(r[7], 6)) for t in a for r in t] == [(r[1:6], round(r[6], 9), round(r[7], 6)) for t in b for r in t]
    assert same(one, two) and one[0] != one[1]
    monkeypatch.setattr(growing, "SUMS_BYTES", 2 * 8 * 3 * growing.MAX_BINS * 2)  # two open nodes a pass
    size = lambda forest: sorted(sorted(round(r[7], 6) for r in t) for t in forest)
    assert size(grow(data)) == size(one)


def test_growth_of_few_rows_gaps_and_constant_columns(spark):
    schema = "k long, y int, u double, v double, _w double"
    rows = [(0, 0, 1.0, 5.0, 1.0), (1, 0, 1.0, 5.0, 1.0), (2, 1, None, 5.0, 1.0), (3, 1, 3.0, 5.0, 1.0), (4, None, 9.0, 5.0, 1.0)]
    t = growing.grow(spark.createDataFrame(rows, schema), ["u", "v"], "y", "_w", 0.0, key="k")[0]
    assert t.feature.tolist() == [0, -1, -1] and t.threshold[0] == 2.0 and t.weight.tolist() == [4, 2, 2]
    assert len(growing.grow(spark.createDataFrame(rows[:2], schema), ["u", "v"], "y", "_w", 0.0)[0].parent) == 1
    assert len(growing.grow(spark.createDataFrame([], schema), ["u", "v"], "y", "_w", 0.0)[0].parent) == 1


@pytest.mark.parametrize("family", ["DecisionTreeClassifier", "RandomForestClassifier"])
def test_pruned_fit_grows_no_more_than_it_keeps(spark, family, monkeypatch):
    data, grown, grow = noisy(spark), [], growing.grow
    monkeypatch.setattr(growing, "grow", lambda *a: grown.extend(grow(*a)) or grown)
    learn.fit_model(family, {"ccp_alpha": 0.01, "numTrees": 3}, data, FEATURES, "y", key="k")
    assert len(grown) == (3 if family == "RandomForestClassifier" else 1)
    assert all((t.impurity * t.weight / t.weight[0])[t.feature >= 0].min() > 0.01 for t in grown)


def test_a_pruned_trial_makes_its_rows_once(spark, monkeypatch):
    df, _, _ = frame(spark, holes=0.0)
    plans, grow = [], growing.grow
    monkeypatch.setattr(growing, "grow", lambda d, *a: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or grow(d, *a))
    rows = split.stratified_folds(df, "y", "k", 2)  # a join
    assert "Join" in rows._jdf.queryExecution().optimizedPlan().toString()
    t = learn.evaluate_trial("DecisionTreeClassifier", {"ccp_alpha": 0.05}, rows, df, FEATURES, "y", k=2, key="k")
    assert len(plans) == 3 and not any("Join" in p for p in plans)
    assert all(0 < v <= 1 for v in t.metrics.values())
