"""Learning jobs on Spark ML (L1-L4, L7-L13) and trial evaluation.

Every fit is a distributed Spark ML job; the driver loops only over trials,
folds and families (a bounded grid), never over rows. Fold predictions are
unioned into one table and scored with the DataFrame metrics of
``evaluate`` in a single grouped aggregation per trial.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.operators import boosting, evaluate, growing, network, pruning
from sparkqc.operators.ranking import cumulative_sums
from sparkqc.sources import fits
from sparkqc.session import cut_lineage

# Tuned families and the order they are searched.
FAMILIES = ("RandomForestClassifier", "LogisticRegression", "DecisionTreeClassifier", "LinearSVC",
            "KNeighborsClassifier", "GaussianNB", "GBTClassifier", "AdaBoostClassifier", "MultilayerPerceptronClassifier",
            "RegularisedBoosting", "FeedForwardNetwork")
#: Families whose trees are pruned by cost complexity when ``ccp_alpha`` is among their parameters.
PRUNED = ("RandomForestClassifier", "DecisionTreeClassifier")
#: Depth of trees that are grown to be pruned (the deepest that Spark ML grows too).
FULL_DEPTH = 30
DEFAULT_FAMILIES = ("RandomForestClassifier", "LogisticRegression", "DecisionTreeClassifier", "LinearSVC",
                    "GaussianNB", "GBTClassifier")

FEATURES = "features"
WEIGHT = "_w"


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def with_balanced_weight(df: DataFrame, label: str) -> tuple[DataFrame, float]:
    """'balanced' class weights n / (k n_c) as a column; returns (df, sum of weights)."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    n, k = sum(counts.values()), len(counts)
    w = F.lit(None).cast("double")
    for c, nc in counts.items():
        w = F.when(F.col(label) == c, F.lit(n / (k * nc))).otherwise(w)
    return df.withColumn(WEIGHT, w), float(n)  # sum of balanced weights equals n


# ------------------------------------------------------------- search space

def sample_params(family: str, rng: random.Random, n_features: int = 10, alphas: Sequence[float] = ()) -> dict:
    """One random point of the family's search space. ``alphas`` is the pruning path of a tree on the training rows: with it,
    trees are grown fully and pruned at one of its values (but the last, which leaves the root alone)."""
    if family in PRUNED and len(alphas) > 1:
        return {"ccp_alpha": rng.choice(list(alphas[:-1]))}
    if family == "RandomForestClassifier":
        return {"numTrees": rng.choice([20, 50, 100]), "maxDepth": rng.randint(3, 12),
                "minInfoGain": rng.choice([0.0, 1e-4, 1e-3, 1e-2])}
    if family in ("LogisticRegression", "LinearSVC"):
        return {"C": 10 ** rng.uniform(-2, 0)}
    if family == "DecisionTreeClassifier":
        return {"maxDepth": rng.randint(2, 12), "minInfoGain": rng.choice([0.0, 1e-4, 1e-3, 1e-2])}
    if family == "GaussianNB":
        return {"var_smoothing": rng.uniform(0.0, 1.0)}
    if family == "KNeighborsClassifier":
        return {"n_neighbors": rng.choice([3, 5, 7, 9, 11]), "weights": rng.choice(["uniform", "distance"]),
                "p": rng.randint(1, 4)}
    if family == "GBTClassifier":
        return {"maxIter": rng.choice([20, 50]), "maxDepth": rng.randint(2, 6), "stepSize": rng.uniform(0.01, 0.3),
                "subsamplingRate": rng.uniform(0.5, 1.0), "minInfoGain": rng.choice([0.0, 1e-3, 1e-2]),
                "minInstancesPerNode": rng.randint(1, 10)}
    if family == "AdaBoostClassifier":
        return {"learning_rate": rng.uniform(0.001, 0.01), "n_rounds": 50}
    if family == "MultilayerPerceptronClassifier":
        return {"hidden": [rng.choice([8, 16, 32]) for _ in range(rng.randint(1, 3))], "stepSize": rng.uniform(0.01, 0.1)}
    # Ranges of the search space.
    if family == "RegularisedBoosting":
        return {"booster": rng.choice(["gbtree", "gblinear"]), "eta": rng.uniform(0, 0.01), "gamma": rng.uniform(1, 50), "min_child_weight": rng.uniform(1, 50),
                "max_delta_step": rng.randint(1, 10), "colsample_bytree": rng.uniform(0, 1), "colsample_bylevel": rng.uniform(0, 1), "colsample_bynode": rng.uniform(0, 1),
                "lambda": rng.uniform(1, 2), "alpha": rng.uniform(0, 1), "subsample": rng.uniform(0.5, 1)}
    if family == "FeedForwardNetwork":
        units = lambda: 32 * rng.randint(1, 20)
        return {"units": [units() for _ in range(1 + rng.randint(0, 2))], "activation": rng.choice(network.ACTIVATIONS), "hidden_initializer": rng.choice(network.INITIALIZERS),
                "output_initializer": rng.choice(network.INITIALIZERS), "batch_normalization": rng.choice([True, False]),
                "dropout": rng.choice([0.0, round(0.1 * rng.randint(1, 5), 1)])}
    raise ValueError(family)


def full_tree(df: DataFrame, label: str, weighted: bool, seed: int = 42):
    """A decision tree grown until its leaves are pure (or FULL_DEPTH deep) on an assembled frame."""
    tree = DecisionTreeClassifier(maxDepth=FULL_DEPTH, impurity="gini", seed=seed, featuresCol=FEATURES, labelCol=label)
    return (tree.setWeightCol(WEIGHT) if weighted else tree).fit(df)


def pruning_alphas(train: DataFrame, features: Sequence[str], label: str, seed: int = 42) -> list[float]:
    """Pruning path of an unweighted full tree on ``train``: the values of ``ccp_alpha`` worth trying."""
    return pruning.pruning_path(pruning.node_tables(full_tree(assemble(train, features), label, False, seed))[0])


def fit_boosting(df: DataFrame, features: Sequence[str], label: str, params: dict, seed: int = 42) -> boosting.BoostedModel:
    """L8 from a parameter point; missing parameters take the defaults of ``boosting``."""
    penalty = boosting.Penalty(params.get("lambda", 1.0), params.get("alpha", 0.0), params.get("gamma", 0.0), params.get("min_child_weight", 1.0), params.get("max_delta_step", 0.0))
    rounds = params.get("rounds", boosting.ROUNDS)
    if params.get("booster", "gbtree") == "gblinear":
        return boosting.fit_boosted_linear(df, features, label, params.get("eta", 0.5), penalty, rounds)
    return boosting.fit_boosted_trees(df, features, label, params.get("eta", 0.3), penalty, rounds, params.get("max_depth", boosting.MAX_DEPTH), params.get("colsample_bytree", 1.0),
                                      params.get("colsample_bylevel", 1.0), params.get("colsample_bynode", 1.0), params.get("subsample", 1.0), seed=seed)


def fit_feed_forward(df: DataFrame, features: Sequence[str], label: str, params: dict, seed: int = 42, validation: DataFrame | None = None) -> network.NetworkModel:
    """L10 from a parameter point."""
    shape = {k: params[k] for k in ("activation", "hidden_initializer", "output_initializer", "batch_normalization", "dropout") if k in params}
    layers = network.Layers(tuple(params.get("units", (32,))), **shape)
    return network.fit_network(df, features, label, layers, params.get("epochs", network.EPOCHS), validation, seed=seed)


def make_estimator(family: str, params: dict, sum_w: float, n_features: int, label: str, seed: int = 42, max_iter: int = 20):
    """Spark ML estimator for a family and parameter point (C maps to regParam = 1 / (C * sum w))."""
    common = {"featuresCol": FEATURES, "labelCol": label}
    if family == "RandomForestClassifier":
        return RandomForestClassifier(impurity="gini", featureSubsetStrategy="all", weightCol=WEIGHT, seed=seed,
                                      numTrees=params.get("numTrees", 50), maxDepth=params.get("maxDepth", 5),
                                      minInfoGain=params.get("minInfoGain", 0.0), **common)
    if family == "LogisticRegression":
        return LogisticRegression(regParam=1.0 / (params["C"] * sum_w), elasticNetParam=0.0, standardization=False,
                                  weightCol=WEIGHT, maxIter=max_iter, **common)
    if family == "LinearSVC":
        return LinearSVC(regParam=1.0 / (params["C"] * sum_w), standardization=False, weightCol=WEIGHT,
                         maxIter=max_iter, **common)
    if family == "DecisionTreeClassifier":
        return DecisionTreeClassifier(weightCol=WEIGHT, maxDepth=params.get("maxDepth", 5), seed=seed,
                                      minInfoGain=params.get("minInfoGain", 0.0), **common)
    if family == "GBTClassifier":
        return GBTClassifier(lossType="logistic", weightCol=WEIGHT, seed=seed, maxIter=params.get("maxIter", 20),
                             maxDepth=params.get("maxDepth", 3), stepSize=params.get("stepSize", 0.1),
                             subsamplingRate=params.get("subsamplingRate", 1.0), minInfoGain=params.get("minInfoGain", 0.0),
                             minInstancesPerNode=params.get("minInstancesPerNode", 1), **common)
    if family == "MultilayerPerceptronClassifier":
        return MultilayerPerceptronClassifier(layers=[n_features, *params.get("hidden", [16]), 2], seed=seed,
                                              maxIter=max_iter * 5, stepSize=params.get("stepSize", 0.03), **common)
    raise ValueError(family)


def _greatest(cols):
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


# ------------------------------------------------------------------ AdaBoost

@dataclass
class AdaBoostModel:
    """SAMME ensemble of weighted decision stumps."""
    stumps: list = field(default_factory=list)
    alphas: list = field(default_factory=list)
    n_classes: int = 2
    label: str = "y"

    def transform(self, df: DataFrame) -> DataFrame:
        score = [F.lit(0.0) for _ in range(self.n_classes)]
        cur = df
        for i, (m, a) in enumerate(zip(self.stumps, self.alphas)):
            cur = m.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}").transform(cur)
            score = [s + F.when(F.col(f"_p{i}") == c, F.lit(a)).otherwise(F.lit(0.0)) for c, s in enumerate(score)]
            cur = cur.drop(f"_r{i}", f"_q{i}")
        best = F.lit(0.0)
        for c in range(1, self.n_classes):
            best = F.when(score[c] > _greatest(score[:c]), F.lit(float(c))).otherwise(best)
        return cur.withColumn("prediction", best).drop(*[f"_p{i}" for i in range(len(self.stumps))])


def fit_adaboost(df: DataFrame, label: str, learning_rate: float = 0.01, n_rounds: int = 50, n_classes: int = 2,
                 checkpoint_every: int = 10) -> AdaBoostModel:
    """SAMME: each round fits a depth-1 tree on the current weights, measures the
    weighted error (one aggregate) and re-weights misclassified rows (a projection).
    Lineage is cut with a reliable checkpoint every ``checkpoint_every`` rounds."""
    cur = df.withColumn("_aw", F.lit(1.0))
    model = AdaBoostModel(n_classes=n_classes, label=label)
    for r in range(n_rounds):
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="_aw", featuresCol=FEATURES, labelCol=label,
                                       predictionCol="_sp", rawPredictionCol="_sr", probabilityCol="_sq").fit(cur)
        scored = stump.transform(cur).withColumn("_miss", (F.col("_sp") != F.col(label)).cast("double"))
        tot = scored.agg(F.sum(F.col("_aw") * F.col("_miss")).alias("e"), F.sum("_aw").alias("w")).first()
        err = tot["e"] / tot["w"] if tot["w"] else 1.0
        if err >= 1.0 - 1.0 / n_classes:
            break
        err = max(err, 1e-12)
        alpha = learning_rate * (math.log((1 - err) / err) + math.log(n_classes - 1))
        model.stumps.append(stump)
        model.alphas.append(alpha)
        cur = scored.withColumn("_aw", F.col("_aw") * F.exp(F.lit(alpha) * F.col("_miss")) / F.lit(tot["w"])).drop(
            "_sp", "_sr", "_sq", "_miss")
        if (r + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
        if err <= 1e-12:
            break
    return model


# ----------------------------------------------------------------------- kNN

@dataclass
class KNNModel:
    """The training rows are the model; prediction is the exact block kNN vote."""
    reference: DataFrame
    features: Sequence[str]
    label: str
    key: str
    k: int = 5
    p: float = 2.0
    weights: str = "uniform"

    def transform(self, df: DataFrame) -> DataFrame:
        from sparkqc.operators import knn

        nb = knn.knn_neighbours(df, self.reference, self.key, self.features, self.label, self.k, self.p)
        votes = knn.knn_vote(nb, self.weights).select(F.col("q_key").alias(self.key), F.col("pred").cast("double").alias("prediction"))
        return df.join(votes, self.key, "left")


# ---------------------------------------------------------------- GaussianNB

@dataclass
class GaussianNBModel:
    """L5 on the assembled (wide) shape: per-class means/variances as literals (#classes x #features)."""
    theta: dict
    var: dict
    log_prior: dict

    def transform(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        classes = sorted(self.theta)
        jll = []
        for c in classes:
            s = F.lit(self.log_prior[c])
            for j, f in enumerate(features):
                v = self.var[c][j]
                s = s - F.lit(0.5 * math.log(2 * math.pi * v)) - (F.col(f) - F.lit(self.theta[c][j])) ** 2 / F.lit(2 * v)
            jll.append(s)
        best = F.lit(float(classes[0]))
        for i in range(1, len(classes)):
            best = F.when(jll[i] > _greatest(jll[:i]), F.lit(float(classes[i]))).otherwise(best)
        return df.withColumn("prediction", best)


def fit_gaussian_nb_wide(df: DataFrame, features: Sequence[str], label: str, var_smoothing: float = 1e-9) -> GaussianNBModel:
    """One aggregation by class over the feature columns (map-side combined)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}")]
    rows = df.groupBy(label).agg(*aggs).collect()  # one row per class
    tot = df.agg(*[F.var_pop(f).alias(f) for f in features]).first()
    eps = var_smoothing * max([tot[f] or 0.0 for f in features] + [0.0])
    n = sum(r["_n"] for r in rows)
    theta = {r[label]: [r[f"m_{f}"] for f in features] for r in rows}
    var = {r[label]: [(r[f"v_{f}"] or 0.0) + eps or 1e-12 for f in features] for r in rows}
    prior = {r[label]: math.log(r["_n"] / n) for r in rows}
    return GaussianNBModel(theta, var, prior)


# -------------------------------------------------------------------- fitting

def fit_model(family: str, params: dict, train: DataFrame, features: Sequence[str], label: str, seed: int = 42,
              max_iter: int = 20, key: str | None = None):
    """Fit one family on an assembled, weighted frame. Returns an object with ``transform``."""
    if family == "KNeighborsClassifier":
        if key is None:
            raise ValueError("kNN needs the row key")
        ref = cut_lineage(train.select(key, label, *features))
        return KNNModel(ref, list(features), label, key, int(params.get("n_neighbors", 5)), float(params.get("p", 2)),
                        params.get("weights", "uniform"))
    if family == "GaussianNB":
        return _Wrapped(fit_gaussian_nb_wide(train, features, label, params.get("var_smoothing", 1e-9)), features)
    if family == "AdaBoostClassifier":
        return fit_adaboost(train, label, params.get("learning_rate", 0.01), params.get("n_rounds", 50))
    if family == "RegularisedBoosting":
        return fit_boosting(train, features, label, params, seed)
    if family == "FeedForwardNetwork":
        return fit_feed_forward(train, features, label, params, seed)
    tr, sum_w = with_balanced_weight(train, label) if WEIGHT not in train.columns else (train, None)
    if family in PRUNED and "ccp_alpha" in params:
        forest = family == "RandomForestClassifier"
        tables = growing.grow(tr, features, label, WEIGHT, params["ccp_alpha"], params.get("numTrees", 50) if forest else 1, forest, seed, key, FULL_DEPTH, params.get("minInfoGain", 0.0))
        return pruning.PrunedTrees(list(features), [pruning.prune(t, params["ccp_alpha"]) for t in tables])
    if sum_w is None:
        sum_w = float(train.agg(F.sum(WEIGHT)).first()[0])
    est = make_estimator(family, params, sum_w, len(features), label, seed, max_iter)
    return est.fit(tr)


@dataclass
class _Wrapped:
    model: GaussianNBModel
    features: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df, self.features)


def predict(model, df: DataFrame, pred: str = "pred") -> DataFrame:
    out = model.transform(df)
    keep = [c for c in df.columns if c != FEATURES]
    return out.select(*keep, F.col("prediction").cast("int").alias(pred))


@dataclass
class TrialResult:
    family: str
    params: dict
    metrics: dict


def evaluate_trial(family: str, params: dict, train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   fold: str = "fold", k: int = 5, seed: int = 42, max_iter: int = 20, key: str | None = None,
                   parallelism: int = 4) -> TrialResult:
    """E5: k fold fits (train / validation scores) + one refit (train / test scores) = 8 metrics.

    Fold fits are submitted from ``parallelism`` driver threads (concurrent Spark
    jobs, like CrossValidator's parallelism); all fold predictions go into one
    table scored by one grouped aggregation.
    """
    from concurrent.futures import ThreadPoolExecutor

    if family == "FeedForwardNetwork":
        return _network_trial(params, train, test, features, label, fold, seed)
    if family == "KNeighborsClassifier":
        return _knn_trial(params, train, test, features, label, fold, k, key)
    pruned = family in PRUNED and "ccp_alpha" in params
    if pruned:  # every fit and prediction reads these rows: the join behind them runs once, and only with the columns of the trial
        tr = cut_lineage(train.select(*dict.fromkeys([*([key] if key else []), label, fold, *features])))
        te = test.select(label, *features)
    else:
        tr, te = assemble(train, features), assemble(test, features)
    tr, _ = with_balanced_weight(tr, label)

    def fold_fit(f):
        fit_part = tr.where(F.col(fold) != f)
        return f, fit_part, fit_model(family, params, fit_part, features, label, seed, max_iter, key)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        fitted = list(pool.map(fold_fit, range(1, k + 1)))
    preds = []
    for f, fit_part, m in fitted:
        preds.append(predict(m, fit_part).select(F.col(label).alias("y"), "pred", F.lit(f).alias("fold"), F.lit("train").alias("side")))
        preds.append(predict(m, tr.where(F.col(fold) == f)).select(F.col(label).alias("y"), "pred", F.lit(f).alias("fold"),
                                                                   F.lit("val").alias("side")))
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    allp = cut_lineage(allp)  # two scores read them
    cv = {r["side"]: r for r in evaluate.cv_scores(allp).collect()}
    m = fit_model(family, params, tr, features, label, seed, max_iter, key)
    full = predict(m, tr).select(F.col(label).alias("y"), "pred", F.lit("train_val").alias("part")).unionByName(
        predict(m, te).select(F.col(label).alias("y"), "pred", F.lit("test").alias("part")))
    full = cut_lineage(full)
    mm = {r["part"]: r["mcc"] for r in evaluate.mcc(full, by=["part"]).collect()}
    rr = {r["part"]: r["macro_recall"] for r in evaluate.macro_recall(full, by=["part"]).collect()}
    return TrialResult(family, params, _metrics(cv, mm, rr))


def _knn_trial(params: dict, train: DataFrame, test: DataFrame, features: Sequence[str], label: str, fold: str, k: int, key: str | None) -> TrialResult:
    """The k fold models and the refit share one join: all are the training rows without a fold or none, so the distances are the same."""
    from sparkqc.operators import knn

    if key is None:
        raise ValueError("kNN needs the row key")
    ref = cut_lineage(train.select(key, label, fold, *features))
    every = cut_lineage(ref.withColumn("part", F.lit("train_val")).unionByName(test.select(key, label, F.lit(None).cast(ref.schema[fold].dataType).alias(fold), *features).withColumn("part", F.lit("test"))))
    nb = knn.knn_neighbours_without(every, ref, key, features, label, fold, range(1, k + 1), int(params.get("n_neighbors", 5)), float(params.get("p", 2)))
    each = nb.withColumn("q_key", F.struct(F.coalesce("without", F.lit(0)).alias("without"), F.col("q_key").alias("key")))
    votes = knn.knn_vote(each, params.get("weights", "uniform")).select(F.col("q_key.without").alias("_f"), F.col("q_key.key").alias("_k"), "pred")
    folds = F.when(F.col("part") == "test", F.array(F.lit(0))).otherwise(F.array(*[F.lit(f) for f in range(k + 1)]))
    asked = every.select(F.col(key).alias("_k"), F.col(label).alias("y"), F.col(fold).alias("_own"), "part", F.explode(folds).alias("_f"))
    scored = cut_lineage(asked.join(votes, ["_k", "_f"], "left"))
    side = F.when(F.col("_own") == F.col("_f"), "val").when(F.col("_own") != F.col("_f"), "train")
    cv = {r["side"]: r for r in evaluate.cv_scores(scored.where("_f > 0").select("y", "pred", F.col("_f").alias("fold"), side.alias("side")).where("side IS NOT NULL")).collect()}
    full = scored.where("_f = 0").select("y", "pred", "part")
    mm = {r["part"]: r["mcc"] for r in evaluate.mcc(full, by=["part"]).collect()}
    rr = {r["part"]: r["macro_recall"] for r in evaluate.macro_recall(full, by=["part"]).collect()}
    return TrialResult("KNeighborsClassifier", params, _metrics(cv, mm, rr))


def _metrics(cv: dict, mm: dict, rr: dict) -> dict:
    return {"train_matthews_corrcoef": cv["train"]["mcc"], "val_matthews_corrcoef": cv["val"]["mcc"],
            "train_recall_score": cv["train"]["macro_recall"], "val_recall_score": cv["val"]["macro_recall"],
            "train_val_matthews_corrcoef": mm.get("train_val", 0.0), "test_matthews_corrcoef": mm.get("test", 0.0),
            "train_val_recall_score": rr.get("train_val", 0.0), "test_recall_score": rr.get("test", 0.0)}


def _network_trial(params: dict, train: DataFrame, test: DataFrame, features: Sequence[str], label: str, fold: str, seed: int) -> TrialResult:
    """L10's own protocol: a quarter held out and few epochs for the validation scores, then all training rows
    until the loss of the test rows stops falling."""
    from sparkqc.operators.split import stratified_split

    key = next(c for c in train.columns if c not in (*features, label, fold))
    held = cut_lineage(stratified_split(train.select(key, label, *features), label, key, 0.25, seed))
    sub, val = held.where(F.col("split") == "train"), held.where(F.col("split") == "test")
    short = fit_feed_forward(sub, features, label, {**params, "epochs": params.get("search_epochs", 5)}, seed)
    full = fit_feed_forward(train, features, label, params, seed, test)
    parts = [(short, sub, "train"), (short, val, "val"), (full, train, "train_val"), (full, test, "test")]
    scored = [predict(m, df.select(label, *features)).select(F.col(label).alias("y"), "pred", F.lit(p).alias("part")) for m, df, p in parts]
    every = scored[0].unionByName(scored[1]).unionByName(scored[2]).unionByName(scored[3])
    mm = {r["part"]: r["mcc"] for r in evaluate.mcc(every, by=["part"]).collect()}
    rr = {r["part"]: r["macro_recall"] for r in evaluate.macro_recall(every, by=["part"]).collect()}
    metrics = {f"{p}_{m}": d.get(p, 0.0) for _, _, p in parts for m, d in (("matthews_corrcoef", mm), ("recall_score", rr))}
    return TrialResult("FeedForwardNetwork", params, metrics)


#: Names of cluster dummies start so; they are in a trial's column list, but no features.
DUMMY = "cl_"

# Columns of the trial table and names of the metrics.
TRIAL_SCHEMA = ("column_list array<string>, num_features int, model_name string, best_params map<string,string>, "
                "clustering_indicator string, train_matthews_corrcoef double, val_matthews_corrcoef double, "
                "train_recall_score double, val_recall_score double, train_val_matthews_corrcoef double, "
                "test_matthews_corrcoef double, train_val_recall_score double, test_recall_score double")

METRIC_NAMES = ("train_matthews_corrcoef", "val_matthews_corrcoef", "train_recall_score", "val_recall_score",
                "train_val_matthews_corrcoef", "test_matthews_corrcoef", "train_val_recall_score", "test_recall_score")


def trial_table(spark: SparkSession, rows: list[tuple[Sequence[str], str, TrialResult]]) -> DataFrame:
    """The 13-column trial table (one row per retained trial); ``num_features`` is without cluster dummies."""
    data = [(list(cols), sum(not c.startswith(DUMMY) for c in cols), t.family, {k: str(v) for k, v in t.params.items()}, clustering,
             *[float(t.metrics[m]) for m in METRIC_NAMES]) for cols, clustering, t in rows]
    return spark.createDataFrame(data, TRIAL_SCHEMA)


def tune(family: str, train: DataFrame, test: DataFrame, features: Sequence[str], label: str, n_trials: int = 10,
         seed: int = 42, fold: str = "fold", max_iter: int = 20, key: str | None = None) -> list[TrialResult]:
    """Seeded random search; keeps the Pareto-optimal trials on (val MCC, val recall)
    and drops those no better than random on train or test (E6, E7)."""
    return [t for t in tune_front(family, train, test, features, label, n_trials, seed, fold, max_iter, key) if useful(t)]


def tune_front(family: str, train: DataFrame, test: DataFrame, features: Sequence[str], label: str, n_trials: int = 10,
               seed: int = 42, fold: str = "fold", max_iter: int = 20, key: str | None = None) -> list[TrialResult]:
    """L11 before E7: the whole Pareto front (E6), with its trials that are no better than random."""
    rng = random.Random(f"{seed}-{family}-{len(features)}")
    alphas = pruning_alphas(train, features, label) if family in PRUNED else ()
    res = [evaluate_trial(family, sample_params(family, rng, len(features), alphas), train, test, features, label, fold,
                          seed=seed, max_iter=max_iter, key=key) for _ in range(n_trials)]
    front = []
    for t in res:
        a, b = t.metrics["val_matthews_corrcoef"], t.metrics["val_recall_score"]
        dominated = any((o.metrics["val_matthews_corrcoef"] >= a and o.metrics["val_recall_score"] >= b)
                        and (o.metrics["val_matthews_corrcoef"] > a or o.metrics["val_recall_score"] > b) for o in res)
        if not dominated:
            front.append(t)
    return front


def useful(t: TrialResult) -> bool:
    """Better than random on train and test."""
    return t.metrics["train_val_matthews_corrcoef"] > 0 and t.metrics["test_matthews_corrcoef"] > 0


def learning_curve(train: DataFrame, features: Sequence[str], label: str, family: str, params: dict, key: str,
                   fold: str = "fold", fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), k: int = 5,
                   seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Macro recall on the training subset and on the held-out fold for growing
    training sizes; the subset is a prefix of the md5 order of the key (exact, reproducible)."""
    spark = train.sparkSession
    tr = assemble(train, features)
    tr, _ = with_balanced_weight(tr, label)
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    rows = []
    for f in range(1, k + 1):
        part = tr.where(F.col(fold) != f).withColumn("_h", h)
        ranked = cumulative_sums(part, [], ["_h", key], out_before="_rk", out_total="_n")
        ranked = cut_lineage(ranked)
        val = tr.where(F.col(fold) == f)
        for frac in fractions:
            sub = ranked.where(F.col("_rk") < F.ceil(F.col("_n") * F.lit(frac))).drop("_h", "_rk", "_n")
            m = fit_model(family, params, sub, features, label, seed, max_iter, key)
            a = predict(m, sub).select(F.col(label).alias("y"), "pred", F.lit("train").alias("part"))
            b = predict(m, val).select(F.col(label).alias("y"), "pred", F.lit("val").alias("part"))
            rec = {r["part"]: r["macro_recall"] for r in evaluate.macro_recall(a.unionByName(b), by=["part"]).collect()}
            rows.append((float(frac), f, sub.count(), rec.get("train"), rec.get("val")))
    df = spark.createDataFrame(rows, "fraction double, fold int, n_train long, train_recall double, val_recall double")
    return df.groupBy("fraction").agg(F.avg("n_train").alias("n_train"), F.avg("train_recall").alias("train_recall"),
                                      F.avg("val_recall").alias("val_recall"))


def final_fit(family: str, params: dict, train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
              seed: int = 42, max_iter: int = 20, key: str | None = None):
    """Refit the chosen configuration on train union test."""
    both = assemble(train.unionByName(test, allowMissingColumns=True), features)
    return fit_model(family, params, both, features, label, seed, max_iter, key)


def save_model(model, path: str) -> None:
    """Persist any fitted family: Spark ML models in their own format; naive Bayes
    parameters as JSON; AdaBoost as its stumps (Spark format) plus weights; kNN
    as its reference rows (parquet) plus parameters."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, _Wrapped):
        m = model.model
        fits.save_json(spark, {"features": list(model.features), "classes": [float(c) for c in m.theta], "theta": [m.theta[c] for c in m.theta],
                               "var": [m.var[c] for c in m.theta], "log_prior": [m.log_prior[c] for c in m.theta]}, f"{path}/gaussian_nb")
    elif isinstance(model, AdaBoostModel):
        for i, st in enumerate(model.stumps):
            st.write().overwrite().save(f"{path}/stump_{i}")
        fits.save_json(spark, {"alphas": model.alphas, "n_classes": model.n_classes, "label": model.label}, f"{path}/adaboost")
    elif isinstance(model, KNNModel):
        model.reference.write.mode("overwrite").parquet(f"{path}/reference")
        fits.save_json(spark, {"features": list(model.features), "label": model.label, "key": model.key, "k": model.k, "p": model.p, "weights": model.weights}, f"{path}/knn")
    elif isinstance(model, (boosting.BoostedModel, pruning.PrunedTrees, network.NetworkModel)):
        fits.save_json(spark, {"kind": type(model).__name__, **model.as_dict()}, f"{path}/model")
    elif hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        raise TypeError(f"cannot persist {type(model).__name__}")


_SPARK_MODELS = {
    "LogisticRegression": "LogisticRegressionModel", "LinearSVC": "LinearSVCModel",
    "RandomForestClassifier": "RandomForestClassificationModel", "DecisionTreeClassifier": "DecisionTreeClassificationModel",
    "GBTClassifier": "GBTClassificationModel", "MultilayerPerceptronClassifier": "MultilayerPerceptronClassificationModel",
}


def load_model(spark: SparkSession, family: str, path: str):
    """Inverse of ``save_model``."""
    from pyspark.ml import classification

    if family == "GaussianNB":
        d = fits.load_json(spark, f"{path}/gaussian_nb")
        cls = d["classes"]
        return _Wrapped(GaussianNBModel(dict(zip(cls, d["theta"])), dict(zip(cls, d["var"])), dict(zip(cls, d["log_prior"]))), d["features"])
    if family == "AdaBoostClassifier":
        d = fits.load_json(spark, f"{path}/adaboost")
        stumps = [classification.DecisionTreeClassificationModel.load(f"{path}/stump_{i}") for i in range(len(d["alphas"]))]
        return AdaBoostModel(stumps, d["alphas"], d["n_classes"], d["label"])
    if family == "KNeighborsClassifier":
        d = fits.load_json(spark, f"{path}/knn")
        return KNNModel(spark.read.parquet(f"{path}/reference"), d["features"], d["label"], d["key"], d["k"], d["p"], d["weights"])
    if family == "RegularisedBoosting":
        return boosting.BoostedModel.from_dict(fits.load_json(spark, f"{path}/model"))
    if family == "FeedForwardNetwork":
        return network.NetworkModel.from_dict(fits.load_json(spark, f"{path}/model"))
    if family in PRUNED and fits.exists(spark, f"{path}/model"):
        return pruning.PrunedTrees.from_dict(fits.load_json(spark, f"{path}/model"))
    return getattr(classification, _SPARK_MODELS[family]).load(path)


__all__ = ["FAMILIES", "DEFAULT_FAMILIES", "assemble", "evaluate_trial", "tune", "trial_table", "learning_curve",
           "final_fit", "fit_model", "predict", "fit_adaboost", "fit_gaussian_nb_wide", "save_model", "load_model"]
