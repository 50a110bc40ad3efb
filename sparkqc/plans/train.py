"""End-to-end training plan (E-2): preprocessing fits, reports and model search.

Fits are computed on the long shape (one grouped aggregation per statistic,
keyed by column); applying them is one wide projection with literal
parameters (fit tables have one row per column, bounded by the schema). Each
stage's output is checkpointed so later plans do not re-run earlier stages.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.functions.transforms import TRANSFORM_TYPES
from sparkqc.operators import dedup, features, missing, normality, outliers, profile, split
from sparkqc.operators import transforms as tops
from sparkqc.operators.iterative import IterativeImputerFit, apply_iterative, fit_iterative_imputer
from sparkqc.operators.joint_impute import JointImputerFit, apply_joint, fit_joint_imputer
from sparkqc.operators.shape import to_long
from sparkqc.session import cut_lineage, drop_garbage

# Reasons written to the column-drop log.
REASON_ID = "Irrelevant column"
REASON_MISSING = "More than 80% missing values"
REASON_CONSTANT = "Constant variance"


@dataclass
class PreprocessFit:
    key: str
    label: str
    features: list                      # feature columns entering the chain (id excluded)
    dropped_missing: list = field(default_factory=list)
    simple_fill: dict = field(default_factory=dict)     # mean / median imputation
    fallback_fill: dict = field(default_factory=dict)   # train mean of every column
    iterative: IterativeImputerFit | None = None
    joint: JointImputerFit | None = None
    cap_iqr: dict = field(default_factory=dict)
    cap_gaussian: dict = field(default_factory=dict)
    constant: list = field(default_factory=list)
    transforms: dict = field(default_factory=dict)      # col -> (type, lam)
    normal: list = field(default_factory=list)
    non_normal: list = field(default_factory=list)
    reports: dict = field(default_factory=dict)

    @property
    def output_features(self) -> list:
        drop = set(self.dropped_missing) | set(self.constant)
        return [c for c in self.features if c not in drop]

    def apply(self, df: DataFrame) -> DataFrame:
        """X1 (after dedup): replay drops, imputation, capping, constant drop and transforms
        as projections only (no shuffle)."""
        out = df.drop(*self.dropped_missing)
        out = missing.impute_wide(out, self.simple_fill)
        if self.iterative is not None:
            out = apply_iterative(out, self.iterative)
        if self.joint is not None:
            out = apply_joint(out, self.joint)
        out = missing.impute_wide(out, {c: v for c, v in self.fallback_fill.items() if c in out.columns})
        out = outliers.cap_wide(out, self.cap_iqr)
        out = outliers.cap_wide(out, self.cap_gaussian)
        out = out.drop(*self.constant)
        return tops.apply_transforms_wide(out, self.transforms)


def _long(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return to_long(df.select(key, *cols), [key], list(cols))


def _normal_split(df: DataFrame, key: str, cols: Sequence[str]) -> tuple[list, list]:
    if not cols:
        return [], []
    normal = set(normality.normal_split(normality.anderson_normal(_long(df, key, cols), "col"), "col")[0])
    return [c for c in cols if c in normal], [c for c in cols if c not in normal]  # in the order of the columns


def fit_preprocess(data: DataFrame, key: str, label: str, id_cols: Sequence[str] = (), test_size: float = 0.2,
                   seed: int = 42, iterative_rounds: int = 10, transform_types: Sequence[str] = TRANSFORM_TYPES,
                   relabel: bool = True, imputer: str = "joint") -> tuple[PreprocessFit, DataFrame, DataFrame]:
    """E-2 steps 1-4. ``data`` is wide: key, id columns, features, label.

    Returns (fit, train, test), with train/test already transformed.
    """
    spark = data.sparkSession
    feats = [c for c in data.columns if c not in (key, label, *id_cols)]
    reports: dict[str, DataFrame] = {}
    # P1 + D1: drop the id, keep one of each fully-equal row (deterministic by key)
    without_id, id_log = features.drop_columns(data, id_cols, REASON_ID)
    drop_log = []
    base = dedup.drop_duplicates(without_id, subset=[*feats, label], order_key=key)
    if relabel:
        base = features.recode_label(base, label)
    base = cut_lineage(base)  # the split reads it three times
    # Exact stratified split
    sp = cut_lineage(split.stratified_split(base, label, key, test_size, seed))
    train = sp.where(F.col("split") == "train").drop("split")
    test = sp.where(F.col("split") == "test").drop("split")
    fit = PreprocessFit(key, label, feats)

    # M1: plan on train
    lt = _long(train, key, feats)
    numbered = to_long(train.withColumn("_slot", F.monotonically_increasing_id()), [key, "_slot"], feats)
    reports["duplicate_rows"] = dedup.duplicate_rows(data.select(*feats, label))
    reports["rows_with_missing"] = profile.rows_with_missing_wide(sp, feats)
    reports["missing_profile"] = missing.missing_profile(lt)
    plan = {r["col"]: r["strategy"] for r in missing.impute_plan(numbered, key, order=feats, slot="_slot").collect()}  # one row per column
    fit.dropped_missing = [c for c in feats if plan.get(c) == "drop"]
    drop_log += [(c, REASON_MISSING) for c in fit.dropped_missing]
    kept = [c for c in feats if c not in fit.dropped_missing]
    reports["imputation_methods"] = spark.createDataFrame(
        [(c, s) for c, s in plan.items() if s != "drop"], "Column_Name string, Impute_Strategy string")
    lk = lt.where(F.col("col").isin(kept))
    # M2: mean / median fills; fallback mean for every column (NULLs first seen later)
    for strat in ("mean", "median"):
        cols = [c for c in kept if plan.get(c) == strat]
        if cols:
            f = missing.fit_simple_imputer(lk.where(F.col("col").isin(cols)), strat)
            fit.simple_fill.update({r["col"]: r["fill"] for r in f.collect()})
    fit.fallback_fill = {r["col"]: r["fill"] for r in missing.fit_simple_imputer(lk, "mean").collect()}
    train = missing.impute_wide(train.drop(*fit.dropped_missing), fit.simple_fill)
    test = missing.impute_wide(test.drop(*fit.dropped_missing), fit.simple_fill)
    # M3: regression imputation when planned (imputes every remaining NULL column), by the joint model or in rounds
    if imputer not in ("joint", "rounds"):
        raise ValueError(f"unknown imputer {imputer!r}")
    regress = any(plan.get(c) == "iterative" for c in kept)
    if regress and imputer == "joint":
        fit.joint = fit_joint_imputer(train, kept)
        train, test = apply_joint(train, fit.joint), apply_joint(test, fit.joint)
    elif regress:
        fit.iterative, train = fit_iterative_imputer(train, kept, max_iter=iterative_rounds)
        test = apply_iterative(test, fit.iterative)
    train = cut_lineage(missing.impute_wide(train, fit.fallback_fill))
    test = cut_lineage(missing.impute_wide(test, fit.fallback_fill))

    # T9 + O3 + O4: normal split, outlier reports, capping fitted on train
    normal, non_normal = _normal_split(train, key, kept)
    lt = _long(train, key, kept)
    iqr = profile.small_table(outliers.fit_capper(lt.where(F.col("col").isin(non_normal)), "iqr"))  # the report's bounds too: ranked once
    reports["outliers_non_gaussian"] = outliers.outlier_report(lt.where(F.col("col").isin(non_normal)), iqr)
    reports["outliers_gaussian"] = outliers.outlier_report(lt.where(F.col("col").isin(normal)),
                                                           outliers.gaussian_bounds(lt.where(F.col("col").isin(normal))))
    fit.cap_iqr = outliers.collect_fit(iqr)
    fit.cap_gaussian = outliers.collect_fit(outliers.fit_capper(lt.where(F.col("col").isin(normal)), "gaussian"))
    train = outliers.cap_wide(outliers.cap_wide(train, fit.cap_iqr), fit.cap_gaussian)
    test = outliers.cap_wide(outliers.cap_wide(test, fit.cap_iqr), fit.cap_gaussian)
    train = cut_lineage(train)
    # Constant columns after capping
    fit.constant = [r["col"] for r in features.constant_columns(_long(train, key, kept)).collect()]
    drop_log += [(c, REASON_CONSTANT) for c in fit.constant]
    kept = [c for c in kept if c not in fit.constant]
    train, test = train.drop(*fit.constant), test.drop(*fit.constant)

    # T9 + T6/T7/T8: transform search on non-normal columns (gated on train and test)
    normal, non_normal = _normal_split(train, key, kept)
    if non_normal:
        ltr = _long(train, key, non_normal)
        lte = _long(test, key, non_normal)
        yj = tops.fit_yeo_johnson(ltr, "col") if "yeo-johnson" in transform_types else None
        scores = cut_lineage(tops.score_transforms(ltr, lte, "col", types=transform_types, yj=yj))
        best = tops.pick_transform(scores, "col", "alphabetical")
        lam = {r["col"]: r["lam"] for r in yj.collect()} if yj is not None else {}
        fit.transforms = {r["col"]: (r["type"], lam.get(r["col"]) if r["type"] == "yeo-johnson" else None) for r in best.collect()}
        reports["transform_scores"] = scores
        reports["best_transformation"] = best
    train = cut_lineage(tops.apply_transforms_wide(train, fit.transforms))
    test = cut_lineage(tops.apply_transforms_wide(test, fit.transforms))
    fit.normal, fit.non_normal = _normal_split(train, key, kept)
    reports["columns_dropped"] = id_log.unionByName(spark.createDataFrame(drop_log, id_log.schema))
    reports["train_set"], reports["test_set"] = train, test
    fit.reports = reports
    return fit, train, test


# ------------------------------------------------------------- model search

# The largest number of features and the trials of each configuration.
MAX_FEATURES = 50
N_TRIALS = 50


@dataclass
class SearchResult:
    trials: DataFrame
    best: DataFrame
    ranking: list
    scaler: dict
    kmeans: dict = field(default_factory=dict)   # number of features of a trial, without dummies -> (model, n_clusters)


def fit_scaler(train: DataFrame, key: str, normal: Sequence[str], non_normal: Sequence[str]) -> dict:
    """F3 fit as literals: {col: (centre, scale)}."""
    cols = [*normal, *non_normal]
    fit = features.fit_scale_split(_long(train, key, cols), list(normal))
    return {r["col"]: (r["mean"], r["scale"]) for r in fit.collect()}


def model_frame(df: DataFrame, scaler: dict, feats: Sequence[str], family: str, km=None, n_clusters: int = 0,
                keep: Sequence[str] = ()) -> tuple[DataFrame, list]:
    """Model input for one family: raw and scaled copies of ``feats`` side by side,
    cluster dummies from k-means on the scaled copy (same rows, no join), and the
    list of columns the family uses (scaled for LR/SVC/kNN/MLP, raw otherwise)."""
    from pyspark.ml.feature import VectorAssembler

    s_name = {c: f"_s_{c}" for c in feats}
    frame = df.select(*keep, *feats, *[features.affine(c, scaler).alias(s_name[c]) for c in feats])
    use = features.choose_scaled(family, [s_name[c] for c in feats], list(feats))
    if km is not None:
        vec = VectorAssembler(inputCols=[s_name[c] for c in feats], outputCol="_kvec").transform(frame)
        frame = km.copy().setFeaturesCol("_kvec").setPredictionCol("cluster").transform(vec).drop("_kvec")
        frame = cluster_dummies_frame(frame, n_clusters)
        use += [f"cl_{i}" for i in range(1, n_clusters)]
    return frame, use


def cluster_dummies_frame(frame: DataFrame, n_clusters: int) -> DataFrame:
    from sparkqc.operators import cluster

    return cluster.cluster_dummies(frame, "cluster", n_clusters, "cl_").drop("cluster")


def search(train: DataFrame, test: DataFrame, key: str, label: str, normal: Sequence[str], non_normal: Sequence[str],
           ks: Sequence[int] | None = None, families: Sequence[str] | None = None,
           clustering: Sequence[str] = ("no", "yes"), n_trials: int = N_TRIALS, folds: int = 5, seed: int = 42,
           threshold: float = 0.10, max_iter: int = 100) -> SearchResult:
    """Feature count x clustering x family grid; ANOVA ranking computed once
    (F is invariant to the per-column affine scaling) and prefixes taken per k.
    Scaled families see scaled features, the others raw ones (P6).

    By default the whole space is searched: 1 to 50 features, all families, with and without clusters, 50 trials each;
    ``ks``, ``families``, ``clustering`` and ``n_trials`` shorten it.

    Trials no better than random are not considered (E7). Where a search has no other, the best of them is taken, with a
    warning; ``trials`` is empty then, and ``best`` holds its scores."""
    from sparkqc.operators import cluster, evaluate, learn

    ks = ks or range(1, MAX_FEATURES + 1)
    families = families or learn.FAMILIES
    cols = [*normal, *non_normal]
    scaler = fit_scaler(train, key, normal, non_normal)
    x, y = features.split_features_label(train, label, key)
    ranking = features.ranked_features(features.anova_f(_long(x, key, cols).join(y, key), label))
    tr = cut_lineage(split.stratified_folds(train, label, key, folds, seed))
    rows, useless = [], []
    kmeans = {}
    for k in sorted({min(k, len(ranking)) for k in ks}):  # no more features than there are
        top = set(ranking[:k])
        feats = [c for c in cols if c in top]  # k best by F, kept in the original column order
        for cl in clustering:
            km, n_cl = None, 0
            if cl == "yes":
                s_tr, _ = model_frame(tr, scaler, feats, "LinearSVC")
                vec = learn.assemble(s_tr, [f"_s_{c}" for c in feats])
                curve = cluster.wcss_curve(vec, ks=range(1, 11), seed=seed, max_iter=max_iter)
                cdf = train.sparkSession.createDataFrame(curve, "x int, y double")
                kn = cluster.knee(cdf, [], "x", "y").first()["knee"]
                n_cl = int(kn) if kn is not None else 2
                km = cluster.fit_kmeans(vec, n_cl, seed=seed, max_iter=max_iter)
                kmeans[len(feats)] = (km, n_cl)
            drop_garbage(train.sparkSession)
            for fam in families:
                f_tr, use = model_frame(tr, scaler, feats, fam, km, n_cl, keep=(key, label, "fold"))
                f_te, _ = model_frame(test, scaler, feats, fam, km, n_cl, keep=(key, label))
                f_tr = cut_lineage(f_tr)
                names = [c[3:] if c.startswith("_s_") else c for c in use]
                for t in learn.tune_front(fam, f_tr, f_te, use, label, n_trials, seed, "fold", max_iter, key=key):
                    (rows if learn.useful(t) else useless).append((names, cl, t))
    numbered = lambda found: learn.trial_table(train.sparkSession, found).withColumn("trial_id", F.monotonically_increasing_id())
    trials = numbered(rows)
    if not rows:
        warnings.warn("no trial was better than random on both train and test: the best of the others is taken", stacklevel=2)
    named = (trials if rows else numbered(useless)).withColumnRenamed("clustering_indicator", "clustering")
    pick = dict(test_mcc="test_matthews_corrcoef", test_rec="test_recall_score", order=("num_features", "clustering"),
                tie="trial_id", train_mcc="train_val_matthews_corrcoef", train_rec="train_val_recall_score")
    best = cut_lineage(evaluate.select_best(named, threshold if rows else None, **pick))
    if best.isEmpty():  # no trial within the gap: keep the best one anyway instead of failing
        best = cut_lineage(evaluate.select_best(named, None, **pick))
    return SearchResult(trials, best, ranking, scaler, kmeans)


def final_model(train: DataFrame, test: DataFrame, key: str, label: str, res: SearchResult, max_iter: int = 10):
    """L13 for the selected trial: (model, base features, family, kmeans, n_clusters)."""
    from sparkqc.operators import learn

    best = res.best.first()
    if best is None:
        raise RuntimeError("the search made no trial")
    chosen = list(best["column_list"])
    base = [c for c in chosen if not c.startswith("cl_")]
    fam = best["model_name"]
    params = {k: _num(v) for k, v in best["best_params"].items()}
    km, n_cl = res.kmeans.get(len(base), (None, 0)) if any(c.startswith("cl_") for c in chosen) else (None, 0)
    f_tr, use = model_frame(train, res.scaler, base, fam, km, n_cl, keep=(key, label))
    f_te, _ = model_frame(test, res.scaler, base, fam, km, n_cl, keep=(key, label))
    model = learn.final_fit(fam, params, f_tr, f_te, use, label, max_iter=max_iter, key=key)
    return model, base, fam, params, km, n_cl


def _num(v):
    try:
        f = float(v)
    except (TypeError, ValueError):
        return v
    return int(f) if f.is_integer() and "." not in str(v) and "e" not in str(v).lower() else f
