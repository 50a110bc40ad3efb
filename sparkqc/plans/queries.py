"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or views derived from them) in full.
Double outputs are rounded to 6 decimals (``finish``) so that they compare
equal to the DuckDB oracle regardless of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sparkqc.functions import transforms as tfn
from sparkqc.functions.stats import round6
from sparkqc.operators import cluster, dedup, evaluate, features, missing, naive_bayes, normality, outliers, profile, split
from sparkqc.operators import transforms as tops
from sparkqc.operators.shape import to_long
from sparkqc.plans import fixtures as fx
from sparkqc.sources import ingest
from sparkqc.sources.contract import contract_from_dict, name_ok, sensor_contract

DELIVERY_CONTRACT = contract_from_dict(sensor_contract(n_sensors=3))

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def finish(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals, fold -0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round6(F.col(f.name).cast("double")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def lineitem_long(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.table(spark, sf, "lineitem").select(*LINEITEM_NUM)
    return to_long(li, [], LINEITEM_NUM)


def q_missing_profile(spark, sf):
    return finish(profile.missing_profile(fx.holes_view(spark, sf), col="pos"))


def q_column_moments(spark, sf):
    m = profile.moments(lineitem_long(spark, sf))
    return finish(m.select("col", "n", "mean", "std_samp", "std_pop", "min", "max"))


def q_column_quantiles(spark, sf):
    return finish(profile.quantiles(lineitem_long(spark, sf), (0.25, 0.5, 0.75), names=("q25", "q50", "q75")))


def q_column_skew_kurt(spark, sf):
    ev = fx.table(spark, sf, "events").select("value")
    lg = lineitem_long(spark, sf).unionByName(to_long(ev, [], ["value"]))
    return finish(profile.moments(lg).select("col", "n", "skew", "kurt"))


def q_iqr_bounds(spark, sf):
    return finish(outliers.iqr_bounds(lineitem_long(spark, sf)))


def q_gaussian_bounds(spark, sf):
    return finish(outliers.gaussian_bounds(lineitem_long(spark, sf)))


def q_outlier_report_iqr(spark, sf):
    lg = lineitem_long(spark, sf)
    return finish(outliers.outlier_report(lg, outliers.iqr_bounds(lg)))


def q_outlier_report_gaussian(spark, sf):
    lg = lineitem_long(spark, sf)
    return finish(outliers.outlier_report(lg, outliers.gaussian_bounds(lg)))


def _events_long(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", F.lit("value").alias("col"), F.col("value").alias("v"))


def _cap_events(spark, sf, method):
    """O4 fitted on the long shape, applied as one wide projection with literal bounds (no join)."""
    fit = outliers.collect_fit(outliers.fit_capper(_events_long(spark, sf), method))  # one row per column
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return finish(outliers.cap_wide(ev, fit).select("event_id", F.col("value").alias("v")))


def q_cap_iqr(spark, sf):
    """O4 'iqr' (fold 1.5) fitted and applied on events.value."""
    return _cap_events(spark, sf, "iqr")


def q_cap_gaussian(spark, sf):
    """O4 'gaussian' (fold 3, sample std) fitted and applied on events.value."""
    return _cap_events(spark, sf, "gaussian")


# ------------------------------------------------------------- missing values

def q_rows_with_missing(spark, sf):
    return profile.rows_with_missing(fx.holes_view(spark, sf), "vec_id", col="pos")


def q_missingness_corr(spark, sf):
    r = missing.missingness_corr(fx.holes_view(spark, sf), "vec_id", col="pos", slot="vec_id")
    return finish(r.select(F.col("col_a").alias("pos_a"), F.col("col_b").alias("pos_b"), "r"))


def q_impute_plan(spark, sf):
    return finish(missing.impute_plan(fx.sensor_holes_view(spark, sf), "vec_id", col="pos", order=fx.SENSORS, slot="vec_id"))


def _impute_query(spark, sf, strategy):
    h = fx.holes_view(spark, sf)
    fit = missing.fit_simple_imputer(h, strategy, col="pos")
    return finish(missing.impute_long(h, fit, col="pos").select("vec_id", "pos", "v"))


def q_impute_mean(spark, sf):
    return _impute_query(spark, sf, "mean")


def q_impute_median(spark, sf):
    return _impute_query(spark, sf, "median")


def q_imputation_report(spark, sf):
    return missing.imputation_report(missing.impute_plan(fx.sensor_holes_view(spark, sf), "vec_id", col="pos", order=fx.SENSORS, slot="vec_id"), "pos")


def q_drop_constant(spark, sf):
    """P8 apply: the long frame without its constant columns (rows per column)."""
    h = fx.holes_view(spark, sf)
    kept = features.drop_constant_long(h, features.constant_columns(h, col="pos"), col="pos")
    return kept.groupBy("pos").agg(F.count(F.lit(1)).alias("n_rows"))


def q_constant_columns(spark, sf):
    return features.constant_columns(fx.holes_view(spark, sf), col="pos")


# ---------------------------------------------------------------- normality

def q_anderson_normal(spark, sf):
    return finish(normality.anderson_normal(fx.long_view(spark, sf), col="pos"))


def q_anderson_holes(spark, sf):
    return finish(normality.anderson_normal(fx.holes_view(spark, sf), col="pos"))


# ---------------------------------------------------------------- transforms

def _totalprice(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))


def q_transform_log(spark, sf):
    return finish(_totalprice(spark, sf).select("o_orderkey", tfn.log_t(F.col("v")).alias("v")))


def q_transform_reciprocal(spark, sf):
    return finish(_totalprice(spark, sf).select("o_orderkey", tfn.reciprocal_t(F.col("v")).alias("v")))


def q_transform_sqrt(spark, sf):
    return finish(_totalprice(spark, sf).select("o_orderkey", tfn.sqrt_t(F.col("v")).alias("v")))


def q_transform_square(spark, sf):
    c = fx.table(spark, sf, "customer")
    return finish(c.select("c_custkey", tfn.square_t(F.col("c_acctbal")).alias("v")))


def q_transform_yeo_johnson(spark, sf):
    c = fx.table(spark, sf, "customer")
    v = F.col("c_acctbal")
    return finish(c.select("c_custkey", tfn.yeo_johnson_t(v, 0.0).alias("yj_0"), tfn.yeo_johnson_t(v, 0.5).alias("yj_05"),
                           tfn.yeo_johnson_t(v, 2.0).alias("yj_2")))


def skewed_view(spark, sf):
    """Columns made skewed in known ways: exp (log fixes), shifted square (root fixes),
    shifted reciprocal (reciprocal fixes), negative-valued exp (log impossible)."""
    lg = fx.long_view(spark, sf)
    v, pos = F.col("v"), F.col("pos")
    m = pos % 4
    sv = (F.when(m == 0, F.exp(F.lit(8.0) * v)).when(m == 1, (v + F.lit(0.6)) * (v + F.lit(0.6)))
          .when(m == 2, F.lit(1.0) / (v + F.lit(0.6))).otherwise(F.exp(F.lit(4.0) * v) - F.lit(1.0)))
    return lg.select("vec_id", "y", "pos", sv.alias("v"))


CLOSED_FORM_TYPES = ("logarithmic", "reciprocal", "square-root", "square")


def q_score_transforms(spark, sf):
    return finish(tops.score_transforms(skewed_view(spark, sf), col="pos", types=CLOSED_FORM_TYPES))


def q_pick_transform_alphabetical(spark, sf):
    s = tops.score_transforms(skewed_view(spark, sf), col="pos", types=CLOSED_FORM_TYPES)
    return finish(tops.pick_transform(s, "pos", "alphabetical"))


def q_pick_transform_best(spark, sf):
    s = tops.score_transforms(skewed_view(spark, sf), col="pos", types=CLOSED_FORM_TYPES)
    return finish(tops.pick_transform(s, "pos", "best"))


def q_score_transforms_all(spark, sf):
    """T6 with all five candidates, Yeo-Johnson with its fitted lambda."""
    return finish(tops.score_transforms(skewed_view(spark, sf), col="pos"))


def q_pick_transform_all(spark, sf):
    return finish(tops.pick_transform(tops.score_transforms(skewed_view(spark, sf), col="pos"), "pos", "alphabetical"))


def q_fit_yeo_johnson(spark, sf):
    return finish(tops.fit_yeo_johnson(skewed_view(spark, sf), "pos"))


# ------------------------------------------------------------------ dedup

EVENT_COLS = ["event_id", "user_id", "event_type", "value", "props"]


def q_drop_duplicates(spark, sf):
    return finish(dedup.drop_duplicates(fx.events_dup_view(spark, sf).select(*EVENT_COLS)))


def q_duplicate_rows(spark, sf):
    return finish(dedup.duplicate_rows(fx.events_dup_view(spark, sf).select(*EVENT_COLS)))


def q_append_compile(spark, sf):
    """S3 + S4: the same delivery appended twice to a parquet table in the shared
    checkpoint folder (history accumulates), then compiled with SELECT DISTINCT."""
    import uuid

    from sparkqc.session import ensure_checkpoint_dir
    from sparkqc.sources import ingest

    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/tables/events-{uuid.uuid4().hex}"
    batch = fx.events_dup_view(spark, sf).select(*EVENT_COLS)
    ingest.append_table(batch, path)
    ingest.append_table(batch, path)
    return finish(ingest.compile_table(spark, path))


def q_delivery_history(spark, sf):
    """S3 + S4: a narrow delivery, one with a later column, and the first one replayed, kept as distinct rows under a schema log."""
    import uuid

    from sparkqc.session import ensure_checkpoint_dir
    from sparkqc.sources import history

    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/tables/history-{uuid.uuid4().hex}"
    events = fx.events_dup_view(spark, sf)
    narrow = events.where("event_type <> 'purchase'").select("event_id", "user_id", "event_type", "value")
    for delivery in (narrow, events.select(*EVENT_COLS), narrow):
        history.append_new(spark, delivery, path)
    return finish(history.read_history(spark, path))


def q_distinct_union(spark, sf):
    a = fx.table(spark, sf, "events").select("user_id", "event_type")
    b = fx.events_dup_view(spark, sf).select("user_id", "event_type")
    return dedup.distinct_rows(dedup.union_rows(a, b))


# ------------------------------------------------------------------ split

def q_stratified_split(spark, sf):
    w = fx.wide_view(spark, sf).select("vec_id", "y")
    return split.stratified_split(w, "y", "vec_id", 0.2, 42)


def q_stratified_folds(spark, sf):
    w = fx.wide_view(spark, sf).select("vec_id", "y")
    return split.stratified_folds(w, "y", "vec_id", 5, 42)


def q_class_weights(spark, sf):
    return finish(profile.class_counts(fx.wide_view(spark, sf).select("vec_id", "y"), "y"))


def q_recode_label(spark, sf):
    w = fx.wide_view(spark, sf).select("vec_id", F.when(F.col("y") == 1, 1).otherwise(-1).alias("raw_y"))
    return features.recode_label(w.withColumn("y", F.col("raw_y")), "y")


# ---------------------------------------------------------------- features

def q_anova_f(spark, sf):
    return finish(features.anova_f(fx.long_view(spark, sf), "y", col="pos").select("pos", "f"))


def q_select_k_best(spark, sf):
    a = features.anova_f(fx.long_view(spark, sf), "y", col="pos")
    return finish(features.select_k_best(a, 10, "pos").select("pos", "f"))


def q_standardise(spark, sf):
    lg = fx.long_view(spark, sf)
    return finish(features.apply_affine_long(lg, features.fit_standardiser(lg, "pos"), "pos").select("vec_id", "pos", "v"))


def q_minmax(spark, sf):
    lg = fx.long_view(spark, sf)
    return finish(features.apply_affine_long(lg, features.fit_minmax(lg, "pos"), "pos").select("vec_id", "pos", "v"))


def q_scale_split(spark, sf):
    lg = skewed_view(spark, sf)
    normal, _ = normality.normal_split(normality.anderson_normal(lg, "pos"), "pos")
    fit = features.fit_scale_split(lg, normal, "pos")
    return finish(features.apply_affine_long(lg, fit, "pos").select("vec_id", "pos", "v"))


def q_kmeans_k1_cost(spark, sf):
    return finish(cluster.k1_cost(fx.long_view(spark, sf), "pos"))


def quantisation_curve(spark, sf):
    """Per column, the sum of squared errors of an equal-width k-bucketing, k = 1..10
    (a data-derived convex decreasing curve for the knee)."""
    lg = fx.long_view(spark, sf)
    rng = lg.groupBy("pos").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    ex = lg.join(rng, "pos").select("pos", "v", "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("k"))
    b = F.least(F.floor((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("k")), F.col("k") - 1)
    sse = ex.withColumn("b", b).groupBy("pos", "k", "b").agg((F.var_pop("v") * F.count("v")).alias("sse"))
    return sse.groupBy("pos", "k").agg(F.sum("sse").alias("wcss"))


def q_knee(spark, sf):
    k = cluster.knee(quantisation_curve(spark, sf), ["pos"], "k", "wcss")
    return k.select("pos", F.col("knee").cast("bigint").alias("knee"))


def q_cluster_dummies(spark, sf):
    emb = fx.table(spark, sf, "embeddings").select("vec_id", "label")
    k = emb.agg(F.max("label")).first()[0] + 1  # levels of the fitted model (one number)
    return cluster.cluster_dummies(emb, "label", int(k), prefix="c").drop("label")


def q_gaussian_nb_score(spark, sf):
    lg = fx.long_view(spark, sf)
    model, priors = naive_bayes.fit_gaussian_nb(lg, "y", "pos", "v", "vec_id")
    return finish(naive_bayes.score_gaussian_nb(lg, model, priors, "vec_id", "pos", "v").select("vec_id", "pred"))


# -------------------------------------------------------------- evaluation

def q_confusion(spark, sf):
    return evaluate.confusion(fx.preds_view(spark, sf))


def q_mcc(spark, sf):
    return finish(evaluate.mcc(fx.preds_view(spark, sf)))


def q_macro_recall(spark, sf):
    return finish(evaluate.macro_recall(fx.preds_view(spark, sf)))


def q_classification_report(spark, sf):
    return finish(evaluate.classification_report(fx.preds_view(spark, sf)))


def q_cv_scores(spark, sf):
    return finish(evaluate.cv_scores(fx.preds_view(spark, sf)))


TRIAL_OUT = ["trial_id", "val_mcc", "val_recall", "train_val_mcc", "test_mcc", "train_val_recall", "test_recall"]


def q_pareto_front(spark, sf):
    return finish(evaluate.pareto_front(fx.trials_view(spark, sf), "val_mcc", "val_recall").select(*TRIAL_OUT))


def q_drop_useless(spark, sf):
    return finish(evaluate.drop_useless(fx.trials_view(spark, sf)).select(*TRIAL_OUT))


def q_select_best(spark, sf):
    t = evaluate.drop_useless(fx.trials_view(spark, sf))
    return finish(evaluate.select_best(t).select(*TRIAL_OUT, "num_features", "clustering"))


def q_leaderboard(spark, sf):
    t = fx.trials_view(spark, sf).select("trial_id", "test_mcc")
    return finish(evaluate.leaderboard(t, "test_mcc", "trial_id"))


# ------------------------------------------------------------- file checks

def q_file_name_check(spark, sf):
    n = fx.names_view(spark, sf)
    return n.select("page_id", "nm", name_ok(F.col("nm")).alias("ok"))


def q_file_verdicts(spark, sf):
    n = fx.names_view(spark, sf)
    per_file = n.groupBy("nm").agg(F.count(F.lit(1)).alias("n_deliveries"))
    ok = name_ok(F.col("nm"))
    return per_file.select("nm", "n_deliveries", ok.alias("ok"),
                           F.when(~ok, F.lit("invalid file name")).alias("reason"))


def _ingest(part: str):
    def q(spark, sf):
        return ingest.validate_batches(spark, fx.deliveries(spark, sf), DELIVERY_CONTRACT)[part]
    return q


def q_delivery_rejected(spark, sf):
    return _ingest("rejected_rows")(spark, sf).select("file_name", "Wafer", F.col("_bad_reason").alias("reason"))


def q_header_widths(spark, sf):
    return ingest.header_widths(spark, fx.deliveries(spark, sf))


def q_all_null_columns(spark, sf):
    cells = ingest.normalise_nulls(ingest.read_batches(spark, fx.deliveries(spark, sf), DELIVERY_CONTRACT), DELIVERY_CONTRACT.columns)
    return ingest.all_null_columns(cells, DELIVERY_CONTRACT.columns)


def q_knn_vote(spark, sf):
    """Leave-one-out 5-NN vote of the 10-class label over all items (Euclidean)."""
    from sparkqc.operators import knn

    emb = fx.table(spark, sf, "embeddings").select("vec_id", "label")
    w = fx.wide_view(spark, sf).join(emb, "vec_id")
    nb = knn.knn_neighbours(w, w, "vec_id", [f"e{i}" for i in range(1, fx.N_DIMS + 1)], "label", k=5, p=2.0,
                            exclude_self=True)
    return knn.knn_vote(nb).select(F.col("q_key").alias("vec_id"), "pred")


# ------------------------------------------------ learning jobs (rows-only)

WIDE_FEATS = [f"e{i}" for i in range(1, fx.N_DIMS + 1)]


def _split_wide(spark, sf):
    """Stratified train/test of the wide view with 5 stratified folds on train."""
    from sparkqc.session import cut_lineage

    w = split.stratified_split(fx.wide_view(spark, sf), "y", "vec_id", 0.2, 42)
    w = cut_lineage(w)
    train = split.stratified_folds(w.where(F.col("split") == "train").drop("split"), "y", "vec_id", 5, 42)
    return train, w.where(F.col("split") == "test").drop("split")


def _trial_query(family: str, params: dict, n_features: int = 16):
    def q(spark, sf):
        from sparkqc.operators import learn

        train, test = _split_wide(spark, sf)
        ranking = features.ranked_features(features.anova_f(fx.long_view(spark, sf), "y", col="pos"), "pos")
        feats = [f"e{p}" for p in ranking[:n_features]]
        t = learn.evaluate_trial(family, params, train, test, feats, "y", max_iter=10, key="vec_id")
        return finish(learn.trial_table(spark, [(feats, "no", t)]))
    return q


def q_iterative_impute(spark, sf):
    from sparkqc.operators.iterative import fit_iterative_imputer

    _, out = fit_iterative_imputer(fx.holes_wide_view(spark, sf), WIDE_FEATS, max_iter=10)
    return finish(out)


def q_joint_impute_cells(spark, sf):
    """Every column of the view with gaps after imputation: cells seen, changed, filled and left empty."""
    from sparkqc.operators.joint_impute import apply_joint, fit_joint_imputer

    holes = fx.holes_wide_view(spark, sf)
    fit = fit_joint_imputer(holes, WIDE_FEATS)
    both = apply_joint(holes.select("*", *[F.col(c).alias(f"seen_{c}") for c in WIDE_FEATS]), fit)
    count = lambda cond: F.count_if(cond)
    cells = both.agg(*[F.struct(
        F.lit(i + 1).cast("long").alias("pos"), F.count(f"seen_{c}").alias("n_observed"), count(F.col(f"seen_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"seen_{c}"))).alias("n_changed"),
        count(F.col(f"seen_{c}").isNull() & F.col(c).isNotNull() & ~F.isnan(c)).alias("n_filled"), count(F.col(c).isNull() | F.isnan(c)).alias("n_left")).alias(c) for i, c in enumerate(WIDE_FEATS)])
    return cells.select(F.inline(F.array(*WIDE_FEATS)))


def q_joint_impute_line(spark, sf):
    """One column with gaps and one whole column: the model's fixed point is the regression line of the complete rows."""
    from sparkqc.operators.joint_impute import apply_joint, fit_joint_imputer

    pair = fx.holes_wide_view(spark, sf).select("vec_id", "e5", "e10")
    return finish(apply_joint(pair, fit_joint_imputer(pair, ["e5", "e10"], max_iter=60, prior_rows=0.0, tol=1e-11)))


def q_kmeans_nearest(spark, sf):
    """Items per run of k-means (k = 4) that do not lie in the cluster of their nearest centre."""
    from sparkqc.operators import learn

    vec = learn.assemble(fx.wide_view(spark, sf), WIDE_FEATS)
    model = cluster.fit_kmeans(vec, 4, seed=42)
    centres = model.stages[-1].clusterCenters() if hasattr(model, "stages") else model.clusterCenters()
    far = F.array(*[sum((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(WIDE_FEATS, centre, strict=True)) for centre in centres])
    found = model.transform(vec).select("cluster", far.alias("far")).withColumn("own", F.get("far", F.col("cluster").cast("int")))
    return found.agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("cluster").alias("n_clusters"),
                     F.count_if(F.coalesce(F.col("own") > F.array_min("far") + 1e-9, F.lit(True))).alias("n_not_nearest"))


def q_kmeans_assign(spark, sf):
    from sparkqc.operators import learn

    vec = learn.assemble(fx.wide_view(spark, sf), WIDE_FEATS)
    model = cluster.fit_kmeans(vec, 4, seed=42)
    return model.transform(vec).select("vec_id", "cluster")


def q_sketch_quantiles(spark, sf):
    """A4: sketches of two deliveries merged; is every quantile's rank over all rows within 3 % of the one asked for?"""
    from sparkqc.operators import sketches

    lg = fx.long_view(spark, sf).where("v IS NOT NULL")
    old, new = (sketches.column_sketches(lg.where(f"pmod(vec_id, 2) = {half}"), "pos") for half in (0, 1))
    asked = sketches.sketch_quantiles(sketches.merge_sketches(old, new, "pos"), [0.05, 0.25, 0.5, 0.75, 0.95], "pos")
    near = lg.join(F.broadcast(asked), "pos").groupBy("pos", "p").agg(  # five rows a column
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("q")).alias("below"), F.count_if(F.col("v") <= F.col("q")).alias("upto"))
    holds = (F.col("below") / F.col("n") <= F.col("p") + 0.03) & (F.col("upto") / F.col("n") >= F.col("p") - 0.03)
    return finish(near.select("pos", "p", F.col("n").alias("n_values"), holds.alias("rank_holds")))


def q_kmeans_curve(spark, sf):
    """Per k: the cost at k = 1, whether the costs recomputed from the centres agree, and whether none is above that of k = 1."""
    rows = fx.wide_view(spark, sf).select(F.array(*[F.col(c).cast("double") for c in WIDE_FEATS]).alias("x"))
    found = cluster.kmeans_curve(rows, "x", range(1, 11))
    costs = rows.agg(F.count(F.lit(1)).alias("n_items"), *[F.sum(F.array_min(cluster.centre_gaps(F.col("x"), c))).alias(f"c{k}") for k, c in found.centres.items()])
    told = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(found.cost[k]).alias("told"), F.col(f"c{k}").alias("cost")) for k in found.cost]))
    per = costs.select("n_items", told.alias("t")).select("n_items", "t.*")
    return finish(per.select("k", "n_items", F.when(F.col("k") == 1, F.col("told")).alias("first_cost"),
                             (F.abs(F.col("told") - F.col("cost")) <= 1e-9 * F.col("cost")).alias("cost_agrees"),
                             (F.col("told") <= F.lit(found.cost[1])).alias("not_above")))


def q_kmeans_knee(spark, sf):
    from sparkqc.operators import learn

    vec = learn.assemble(fx.wide_view(spark, sf), WIDE_FEATS)
    costs = cluster.wcss_curve(vec, ks=range(1, 11), seed=42)
    curve = spark.createDataFrame(costs, "k int, wcss double")
    return cluster.knee(curve, [], "k", "wcss").withColumn("points", F.lit(len(costs)).cast("long"))


def q_learning_curve(spark, sf):
    from sparkqc.operators import learn

    train, _ = _split_wide(spark, sf)
    return finish(learn.learning_curve(train, WIDE_FEATS, "y", "GaussianNB", {"var_smoothing": 1e-9}, "vec_id"))


def q_preprocess_train(spark, sf):
    from sparkqc.plans.train import fit_preprocess

    fit, train, _ = fit_preprocess(fx.holes_wide_view(spark, sf), "vec_id", "y", relabel=False)
    return finish(train)


def q_final_score(spark, sf):
    """E-2 + E-3 end to end: fit the chain and a model on the wide view, then score every item."""
    from sparkqc.plans import score as sc
    from sparkqc.plans.train import final_model, fit_preprocess, search

    data = fx.holes_wide_view(spark, sf)
    prep, train, test = fit_preprocess(data, "vec_id", "y", relabel=False)
    res = search(train, test, "vec_id", "y", prep.normal, prep.non_normal, ks=(8,), families=("LogisticRegression",),
                 clustering=("yes",), n_trials=1, max_iter=10)
    model, base, fam, _, km, n_cl = final_model(train, test, "vec_id", "y", res)
    sm = sc.ScoringModel(prep, res.scaler, base, fam, model, km, n_cl)
    return sc.score(sc.preprocess_new(data.drop("y"), prep), sm)


# Trees of the queries below, as (feature, threshold, left, right, value) per node.
BOOSTED_TREES = (((0, 0.0, 1, 2, 0.0), (1, 0.05, 3, 4, 0.0), (2, -0.05, 5, 6, 0.0), (-1, 0.0, -1, -1, 0.5), (-1, 0.0, -1, -1, -0.25), (-1, 0.0, -1, -1, 0.125), (-1, 0.0, -1, -1, -1.0)),
                 ((3, 0.1, 1, 2, 0.0), (-1, 0.0, -1, -1, 0.75), (0, -0.1, 3, 4, 0.0), (-1, 0.0, -1, -1, -0.5), (-1, 0.0, -1, -1, 0.0625)))
PRUNE_ALPHA = 0.0005


def _tree(nodes):
    import numpy as np

    from sparkqc.operators.trees import Tree

    f, t, le, r, v = (list(c) for c in zip(*nodes, strict=True))
    return Tree(np.array(f), np.array(t), np.zeros(len(f), bool), np.array(le), np.array(r), np.array(v)[:, None])


def q_boosted_margins(spark, sf):
    """Margins of two fixed trees."""
    from sparkqc.operators.boosting import BoostedModel

    model = BoostedModel(["e1", "e2", "e3", "e4"], [_tree(t) for t in BOOSTED_TREES], bias=0.25)
    return finish(model.transform(fx.wide_view(spark, sf).select("vec_id", "e1", "e2", "e3", "e4")).select("vec_id", "margin", F.col("prediction").cast("int").alias("pred")))


BOOST_BINS = 16


def q_boosted_root_split(spark, sf):
    """Best first split of every column, from the gradient sums of the first round."""
    from sparkqc.operators import boosting as bo

    long = fx.long_view(spark, sf).select(F.concat(F.lit("e"), F.col("pos")).alias("col"), "v")
    cuts = {**{c: [] for c in WIDE_FEATS}, **{r["col"]: r["cuts"] for r in bo.long_cuts(long, BOOST_BINS).collect()}}
    rows = bo.binned_rows(fx.wide_view(spark, sf), WIDE_FEATS, "y", cuts)
    penalty = bo.Penalty(lambda_=1.5, alpha=0.5, min_child_weight=2.0, max_delta_step=1.0)
    best = bo.best_splits(bo.split_gains(bo.gradient_sums(rows, len(WIDE_FEATS)), penalty), ["col"])
    return finish(best.select((F.col("col") + 1).cast("long").alias("pos"), F.col("bin").cast("long").alias("bin"), "gain", "gl", "hl", "gr", "hr"))


def q_pruned_tree(spark, sf):
    """A fixed tree, measured and pruned on the rows; class of every row."""
    from sparkqc.operators import pruning

    feats, wide = ["e1", "e2", "e3"], fx.wide_view(spark, sf)
    table = pruning.prune(pruning.measured(_tree(BOOSTED_TREES[0]), wide, feats, "y", 2), PRUNE_ALPHA)
    scored = pruning.PrunedTrees(feats, [table]).transform(wide.select("vec_id", *feats))
    return finish(scored.select("vec_id", F.lit(len(table.parent)).cast("long").alias("n_nodes"), F.get("probability", F.lit(1)).alias("share")))


QUERIES = {
    "missing_profile": q_missing_profile,
    "column_moments": q_column_moments,
    "column_quantiles": q_column_quantiles,
    "column_skew_kurt": q_column_skew_kurt,
    "iqr_bounds": q_iqr_bounds,
    "gaussian_bounds": q_gaussian_bounds,
    "outlier_report_iqr": q_outlier_report_iqr,
    "outlier_report_gaussian": q_outlier_report_gaussian,
    "rows_with_missing": q_rows_with_missing,
    "missingness_corr": q_missingness_corr,
    "impute_plan": q_impute_plan,
    "impute_mean": q_impute_mean,
    "impute_median": q_impute_median,
    "constant_columns": q_constant_columns,
    "imputation_report": q_imputation_report,
    "drop_constant": q_drop_constant,
    "cap_iqr": q_cap_iqr,
    "cap_gaussian": q_cap_gaussian,
    "append_compile": q_append_compile,
    "delivery_history": q_delivery_history,
    "anderson_normal": q_anderson_normal,
    "anderson_holes": q_anderson_holes,
    "transform_log": q_transform_log,
    "transform_reciprocal": q_transform_reciprocal,
    "transform_sqrt": q_transform_sqrt,
    "transform_square": q_transform_square,
    "transform_yeo_johnson": q_transform_yeo_johnson,
    "score_transforms": q_score_transforms,
    "pick_transform_alphabetical": q_pick_transform_alphabetical,
    "pick_transform_best": q_pick_transform_best,
    "fit_yeo_johnson": q_fit_yeo_johnson,
    "score_transforms_all": q_score_transforms_all,
    "pick_transform_all": q_pick_transform_all,
    "drop_duplicates": q_drop_duplicates,
    "duplicate_rows": q_duplicate_rows,
    "distinct_union": q_distinct_union,
    "stratified_split": q_stratified_split,
    "stratified_folds": q_stratified_folds,
    "class_weights": q_class_weights,
    "recode_label": q_recode_label,
    "anova_f": q_anova_f,
    "select_k_best": q_select_k_best,
    "standardise": q_standardise,
    "minmax": q_minmax,
    "scale_split": q_scale_split,
    "kmeans_k1_cost": q_kmeans_k1_cost,
    "knee": q_knee,
    "cluster_dummies": q_cluster_dummies,
    "gaussian_nb_score": q_gaussian_nb_score,
    "confusion": q_confusion,
    "mcc": q_mcc,
    "macro_recall": q_macro_recall,
    "classification_report": q_classification_report,
    "cv_scores": q_cv_scores,
    "pareto_front": q_pareto_front,
    "drop_useless": q_drop_useless,
    "select_best": q_select_best,
    "leaderboard": q_leaderboard,
    "file_name_check": q_file_name_check,
    "file_verdicts": q_file_verdicts,
    "delivery_verdicts": _ingest("verdicts"),
    "delivery_good_rows": _ingest("good"),
    "delivery_rejected_rows": q_delivery_rejected,
    "header_widths": q_header_widths,
    "all_null_columns": q_all_null_columns,
    "knn_vote": q_knn_vote,
    "iterative_impute": q_iterative_impute,
    "joint_impute_cells": q_joint_impute_cells,
    "joint_impute_line": q_joint_impute_line,
    "kmeans_nearest": q_kmeans_nearest,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_knee": q_kmeans_knee,
    "kmeans_curve": q_kmeans_curve,
    "sketch_quantiles": q_sketch_quantiles,
    "logistic_regression_scores": _trial_query("LogisticRegression", {"C": 0.5}),
    "linear_svc_scores": _trial_query("LinearSVC", {"C": 0.0236}),
    "decision_tree_scores": _trial_query("DecisionTreeClassifier", {"maxDepth": 4}),
    "rf_scores": _trial_query("RandomForestClassifier", {"numTrees": 20, "maxDepth": 5}),
    "gbt_scores": _trial_query("GBTClassifier", {"maxIter": 10, "maxDepth": 3}),
    "naive_bayes_scores": _trial_query("GaussianNB", {"var_smoothing": 1e-9}),
    "adaboost_scores": _trial_query("AdaBoostClassifier", {"learning_rate": 0.01, "n_rounds": 5}),
    "mlp_scores": _trial_query("MultilayerPerceptronClassifier", {"hidden": [8]}),
    "boosted_margins": q_boosted_margins,
    "boosted_root_split": q_boosted_root_split,
    "pruned_tree": q_pruned_tree,
    "boosted_scores": _trial_query("RegularisedBoosting", {"eta": 0.3, "lambda": 1.5, "alpha": 0.5, "gamma": 1.0, "colsample_bytree": 0.5, "subsample": 0.8, "rounds": 3, "max_depth": 3}),
    "pruned_tree_scores": _trial_query("DecisionTreeClassifier", {"ccp_alpha": 0.002}),
    "pruned_forest_scores": _trial_query("RandomForestClassifier", {"ccp_alpha": 0.005, "numTrees": 20}),
    "network_scores": _trial_query("FeedForwardNetwork", {"units": [32, 32], "activation": "selu", "batch_normalization": True, "dropout": 0.1, "epochs": 5}),
    "knn_scores": _trial_query("KNeighborsClassifier", {"n_neighbors": 5, "weights": "distance", "p": 1}),
    "learning_curve": q_learning_curve,
    "preprocess_train": q_preprocess_train,
    "final_score": q_final_score,
}
