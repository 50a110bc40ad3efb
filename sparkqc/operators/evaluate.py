"""Evaluation and model selection as DataFrame operators.

Metrics are conditional counts (one partial aggregation over the predictions
table, grouped by whatever splits the caller needs: fold, side, trial).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.functions.stats import mcc_from_counts
from sparkqc.operators.ranking import cumulative_sums, running_max_before


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Counts per (y, pred)."""
    return df.groupBy(*by, y, pred).agg(F.count(F.lit(1)).alias("n"))


def _counts(df: DataFrame, y: str, pred: str, by: Sequence[str]):
    yy, pp = F.col(y), F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 0)).alias("tn"),
        F.count_if((yy == 0) & (pp == 1)).alias("fp"), F.count_if((yy == 1) & (pp == 0)).alias("fn"))


def mcc(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Matthews correlation per group (binary labels 0/1); 0 when a margin is empty."""
    c = _counts(df, y, pred, by)
    return c.select(*by, mcc_from_counts(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn")).alias("mcc"))


def macro_recall(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Mean over classes of per-class recall."""
    per = df.groupBy(*by, y).agg(F.avg((F.col(pred) == F.col(y)).cast("double")).alias("_rec"))
    return per.groupBy(*by).agg(F.avg("_rec").alias("macro_recall"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """``(label, precision, recall, f1_score, support)`` per class, then
    accuracy, macro avg and weighted avg rows (sklearn layout)."""
    per_true = df.groupBy(F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("support"),
                                                       F.count_if(F.col(pred) == F.col(y)).alias("tp"))
    per_pred = df.groupBy(F.col(pred).alias("label")).agg(F.count(F.lit(1)).alias("npred"))
    labels = per_true.select("label").unionByName(per_pred.select("label")).distinct()  # one row per class
    cls = (labels.join(F.broadcast(per_true), "label", "left").join(F.broadcast(per_pred), "label", "left")
           .fillna(0, ["support", "tp", "npred"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.when(F.col("npred") > 0, F.col("npred"))), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.when(F.col("support") > 0, F.col("support"))), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.when(F.col("precision") + F.col("recall") > 0, F.col("precision") + F.col("recall"))), F.lit(0.0))
    cls = cls.withColumn("precision", prec).withColumn("recall", rec).withColumn("f1_score", f1)
    tot = cls.agg(F.sum("support").alias("n"), F.sum("tp").alias("ntp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    n = F.col("n").cast("double")
    acc = tot.select(F.lit("accuracy").alias("label"), (F.col("ntp") / n).alias("precision"), (F.col("ntp") / n).alias("recall"),
                     (F.col("ntp") / n).alias("f1_score"), n.alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1_score"), n.alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), (F.col("wp") / n).alias("precision"), (F.col("wr") / n).alias("recall"),
                          (F.col("wf") / n).alias("f1_score"), n.alias("support"))
    per = cls.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1_score", F.col("support").cast("double"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def cv_scores(df: DataFrame, y: str = "y", pred: str = "pred", fold: str = "fold", side: str = "side",
              by: Sequence[str] = ()) -> DataFrame:
    """E5: per (group, side) the mean over folds of MCC and macro recall."""
    keys = [*by, side, fold]
    m = mcc(df, y, pred, keys).join(F.broadcast(macro_recall(df, y, pred, keys)), keys)  # one row per (side, fold)
    return m.groupBy(*by, side).agg(F.avg("mcc").alias("mcc"), F.avg("macro_recall").alias("macro_recall"),
                                    F.count(F.lit(1)).alias("n_folds"))


def pareto_front(trials: DataFrame, a: str, b: str) -> DataFrame:
    """Non-dominated rows for maximising (a, b); equal points all stay.

    Row t is dominated iff some row has a > t.a and b >= t.b, or a == t.a and
    b > t.b. Per distinct a: best b in that group, and the running max of b
    over strictly larger a (skew-safe scan): no pairwise comparison of rows.
    """
    per_a = trials.groupBy(a).agg(F.max(b).alias("_best_b"))
    scan = running_max_before(per_a, [], [F.desc(a)], "_best_b", out="_above")
    j = trials.join(scan, a)
    keep = (F.col(b) >= F.col("_best_b")) & (F.col("_above").isNull() | (F.col(b) > F.col("_above")))
    return j.where(keep).drop("_best_b", "_above")


def drop_useless(trials: DataFrame, train_mcc: str = "train_val_mcc", test_mcc: str = "test_mcc") -> DataFrame:
    """Discard trials no better than random on train or test."""
    return trials.where((F.col(train_mcc) > 0) & (F.col(test_mcc) > 0))


def gap_filter(trials: DataFrame, threshold: float = 0.10, train_mcc: str = "train_val_mcc", test_mcc: str = "test_mcc",
               train_rec: str = "train_val_recall", test_rec: str = "test_recall") -> DataFrame:
    """Relative train/test gap below ``threshold`` on both metrics."""
    gap_m = F.abs(F.col(train_mcc) - F.col(test_mcc)) / F.col(train_mcc)
    gap_r = F.abs(F.col(train_rec) - F.col(test_rec)) / F.col(train_rec)
    return trials.where((gap_m < threshold) & (gap_r < threshold))


def select_best(trials: DataFrame, threshold: float | None = 0.10, test_mcc: str = "test_mcc", test_rec: str = "test_recall",
                order: Sequence[str] = ("num_features", "clustering"), tie: str = "trial_id",
                train_mcc: str = "train_val_mcc", train_rec: str = "train_val_recall") -> DataFrame:
    """E8 (+W2, W3): after the gap filter, rows holding both maxima; if none, rows
    with the maximum test recall; ordered by ``order`` then ``tie``; first row.
    Without a ``threshold`` there is no gap filter. Empty input gives an empty result (no exception)."""
    g = trials if threshold is None else gap_filter(trials, threshold, train_mcc, test_mcc, train_rec, test_rec)
    mx = g.agg(F.max(test_mcc).alias("_mm"), F.max(test_rec).alias("_mr")).first()  # one row, partial aggregate
    if mx is None or mx["_mr"] is None:
        return g.limit(0)
    both = (F.col(test_mcc) == F.lit(mx["_mm"])) & (F.col(test_rec) == F.lit(mx["_mr"]))
    cands = g.where(F.col(test_rec) == F.lit(mx["_mr"])).withColumn("_pri", F.when(both, 0).otherwise(1))
    return cands.orderBy("_pri", *order, tie).limit(1).drop("_pri")


def leaderboard(trials: DataFrame, metric: str = "test_mcc", tie: str = "trial_id") -> DataFrame:
    """Trials with their ``rank`` by a metric (descending, ties by id); dealt by range, not one task."""
    ranked = cumulative_sums(trials.select(tie, metric), [], [F.desc(metric), F.asc(tie)], out_before="_before", out_total="_n")
    return ranked.select(tie, metric, (F.col("_before") + 1).alias("rank"))
