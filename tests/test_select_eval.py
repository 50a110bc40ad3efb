"""Split quotas, evaluation formulas and model-selection branches (FIXTURES part C)."""

import pytest
from pyspark.sql import functions as F

from sparkqc.operators import cluster, dedup, evaluate, split
from sparkqc.sources.contract import name_ok


def test_split_quotas_match_committed_counts():
    # 800 / 37 rows, test 0.2 -> test 161 / 7, train 639 / 30
    assert split.split_quotas({0: 800, 1: 37}, 0.2) == {0: 161, 1: 7}


def test_stratified_split_is_exact_partition(spark):
    df = spark.createDataFrame([(i, 1 if i < 37 else 0) for i in range(837)], "k long, y int")
    s = split.stratified_split(df, "y", "k", 0.2, 42)
    c = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c == {(0, "test"): 161, (1, "test"): 7, (0, "train"): 639, (1, "train"): 30}
    again = split.stratified_split(df, "y", "k", 0.2, 42)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))  # reproducible


def test_stratified_folds_are_ntiles(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(103)], "k long, y boolean").withColumn("y", F.col("y").cast("int"))
    f = split.stratified_folds(df, "y", "k", 5, 42)
    sizes = {(r.y, r.fold): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        s = [sizes[(y, k)] for k in range(1, 6)]
        assert max(s) - min(s) <= 1 and s == sorted(s, reverse=True)


def test_classification_report_pins(spark):
    rows = [(0, 0)] * 627 + [(0, 1)] * 173 + [(1, 0)] * 10 + [(1, 1)] * 27
    df = spark.createDataFrame(rows, "y int, pred int")
    rep = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert rep["0"].recall == pytest.approx(0.78375) and rep["1"].recall == pytest.approx(0.7297, abs=1e-4)
    assert rep["0"].precision == pytest.approx(0.9843, abs=1e-4) and rep["1"].precision == pytest.approx(0.1350, abs=1e-4)
    assert rep["accuracy"].precision == pytest.approx(0.7814, abs=1e-4)
    assert rep["0"].support == 800 and rep["1"].support == 37
    m = evaluate.mcc(df).first().mcc
    assert m == pytest.approx((27 * 627 - 173 * 10) / ((27 + 173) * (27 + 10) * (627 + 173) * (627 + 10)) ** 0.5)
    assert evaluate.macro_recall(df).first().macro_recall == pytest.approx((0.78375 + 27 / 37) / 2)


def test_mcc_zero_when_margin_empty(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, pred int")
    assert evaluate.mcc(df).first().mcc == 0.0


TRIALS = "trial_id long, num_features int, clustering string, train_val_mcc double, test_mcc double, train_val_recall double, test_recall double"


def test_select_best_both_maxima(spark):
    t = spark.createDataFrame([(1, 5, "no", .5, .5, .7, .7), (2, 3, "no", .5, .5, .7, .7), (3, 9, "no", .4, .41, .6, .6)], TRIALS)
    assert evaluate.select_best(t).first().trial_id == 2  # tie on both maxima -> fewer features


def test_select_best_recall_fallback_and_tie(spark):
    t = spark.createDataFrame([(1, 5, "yes", .5, .5, .7, .7), (2, 5, "no", .3, .3, .7, .7), (3, 5, "no", .6, .6, .6, .6)], TRIALS)
    # max MCC (trial 3) and max recall (1, 2) differ -> highest recall; tie on num_features -> 'no' first
    assert evaluate.select_best(t).first().trial_id == 2


def test_select_best_empty_after_gap(spark):
    t = spark.createDataFrame([(1, 5, "no", .5, .1, .7, .7)], TRIALS)
    assert evaluate.select_best(t).count() == 0


def test_pareto_front_keeps_equal_points(spark):
    pts = [(1, .5, .5), (2, .5, .5), (3, .6, .4), (4, .4, .6), (5, .4, .4), (6, .6, .3)]
    df = spark.createDataFrame(pts, "trial_id long, a double, b double")
    got = sorted(r.trial_id for r in evaluate.pareto_front(df, "a", "b").collect())
    assert got == [1, 2, 3, 4]
    for strategy_rows in (got,):
        assert 5 not in strategy_rows and 6 not in strategy_rows


def test_cluster_dummies_keep_missing_levels(spark):
    df = spark.createDataFrame([(1, 0), (2, 2)], "k long, cluster int")  # cluster 1 absent in this batch
    out = cluster.cluster_dummies(df, "cluster", 4, "c")
    assert out.columns == ["k", "cluster", "c1", "c2", "c3"]
    assert {r.k: (r.c1, r.c2, r.c3) for r in out.collect()} == {1: (0, 0, 0), 2: (0, 1, 0)}


def test_knee_of_convex_curve(spark):
    ys = [100, 40, 20, 15, 12, 10, 9, 8.5, 8, 7.8]
    df = spark.createDataFrame([(i + 1, float(y)) for i, y in enumerate(ys)], "x int, y double")
    assert cluster.knee(df, [], "x", "y").first().knee == 3


def test_knee_of_straight_line_is_none(spark):
    df = spark.createDataFrame([(i + 1, float(10 - i)) for i in range(10)], "x int, y double")
    assert cluster.knee(df, [], "x", "y").first().knee is None


def test_dedup_survivor_is_smallest_key(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (1, "a", 1.0), (2, "b", None), (5, "b", None)], "k long, s string, v double")
    got = sorted(map(tuple, dedup.drop_duplicates(df, ["s", "v"], "k").collect()))
    assert got == [(1, "a", 1.0), (2, "b", None)]  # NULLs compare equal
    dup = dedup.duplicate_rows(spark.createDataFrame([(1,), (1,), (1,), (2,)], "a long"))
    assert sorted((r.a, r.copy_no) for r in dup.collect()) == [(1, 2), (1, 3)]


@pytest.mark.parametrize("name,ok", [("wafer_01012020_120000.csv", True), ("wafer_0101202_120000.csv", False),
                                     ("lot_01012020_120000.csv", False), ("wafer_01012020.csv", False),
                                     ("wafer_abcdefgh_ijklmn.csv.bak", True)])
def test_file_name_rule(spark, name, ok):
    df = spark.createDataFrame([(name,)], "nm string")
    assert df.select(name_ok(F.col("nm")).alias("ok")).first().ok is ok
