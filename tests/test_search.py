"""The model search where trials are no better than random (E7), and what is chosen then."""

import pytest

from sparkqc.operators import learn
from sparkqc.plans.train import final_model, search

SCHEMA = "k long, y int, x1 double, x2 double"


def part(spark, start, rows):
    return spark.createDataFrame([(start + i, y, float(a), float(b)) for i, (y, a, b) in enumerate(rows)], SCHEMA)


def searched(spark, train, test):
    with pytest.warns(UserWarning, match="no trial was better than random"):
        return search(train, test, "k", "y", ["x1", "x2"], [], ks=(2,), families=("GaussianNB",), clustering=("no",), n_trials=2, max_iter=5)


def test_search_ends_where_the_test_rows_contradict_the_training_rows(spark):
    sides = [(i % 2, (i % 2) * 2 - 1 + 0.1 * (i % 7), 0.1 * (i % 5)) for i in range(60)]
    train, test = part(spark, 0, sides), part(spark, 1000, [(1 - y, a, b) for y, a, b in sides[:20]])
    res = searched(spark, train, test)
    assert res.trials.count() == 0
    best = res.best.collect()
    assert len(best) == 1 and best[0].train_val_matthews_corrcoef == 1.0 and best[0].test_matthews_corrcoef == -1.0
    model, base, fam, _, km, n_cl = final_model(train, test, "k", "y", res)
    assert (sorted(base), fam, km, n_cl) == (["x1", "x2"], "GaussianNB", None, 0)
    assert learn.predict(model, learn.assemble(train.unionByName(test), base)).count() == 80


def test_search_ends_where_one_class_is_always_predicted(spark):
    """The Matthews correlations are 0, by which the gap of a trial can't be divided."""
    rows = [(int(i % 10 == 0), i // 10 % 3, i // 30 % 2) for i in range(120)]  # each class has the same features
    res = searched(spark, part(spark, 0, rows), part(spark, 1000, rows[:60]))
    best = res.best.first()
    assert (best.train_val_matthews_corrcoef, best.test_matthews_corrcoef, best.test_recall_score) == (0.0, 0.0, 0.5)


def test_a_useful_trial_is_chosen_before_any_other(spark, monkeypatch):
    score = dict.fromkeys(learn.METRIC_NAMES, 0.9)
    front = {"GaussianNB": learn.TrialResult("GaussianNB", {"var_smoothing": 0.5}, {**score, "train_val_matthews_corrcoef": -0.1}),
             "LinearSVC": learn.TrialResult("LinearSVC", {"C": 0.5}, {**score, "test_matthews_corrcoef": 0.1, "test_recall_score": 0.6})}
    monkeypatch.setattr(learn, "tune_front", lambda family, *args, **more: [front[family]])
    train = part(spark, 0, [(i % 2, i % 2, i % 3) for i in range(30)])
    res = search(train, train, "k", "y", ["x1", "x2"], [], ks=(2,), families=tuple(front), clustering=("no",), n_trials=1)
    assert [r.model_name for r in res.trials.collect()] == ["LinearSVC"] and res.best.first().model_name == "LinearSVC"
