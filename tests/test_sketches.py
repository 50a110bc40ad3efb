"""Quantile sketches: rank error, merging, nulls."""

import numpy as np

from sparkqc.operators import sketches

PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    x = np.sort(rng.lognormal(size=8000))
    rows = [("a", float(v)) for v in rng.permutation(x)] + [("b", 1.0), ("b", None), ("c", None)]
    long = spark.createDataFrame(rows, "col string, v double").repartition(4)
    whole = None
    for part in long.randomSplit([0.3, 0.3, 0.4], seed=1):
        new = sketches.column_sketches(part)
        whole = new if whole is None else sketches.merge_sketches(whole, new)
    assert {r.col: r.n for r in whole.collect()} == {"a": 8000, "b": 1}
    got = {(r.col, r.p): r.q for r in sketches.sketch_quantiles(whole, PROBS).collect()}
    for p in PROBS:
        assert abs(np.searchsorted(x, got["a", p]) / len(x) - p) < 0.03
        assert got["b", p] == 1.0


def test_empty(spark):
    none = sketches.column_sketches(spark.createDataFrame([], "col string, v double"))
    assert sketches.merge_sketches(none, none).count() == 0
