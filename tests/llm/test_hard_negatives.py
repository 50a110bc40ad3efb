import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.llm import hard_negatives as hn

SHAPE = "vec_id long, embedding array<double>, label int"


def brute(rows, every, positives=5, negatives=5, low=80, high=100, scale=256):
    """All products, row by row."""
    whole = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole[i, label, tuple(int(np.floor(scale * x)) for x in v)] = None
    whole = list(whole)
    out = []
    for a in whole:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2], strict=False)), b[0], b) for b in whole if b != a]
        best = sorted((s, i) for s, i, b in scored if b[1] == a[1])[:positives]
        for p, pid in best:
            fits = sorted((s, i) for s, i, b in scored if b[1] != a[1] and low * -p <= 100 * -s <= high * -p)[:negatives]
            out += [(a[0], pid, n + 1, i, -p, -s) for n, (s, i) in enumerate(fits)]
    return sorted(out)


def got(spark, rows, every, **kw):
    return sorted(tuple(r) for r in hn.mine(spark.createDataFrame(rows, SHAPE), F.col("id") % every == 0, **kw).collect())


def points(rng, n, dim=8, spread=0.3, groups=6):
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return [(int(i), [float(c) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
@pytest.mark.parametrize("blocks", [{}, {"clusters": 7, "member_block": 9, "list_block": 40}])
def test_equals_brute_force(spark, spread, blocks):
    rows = points(np.random.default_rng(3), 500, spread=spread)
    assert got(spark, rows, 7, **blocks) == brute(rows, 7)


def test_copies_ties_nulls_and_zero_vectors(spark):
    rng = np.random.default_rng(5)
    rows = points(rng, 150)
    hot = [0.5] * 8
    rows += [(1000 + i, hot, i % 2) for i in range(90)]
    rows += [(2000 + i, [0.0] * 8, i % 3) for i in range(12)]
    rows += [(3000, None, 1), (3010, [None] * 8, 1), (3020, [float("nan")] * 8, 1), (3030, [float("inf")] * 8, 0), (3040, hot, None), (None, hot, 1)]
    rows += [(1000, hot, 0), (1000, hot, 1), (1010, [0.25] * 8, 0), (4000, [], 1), (4010, [1.0, 2.0], 1)]
    want = brute([(i, v if v is None else v + [0.0] * (8 - len(v)), c) for i, v, c in rows], 10)
    assert got(spark, rows, 10) == want
    assert got(spark, rows, 10, clusters=5, member_block=4, list_block=16) == want


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6) * 1e6], int(rng.integers(0, 2))) for i in range(120)]
    assert got(spark, rows, 6) == brute(rows, 6)


def test_empty_few_and_extra_columns(spark):
    assert got(spark, [], 1) == []
    assert got(spark, [(1, [1.0], 0)], 1) == []
    rows = [(0, [1.0, 0.0], 0, "x", 1), (1, [1.0, 0.0], 0, "y", 2), (2, [0.9, 0.0], 1, None, 3)]
    found = hn.mine(spark.createDataFrame(rows, SHAPE + ", cluster string, id int"), F.col("id") % 2 == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 65536, 256 * 230)]


def test_label_noise(spark):
    rows = spark.createDataFrame([(7, 9), (14, 3), (8, 9)], "i long, c int").select(hn.shifted_label(F.col("c"), F.col("i")).alias("c")).collect()
    assert [r.c for r in rows] == [0, 4, 9]
