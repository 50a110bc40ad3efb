"""k-means for all k in common scans against a numpy twin."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkqc.operators import cluster


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    return np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((1000, 0), (1006, 0), (1000, 6), (1006, 6))])


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>").repartition(3)


def test_curve_costs_and_centres(spark, points):
    curve = cluster.kmeans_curve(frame(spark, points), "x", range(1, 6), max_iter=15)
    assert curve.scans <= 16
    for k in range(1, 6):
        gap = ((points[:, None] - curve.centres[k][None]) ** 2).sum(2)
        assert curve.cost[k] == pytest.approx(gap.min(1).sum(), rel=1e-9)
        near = gap.argmin(1)  # settled centres are the means of their rows
        assert max(np.abs(points[near == j].mean(0) - c).max() for j, c in enumerate(curve.centres[k]) if (near == j).any()) < 1e-3
    assert curve.cost[1] == pytest.approx(((points - points.mean(0)) ** 2).sum())
    assert curve.cost[4] < curve.cost[1] / 50


def test_vectors_null_rows_and_assignment(spark, points):
    df = frame(spark, points).unionByName(spark.createDataFrame([(-1, None)], "id long, x array<double>"))
    vec = df.select("id", F.when(F.col("x").isNotNull(), array_to_vector("x")).alias("features"), F.lit("e").alias("_x"))
    as_array, as_vector = cluster.kmeans_curve(df, "x", [4]), cluster.kmeans_curve(vec, ks=[4])
    assert as_array.cost[4] == pytest.approx(as_vector.cost[4])
    told = {r.id: r.c for r in df.where("id >= 0").select("id", cluster.nearest_centre(F.col("x"), as_array.centres[4]).alias("c")).collect()}
    want = ((points[:, None] - as_array.centres[4][None]) ** 2).sum(2).argmin(1)
    assert [told[i] for i in range(len(points))] == want.tolist()


def test_empty_and_equal_rows(spark):
    assert cluster.wcss_curve(frame(spark, np.zeros((0, 2))), "x", [1, 2]) == [(1, 0.0), (2, 0.0)]
    same = cluster.kmeans_curve(frame(spark, np.ones((5, 2))), "x", [1, 3])
    assert same.cost == {1: 0.0, 3: 0.0} and len(same.centres[3]) == 1
