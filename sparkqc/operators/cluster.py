"""Clustering helpers (F5-F8): WCSS curve, knee, assignment, dummies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.operators.profile import keys
from sparkqc.session import cut_lineage

#: Rows that first centres are drawn from.
SAMPLE_ROWS = 4096


def k1_cost(long: DataFrame, col="col", value: str = "v") -> DataFrame:
    """F5 at k=1 (Spark's KMeans rejects k=1): sum over columns of sum((v - mean)^2)."""
    per = long.groupBy(*keys(col)).agg((F.var_pop(value) * F.count(value)).alias("_sse"))
    return per.agg(F.sum("_sse").alias("cost"))


@dataclass
class KMeansCurve:
    """Centres and within-cluster sum of squares of every k, and the scans of the rows that took."""

    centres: dict[int, np.ndarray]
    cost: dict[int, float]
    scans: int


def _first_centres(rows: DataFrame, k: int, seed: int, sample_rows: int) -> np.ndarray:
    """k-means++ on at most ``sample_rows`` rows in seeded hash order: centres of which every prefix starts a smaller k."""
    drawn = rows.select("_x").orderBy(F.xxhash64("_x", F.lit(seed)), "_x").limit(sample_rows).collect()
    x = np.array([r["_x"] for r in drawn], dtype=float)
    rng = np.random.default_rng(seed)
    at = [int(rng.integers(len(x)))]
    left = ((x - x[at[0]]) ** 2).sum(1)
    while len(at) < k and left.any():
        at.append(int(rng.choice(len(x), p=left / left.sum())))
        left = np.minimum(left, ((x - x[at[-1]]) ** 2).sum(1))
    return x[at]


def _move(features: DataFrame, centres: dict[int, np.ndarray], centre_of_all: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One scan for all k: per k the rows and the sums of every cluster, and the cost of the centres given."""
    width = len(centre_of_all)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {k: np.zeros(len(c), dtype=np.int64) for k, c in centres.items()}
        sums = {k: np.zeros(c.shape) for k, c in centres.items()}
        cost = {k: np.zeros(len(c)) for k, c in centres.items()}
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - centre_of_all
            for k, c in centres.items():
                gap = np.stack([((x - m) ** 2).sum(1) for m in c - centre_of_all], axis=1)
                near = gap.argmin(1)
                n[k] += np.bincount(near, minlength=len(c))
                np.add.at(sums[k], near, x)
                np.add.at(cost[k], near, gap[np.arange(len(x)), near])
        rows = [(k, j, int(n[k][j]), float(cost[k][j]), sums[k][j]) for k in centres for j in np.flatnonzero(n[k])]
        kk, jj, nn, cc, ss = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(kk, pa.int32()), pa.array(jj, pa.int32()), pa.array(nn, pa.int64()), pa.array(cc, pa.float64()),
                                          pa.array(list(ss), pa.list_(pa.float64()))], ["k", "j", "n", "cost", "sums"])

    parts = features.mapInArrow(local, "k int, j int, n long, cost double, sums array<double>")
    adds = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    got = parts.groupBy("k", "j").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *adds).collect()
    out = {k: (np.zeros(len(c), dtype=np.int64), np.zeros(c.shape), 0.0) for k, c in centres.items()}
    for r in got:
        n, sums, cost = out[r["k"]]
        n[r["j"]] = r["n"]
        sums[r["j"]] = [r[f"s{i}"] for i in range(width)]
        out[r["k"]] = n, sums, cost + r["cost"]
    return out


def kmeans_curve(features: DataFrame, vector_col: str = "features", ks: Sequence[int] = range(1, 11), seed: int = 42, max_iter: int = 20,
                 tol: float = 1e-4, sample_rows: int = SAMPLE_ROWS) -> KMeansCurve:
    """Lloyd's k-means for all ``ks`` at once.

    A scan of the rows moves the centres of every k that still moves by more than ``tol``, so a curve takes the scans of its slowest k
    instead of the sum over all. Tasks add up rows and sums per (k, cluster), at most sum(ks) rows a task; the driver sees sum(ks) rows of
    the schema's width. First centres come from a bounded hash sample (``sample_rows``); everything else covers all rows.

    Defined results: the cost is that of the returned centres over all rows; a cluster that loses its rows keeps its centre; with fewer
    distinct sampled rows than k there are fewer centres; rows with a null vector take no part; an empty table costs 0 and has no centres.
    """
    from pyspark.ml.functions import vector_to_array

    plain = features.schema[vector_col].dataType.typeName() == "array"
    x = F.col(vector_col) if plain else vector_to_array(F.col(vector_col))
    rows = cut_lineage(features.where(F.col(vector_col).isNotNull()).select(x.alias("_x")))
    head = rows.head()
    if head is None:
        return KMeansCurve({k: np.zeros((0, 0)) for k in ks}, {k: 0.0 for k in ks}, 0)
    start = _first_centres(rows, max(ks), seed, sample_rows)
    middle = start.mean(0)  # sums are taken from here, so that large offsets cost no digits
    centres = {k: start[:k] for k in ks}
    cost: dict[int, float] = {}
    moving, scans, moves = set(ks), 0, 0
    while moving:
        found = _move(rows, {k: centres[k] for k in sorted(moving)}, middle)
        scans += 1
        for k, (n, sums, spent) in found.items():
            cost[k] = spent
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None] + middle, centres[k])
            if moves >= max_iter or np.sqrt(((moved - centres[k]) ** 2).sum(1)).max() <= tol:
                moving.discard(k)  # the cost is that of these centres
            else:
                centres[k] = moved
        moves += 1
    return KMeansCurve(centres, cost, scans)


def wcss_curve(features: DataFrame, vector_col: str = "features", ks: Sequence[int] = range(1, 11), seed: int = 42,
               max_iter: int = 20) -> list[tuple[int, float]]:
    """within-cluster sum of squares for each k, all k in the same scans."""
    curve = kmeans_curve(features, vector_col, ks, seed, max_iter)
    return [(k, curve.cost[k]) for k in ks]


def centre_gaps(vector: Column, centres: np.ndarray) -> Column:
    """Squared distances of a row (array of doubles) to every centre."""
    return F.array(*[F.aggregate(F.zip_with(vector, F.lit([float(v) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) for c in centres])


def nearest_centre(vector: Column, centres: np.ndarray) -> Column:
    """the cluster of a row (array of doubles): the nearest centre, ties to the smaller number; no shuffle, no Python."""
    gaps = centre_gaps(vector, centres)
    return F.array_position(gaps, F.array_min(gaps)).cast("int") - 1


def knee(curve: DataFrame, by: Sequence[str] = (), x: str = "x", y: str = "y", sensitivity: float = 1.0) -> DataFrame:
    """knee of a convex decreasing curve, one row per curve: ``(by..., knee)``.

    Both axes are normalised to [0, 1], y is flipped, and the difference curve
    d = y' - x is scanned from its first local maximum: the threshold is the
    last local maximum minus ``sensitivity`` times the mean x step (reset to 0
    at a local minimum); the knee is the x of the last local maximum before the
    first point whose successor falls below the threshold. A curve with no such
    point has a NULL knee. Curves are tiny (one row per k), so a window per
    curve is bounded.
    """
    by = list(by)
    w_all = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    w = w_all.orderBy(x)
    c = (curve.withColumn("_xmin", F.min(x).over(w_all)).withColumn("_xmax", F.max(x).over(w_all))
         .withColumn("_ymin", F.min(y).over(w_all)).withColumn("_ymax", F.max(y).over(w_all))
         .withColumn("_m", F.count(F.lit(1)).over(w_all)))
    xn = (F.col(x) - F.col("_xmin")) / (F.col("_xmax") - F.col("_xmin"))
    yn = (F.col(y) - F.col("_ymin")) / (F.col("_ymax") - F.col("_ymin"))
    c = c.withColumn("_xn", xn).withColumn("_d", (F.lit(1.0) - yn) - xn)
    prev = F.coalesce(F.lag("_d").over(w), F.col("_d"))
    nxt = F.coalesce(F.lead("_d").over(w), F.col("_d"))
    c = c.withColumn("_is_max", (F.col("_d") >= prev) & (F.col("_d") >= nxt)).withColumn(
        "_is_min", (F.col("_d") <= prev) & (F.col("_d") <= nxt)).withColumn("_next", F.lead("_d").over(w))
    tmx = F.col("_d") - F.lit(sensitivity) / (F.col("_m") - 1)
    ev = F.when(F.col("_is_min"), F.lit(0.0)).when(F.col("_is_max"), tmx)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    c = (c.withColumn("_thr", F.last(ev, ignorenulls=True).over(upto))
         .withColumn("_tx", F.last(F.when(F.col("_is_max"), F.col(x)), ignorenulls=True).over(upto)))
    cand = F.col("_tx").isNotNull() & (F.col("_xn") < 1.0) & (F.col("_next") < F.col("_thr"))
    c = c.withColumn("_knee_at", F.when(cand, F.struct(F.col(x).alias("at"), F.col("_tx").alias("k"))))
    res = c.groupBy(*by).agg(F.min("_knee_at").alias("_kk"))
    return res.select(*by, F.col("_kk")["k"].alias("knee"))


def fit_kmeans(features: DataFrame, k: int, vector_col: str = "features", seed: int = 42, max_iter: int = 20):
    """F7 fit."""
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, seed=seed, featuresCol=vector_col, maxIter=max_iter, predictionCol="cluster").fit(features)


def cluster_dummies(df: DataFrame, cluster_col: str, k: int, prefix: str = "") -> DataFrame:
    """F8: one-hot of the cluster id with the first level dropped; the k levels come
    from the fitted model, so a batch missing a cluster keeps every column."""
    return df.select("*", *[F.when(F.col(cluster_col) == i, 1).otherwise(0).alias(f"{prefix}{i}") for i in range(1, k)])
