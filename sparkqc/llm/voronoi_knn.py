"""Exact top-k search by a Voronoi kNN join.

1. Pivots, a bounded hash sample, cut the space into cells; each vector belongs to its nearest pivot.
2. Summaries: of each cell the largest distance to its pivot and the k + 1 smallest. They give every query a
   lower bound of its k-th best score: for a member x of a cell with pivot p, <q, x> >= <q, p> - |q| |x - p|.
3. Bounds per group: queries are grouped by their cells. For group and cell, the smallest distance to the pivot at which a vector
   can still reach some query's bound, from <q, x> <= <q, p> + |q| |x - p|.
4. Only the vectors at such a distance are replicated to the group, in blocks of bounded size; each block is solved with
   exact integer products, and the blocks' best are merged.

Scores are integer inner products of floor(scale * x). Floating-point bounds are widened by their rounding error, so no
result depends on them. Pivots, summaries and group bounds are at most PIVOTS squared rows; only those reach the driver.

Defined results: a null id, a null vector or one with null or non-finite components takes no part; a shorter vector counts as
padded with zeros; ties go to the smaller id; equal ids are all found, a query never finds a row of its own id. Rows that share a
query's id are queries of their own: each has its own list. Products beyond 64 bits are cut to the largest long. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.llm.common import staged
from sparkqc.llm.vectors import dimension, groups, matrix, pivots, usable

SCALE = 1024
PIVOTS = 16
QUERY_BLOCK = 1024
DATA_BLOCK = 8192
EXACT = 2 ** 53


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles while these are exact, else in Python's integers."""
    bound = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * max(1, q.shape[1])
    if bound < EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return np.clip(q.astype(object) @ x.astype(object).T, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)


def _assign(rows: DataFrame, centres: np.ndarray, dim: int) -> DataFrame:
    """``(id, v, cell, far)``: the nearest pivot and the distance to it."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix(part.column(1), dim)
                square = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]
                cell = square.argmin(1)
                far = np.sqrt(((x - c[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell, pa.int64()), pa.array(far)], names=["id", "v", "cell", "far"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<long>, cell long, far double")


def _summaries(data: DataFrame, k: int) -> tuple[dict[int, float], dict[int, list[tuple[float, int]]]]:
    """Largest and k + 1 smallest distances of each cell, these with their ids: at most PIVOTS * (k + 2) values."""
    radius = {r["cell"]: r["r"] for r in data.groupBy("cell").agg(F.max("far").alias("r")).collect()}
    near = Window.partitionBy("cell").orderBy("far", "id")
    least = data.select("cell", "far", "id").withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= k + 1)
    smallest: dict[int, list[tuple[float, int]]] = {}
    for r in least.select("cell", "far", "id").collect():
        smallest.setdefault(r["cell"], []).append((r["far"], r["id"]))
    return radius, smallest


def _group_bounds(queries: DataFrame, centres: np.ndarray, radius: dict[int, float], smallest: dict[int, list[tuple[float, int]]], k: int, dim: int) -> DataFrame:
    """``(grp, cell, reach)``: vectors of the cell from this distance on may be among the best of some query of the group."""
    shared = queries.sparkSession.sparkContext.broadcast((centres, radius, smallest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, far, near = shared.value
        cells = np.array(sorted(far))
        least = [(cell, d) for cell in cells for d, _ in near[cell]]
        owner = np.array([i for cell in cells for _, i in near[cell]])
        reach_of: dict[tuple[int, int], float] = {}
        for batch in batches:
            grp = batch.column(2).to_numpy()
            q = matrix(batch.column(1), dim)
            length = np.sqrt((q * q).sum(1))
            dots = q @ c.T
            lower = np.stack([dots[:, cell] - length * d for cell, d in least], 1)
            lower[batch.column(0).to_numpy()[:, None] == owner[None, :]] = -np.inf  # rows of its own id are no candidates
            if lower.shape[1] >= k:
                best = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
            else:
                best = np.full(len(q), -np.inf)
            slack = 1e-9 * (1 + length[:, None] * (1 + np.sqrt((c[cells] ** 2).sum(1))[None, :] + np.array([far[x] for x in cells])[None, :]))
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = (best[:, None] - dots[:, cells] - slack) / length[:, None]
            reach = np.where(length[:, None] > 0, reach, -np.inf) - 1e-6
            for g in np.unique(grp):
                for cell, r in zip(cells.tolist(), reach[grp == g].min(0).tolist(), strict=True):
                    reach_of[int(g), cell] = min(r, reach_of.get((int(g), cell), np.inf))
        kept = [(g, cell, r) for (g, cell), r in reach_of.items() if r <= far[cell]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in kept], pa.int64()), pa.array([x[1] for x in kept], pa.int64()), pa.array([x[2] for x in kept], pa.float64())],
                                         names=["grp", "cell", "reach"])

    return queries.select("id", "v", F.col("cell").alias("grp")).mapInArrow(run, "grp long, cell long, reach double").groupBy("grp", "cell").agg(F.min("reach").alias("reach"))


def _solve(rows: DataFrame, k: int, dim: int) -> DataFrame:
    """Best k of every (query block, data block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["grp", "qb", "db"]):
            ids, rows_of, asks = group.column("id").to_numpy(), group.column("row").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            if not asks.any() or asks.all():
                continue
            v = matrix(group.column("v"), dim, np.int64)
            x, xi = v[~asks], ids[~asks]
            order = np.argsort(xi, kind="stable")
            x, xi = x[order], xi[order]
            q, qi, qr = v[asks], ids[asks], rows_of[asks]
            for at in range(0, len(q), 256):
                score = _products(q[at:at + 256], x)
                own = qi[at:at + 256][:, None] == xi[None, :]
                out_r, out_q, out_x, out_s = [], [], [], []
                for i in range(len(score)):
                    s = np.flatnonzero(~own[i])
                    if len(s) > k:  # all scores from the k-th best up, then ties by id
                        edge = np.partition(score[i][s], len(s) - k)[len(s) - k]
                        s = s[score[i][s] >= edge]
                        s = s[np.argsort(-score[i][s], kind="stable")[:k]]
                    out_r.append(np.full(len(s), qr[at + i]))
                    out_q.append(np.full(len(s), qi[at + i]))
                    out_x.append(xi[s])
                    out_s.append(score[i][s])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (out_r, out_q, out_x, out_s)], names=["row", "query_id", "vec_id", "score"])

    dealt = rows.repartition("grp", "qb", "db").sortWithinPartitions("grp", "qb", "db")
    return dealt.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, n_pivots: int = PIVOTS,
          query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for each row with ``is_query`` (a condition on ``id``)."""
    whole = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    dim = dimension(whole, "v")
    centres = pivots(whole, "id", "v", n_pivots, dim, 10)
    if not len(centres):
        centres = np.zeros((1, dim))
    data = staged(_assign(whole, centres, dim).withColumn("row", F.monotonically_increasing_id()), "voronoi-cells")
    radius, smallest = _summaries(data, k)
    queries = data.where(is_query)
    reach = staged(_group_bounds(queries, centres, radius, smallest, k, dim), "voronoi-bounds")
    blocks_of = lambda n, size: F.greatest(F.lit(1).cast("long"), F.ceil(n / size))
    sizes = queries.groupBy(F.col("cell").alias("grp")).agg(F.count(F.lit(1)).alias("nq"))
    # at most PIVOTS squared rows of bounds, hence the hints
    near = data.join(F.broadcast(reach.withColumnRenamed("cell", "_cell")), (F.col("cell") == F.col("_cell")) & (F.col("far") >= F.col("reach"))).select("id", "v", "row", "grp")
    counts = data.join(F.broadcast(reach.withColumnRenamed("cell", "_cell")), (F.col("cell") == F.col("_cell")) & (F.col("far") >= F.col("reach"))).groupBy("grp").agg(F.count(F.lit(1)).alias("nx"))
    plan = staged(sizes.join(counts, "grp").select("grp", blocks_of(F.col("nq"), query_block).alias("qbs"), blocks_of(F.col("nx"), data_block).alias("dbs")), "voronoi-blocks")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    x_rows = near.join(F.broadcast(plan), "grp").select("grp", F.explode(upto(F.col("qbs"))).alias("qb"), F.pmod(F.xxhash64("row"), F.col("dbs")).alias("db"), "id", "v", "row", F.lit(False).alias("asks"))
    q_rows = queries.withColumnRenamed("cell", "grp").join(F.broadcast(plan), "grp").select(
        "grp", F.pmod(F.xxhash64("row"), F.col("qbs")).alias("qb"), F.explode(upto(F.col("dbs"))).alias("db"), "id", "v", "row", F.lit(True).alias("asks"))
    best = _solve(x_rows.unionByName(q_rows), k, dim)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.place, q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(x.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""
