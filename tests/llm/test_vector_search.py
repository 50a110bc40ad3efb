import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.llm import nn_descent, voronoi_knn
from sparkqc.llm.queries import QUERIES
from sparkqc.llm.vectors import matrix

SHAPE = "vec_id long, embedding array<float>, label int"
SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SHAPE)


def clustered(rng, n=900, dim=16):
    centres = rng.normal(size=(12, dim))
    return [(i, (centres[i % 12] + rng.normal(size=dim) * 0.2).astype(np.float32)) for i in range(n)]


def brute(rows, every, k, integer):
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not integer:
        ok = [(i, v) for i, v in ok if np.any(v != 0)]
    dim = max((len(v) for _, v in ok), default=0)
    pad = [(i, [*(np.floor(1024 * v).astype(np.int64).tolist() if integer else v.tolist()), *[0] * (dim - len(v))]) for i, v in ok]
    out = {}
    for i, q in pad:
        if i % every == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, x)), j) for j, x in pad if j != i))
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


ODD = [(5000, None), (5001, [float("nan")] * 16), (5002, [None] * 16), (5003, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (5004, [0.0] * 16), (5100, [0.5, -0.25]), (5200, [0.0] * 16)]


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 100)])
def test_exact_top_k(spark, blocks):
    rows = clustered(np.random.default_rng(1)) + ODD
    got = found(voronoi_knn.top_k(frame(spark, rows), F.col("id") % 100 == 0, 10, query_block=blocks[0], data_block=blocks[1]))
    assert got == brute(rows, 100, 10, True)


def test_exact_top_k_of_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.5, 0.0]) for i in range(400)] + [(i, rng.integers(-2, 3, 3) / 4) for i in range(400, 700)]
    assert found(voronoi_knn.top_k(frame(spark, rows), F.col("id") % 100 == 0, 10)) == brute(rows, 100, 10, True)


def test_exact_top_k_beyond_doubles(spark):
    rows = [(0, [3e5, 1.0]), (1, [3e5, 1.0]), (2, [3e5, -1.0]), (3, [2.9e5, 7.0]), (100, [1e3, 1e6])]
    assert found(voronoi_knn.top_k(frame(spark, rows), F.col("id") % 100 == 0, 3)) == brute(rows, 100, 3, True)


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5])]
    assert found(voronoi_knn.top_k(frame(spark, rows), F.col("id") % 100 == 0, 10)) == brute(rows, 100, 10, True)
    assert {q: [v for v, _ in x] for q, x in found(nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20)).items()} == {0: [1, 2]}
    assert voronoi_knn.top_k(frame(spark, []), F.col("id") % 100 == 0, 10).count() == 0
    assert nn_descent.nearest(frame(spark, []), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert nn_descent.nearest(frame(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_far_cells_are_not_replicated(spark):
    """Two clusters far apart: bounds keep one cluster's vectors from the other's queries."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 4)) * 0.01 + [5, 0, 0, 0], rng.normal(size=(300, 4)) * 0.01 - [5, 0, 0, 0]])
    centres = np.array([[5120.0, 0, 0, 0], [-5120.0, 0, 0, 0]])
    data = voronoi_knn._assign(spark.createDataFrame([(i, [int(c) for c in np.floor(v * 1024)]) for i, v in enumerate(x)], "id long, v array<long>"), centres, 4).cache()
    radius, smallest = voronoi_knn._summaries(data, 10)
    reach = voronoi_knn._group_bounds(data.where("id % 100 = 0"), centres, radius, smallest, 10, 4)
    assert {(r.grp, r.cell) for r in reach.collect()} == {(0, 0), (1, 1)}


def recall(rows, got, every, k):
    want = brute(rows, every, k, False)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([np.mean([s >= want[q][-1][1] - 1e-9 for _, s in got[q]]) for q in want])


def test_nearest_recall_scores_and_order(spark):
    rows = clustered(np.random.default_rng(4), 1500) + ODD
    got = found(nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20))
    assert recall(rows, got, 20, 20) >= 0.95
    exact = {q: dict(x) for q, x in brute(rows, 20, 3000, False).items()}
    for q, x in got.items():
        assert q not in dict(x) and x == sorted(x, key=lambda h: (-h[1], h[0]))
        assert all(s == pytest.approx(exact[q][v], abs=1e-9) for v, s in x)


def test_nearest_with_a_common_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [0.6, 0.8, 0.0, 0.0]) for i in range(300)] + [(i, rng.normal(size=4)) for i in range(300, 800)]
    got = found(nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20))
    want = brute(rows, 20, 20, False)
    assert recall(rows, got, 20, 20) >= 0.95
    assert [v for v, _ in got[0]] == [v for v, _ in want[0]] and [v for v, _ in got[280]] == [v for v, _ in want[280]]


def test_nearest_recall_with_cells_far_above_the_block(spark, monkeypatch):
    for name, value in (("BLOCK", 40), ("CELL", 10), ("MAX_PIVOTS", 1)):
        monkeypatch.setattr(nn_descent, name, value)
    rows = clustered(np.random.default_rng(6))
    got = found(nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20))
    assert recall(rows, got, 20, 20) >= 0.95, recall(rows, got, 20, 20)


def test_nearest_recall_in_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=64)
    rows = [(i, (v / np.linalg.norm(v)).astype(np.float32)) for i, v in enumerate(centre / np.linalg.norm(centre) + rng.normal(size=(1500, 64)) * 0.004)]
    got = found(nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0, 20))
    assert recall(rows, got, 100, 20) >= 0.9, recall(rows, got, 100, 20)


def test_query_recall_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = found(QUERIES["op9_nearest_neighbours"](spark, SF))
    assert recall([(r.vec_id, r.embedding) for r in table], got, 20, 20) >= 0.95


def test_matrix_pads_short_vectors():
    import pyarrow as pa

    assert matrix(pa.array([[1.0], [], [2.0, 3.0]]), 2).tolist() == [[1, 0], [0, 0], [2, 3]]


def per_row(rows, every, k, integer):
    """One list of (rank, id, score) for each query row, of all rows with other ids."""
    out = []
    for q, v in rows:
        if q % every == 0:
            x = [np.floor(1024 * np.asarray(c, np.float32).astype(float)) if integer else np.asarray(c, np.float32).astype(float) for c in (v, *(c for _, c in rows))]
            scores = sorted((-float(x[0] @ c), j) for c, (j, _) in zip(x[1:], rows) if j != q)
            out += [(q, rank, j, round(-s, 9)) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def repeated_ids(seed):
    """Ids that stand twice with one vector, with two vectors, and eight times, also as queries."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).astype(np.float32)) for i in range(160)]
    return rows + [rows[20], rows[33], *[(100, rng.normal(size=8).astype(np.float32)) for _ in range(7)], (41, rows[5][1]), (0, rows[7][1])]


def test_exact_top_k_of_repeated_ids_and_queries(spark):
    rows = repeated_ids(8)
    got = voronoi_knn.top_k(frame(spark, rows), F.col("id") % 20 == 0, 10, query_block=4, data_block=50).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, float(r.score)) for r in got) == per_row(rows, 20, 10, True)


def test_nearest_of_repeated_ids_and_queries(spark):
    rows = repeated_ids(9)
    got = nn_descent.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()
    # the pool holds every node here, so the lists are exact
    found, want = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got), per_row(rows, 20, 20, False)
    assert [x[:3] for x in found] == [x[:3] for x in want] and np.allclose([x[3] for x in found], [x[3] for x in want])


@pytest.mark.parametrize("operator", [lambda d: voronoi_knn.top_k(d, F.col("id") % 20 == 0, 5), lambda d: nn_descent.nearest(d, F.col("vec_id") % 20 == 0, 5)])
def test_extra_columns_with_clashing_names_change_nothing(spark, operator):
    plain = frame(spark, repeated_ids(10))
    extra = plain
    for name in ("id", "node", "row", "cell", "v", "x", "score", "rank", "members", "query"):
        extra = extra.withColumn(name, F.lit("clash"))
    assert sorted(map(tuple, operator(extra).collect())) == sorted(map(tuple, operator(plain).collect()))
