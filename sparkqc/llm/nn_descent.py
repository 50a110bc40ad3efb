"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

Build. Equal vectors are one node. A few pivot partitions give every node first neighbours: a cell of more than BLOCK nodes
is cut by further pivots drawn from it, other ones in each partition, as many levels as it takes. Then each
round joins neighbours of neighbours: a node's neighbourhood (its neighbours and the nodes that count it among
theirs) is gathered with their vectors, each member is offered its best of the other members, and keeps the ``degree``
best it has been offered. Rounds end when few lists change.

Search. Each query keeps a pool of the ``pool`` best nodes found; a round joins the pool's nodes that haven't been
followed yet with their neighbourhoods, and takes what is better than the pool's worst. It ends when no pool has such nodes left.
The whole pool is scored again in double precision on the original vectors.

In between, vectors travel in their own precision (32-bit floats, or else doubles) and are multiplied in doubles, so the pool's order is the
exact one up to the order of a sum. Every row is a node or equal to one; the neighbourhood of a
hub is its ``degree`` neighbours and the ``degree`` nearest of the nodes that name it, which is the index's approximation. Measured
recall is in the README; the tests hold it against brute force.

Nearness is the largest inner product. Defined results: a null id, a null or zero vector, or one with null or non-finite
components takes no part; a shorter vector counts as padded with zeros; ties go to the smaller id; repeated vectors are all
found in the order of their ids; rows with equal ids are all found, a query never finds a row of its own id, and rows that
share a query's id are queries of their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from sparkqc.llm.common import staged
from sparkqc.llm.vectors import dimension, groups, matrix, pivots, usable

DEGREE = 32
PARTITIONS = 4
STILL = 0.01  # a round that brings fewer new entries than this share of all is the last
OFFERS = 4
POOL = 160
CELL = 500
MAX_PIVOTS = 1024
BLOCK = 2048
SPLIT = 16
NEARLY = 0.9
_NEIGHBOURS = "array<struct<far:double,id:long>>"


def _vectors(carried: list[bytes], dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(carried), kind).reshape(-1, dim).astype(np.float64)


def _neighbour_lists(far: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    items = pa.StructArray.from_arrays([pa.array(far, pa.float64()), pa.array(ids, pa.int64())], names=["far", "id"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), items)


def nodes_of(vectors: DataFrame, keep: int, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Nodes ``(node, v, members)``, one per distinct vector with its ``keep`` smallest ids and how often each stands, and ``(vec_id, node)`` of all rows.

    No result can hold more of a vector's ids than ``keep``, so the rest is not needed there. A node's name is its place in the order of
    smallest ids, since rows with one id may have several vectors.
    """
    length = F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double") + 0.0).alias("v")).where(length > 0)
    rows = staged(rows, "vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("times"))
    few = ids.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep)
    members = few.groupBy("v").agg(F.min("vec_id").alias("_first"), F.sort_array(F.collect_list(F.struct("vec_id", "times"))).alias("members"))
    ordered = members.repartitionByRange("_first", "v").sortWithinPartitions("_first", "v")
    nodes = staged(ordered.select(F.monotonically_increasing_id().alias("node"), "v", "members"), "nodes")
    named = rows.join(nodes.select(F.col("v").alias("_v"), "node"), F.col("v") == F.col("_v")).select("vec_id", "node")
    return nodes, named


def carried(nodes: DataFrame, dim: int, kind: str) -> DataFrame:
    """``(node, x)``: the vectors as bytes of numbers of ``kind``, which holds them without loss."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1), dim).astype(kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in rows], pa.binary())], names=["node", "x"])

    return nodes.select("node", "v").mapInArrow(run, "node long, x binary")


def _firsts(lists: DataFrame, key: str, others: list[Column], degree: int) -> DataFrame:
    """``(key, near, ...)``: the ``degree`` best of all ``near`` of a key, one entry an id."""
    gathered = lists.groupBy(key).agg(F.array_sort(F.transform(F.flatten(F.collect_list("near")), lambda e: F.struct(e["id"], e["far"]))).alias("_all"), *others)
    single = F.filter("_all", lambda e, i: (i == 0) | (F.get(F.col("_all"), i - 1)["id"] != e["id"]))
    best = F.slice(F.array_sort(F.transform(single, lambda e: F.struct(e["far"], e["id"]))), 1, degree).alias("near")
    return gathered.withColumn("near", best).drop("_all")


def _cut(cells: DataFrame, dim: int, kind: str, salt: int) -> DataFrame:
    """Large ``cells(node, x, cell, n, was)`` cut into smaller ones: each row goes to the nearest of up to SPLIT members drawn by hash.

    A cell that the last cut left nearly whole (vectors that can't be told apart) is dealt by a hash of the ids. Both hashes depend on ``salt``.
    """
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents, which = np.unique(batch.column("cell").to_numpy(), return_inverse=True)
            x = _vectors(batch.column("x").to_pylist(), dim, kind)
            child = np.zeros(len(x), np.int64)
            for i in range(len(parents)):
                at = np.flatnonzero(which == i)
                own = batch.column("drawn")[int(at[0])].as_py()
                if own:
                    p = _vectors([m["x"] for m in own], dim, kind)
                    p, y = p - p[0], x[at] - p[0]  # near copies differ by little: take off what they share
                    child[at] = ((p * p).sum(1) - 2 * (y @ p.T)).argmin(1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "x", "cell", "n")), pa.array(child)], names=["node", "x", "cell", "n", "child"])

    whole = F.col("n") > NEARLY * F.col("was")
    place = F.xxhash64(F.lit(salt), "node")
    by_hash = cells.where(whole).select("node", "x", "cell", "n", F.pmod(place, F.ceil(F.col("n") / BLOCK)).alias("child"))
    rest = cells.where(~whole)
    drawn = rest.where(F.pmod(place, F.col("n")) < 2 * SPLIT).groupBy(F.col("cell").alias("_c")).agg(
        F.max("n").alias("_n"), F.sort_array(F.collect_list(F.struct(place.alias("place"), "node", "x"))).alias("_all")).select(
        "_c", F.slice("_all", 1, F.least(F.lit(SPLIT), F.ceil(F.col("_n") / CELL) + 1).cast("int")).alias("drawn"))
    near = rest.join(drawn, F.col("cell") == F.col("_c"), "left").select("node", "x", "cell", "n", "drawn").mapInArrow(
        assign, "node long, x binary, cell long, n long, child long")
    return near.union(by_hash).select("node", "x", F.xxhash64("cell", "child").alias("cell"), F.col("n").alias("was"))


def first_neighbours(nodes: DataFrame, points: DataFrame, dim: int, kind: str, degree: int, partition: int, n: int, seed: int = 9) -> DataFrame:
    """``(node, near)``: the best of each node's cell in one pivot partition; cells of more than BLOCK nodes are cut by further pivots until none is left."""
    centres = pivots(nodes, "node", "v", max(1, min(MAX_PIVOTS, n // CELL)), dim, seed * 100 + partition)
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1).to_pylist(), dim, kind)
            cell = (x @ shared.value.T).argmax(1) if len(shared.value) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=["node", "x", "cell"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["cell"]):
            ids = group.column("node").to_numpy()
            x = _vectors(group.column("x").to_pylist(), dim, kind)
            k = min(degree, len(ids) - 1)
            if k < 1:
                continue
            for at in range(0, len(ids), 512):
                far = -(x[at:at + 512] @ x.T)
                far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
                best = np.argpartition(far, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + 512]), _neighbour_lists(np.take_along_axis(far, best, 1).ravel(), ids[best].ravel(), np.full(len(far), k))], names=["node", "near"])

    cells = staged(points.mapInArrow(assign, "node long, x binary, cell long").withColumn("was", F.lit(None).cast("long")), "cells")
    small, level = None, 0
    while True:
        sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select(F.col("cell").alias("_s"), "n")
        sized = cells.join(sizes, F.col("cell") == F.col("_s")).drop("_s")
        if not sizes.where(F.col("n") > BLOCK).limit(1).count():
            last = cells
            break
        fits = sized.where(F.col("n") <= BLOCK).select(*points.columns, "cell")
        small = fits if small is None else small.union(fits)
        level += 1
        large = sized.where(F.col("n") > BLOCK).withColumn("was", F.coalesce("was", F.lit(1 << 62)))
        cells = staged(_cut(large, dim, kind, (seed * 100 + partition) * 1000 + level), "cells")
    last = last.select(*points.columns, "cell")
    dealt = last if small is None else small.union(last)
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(solve, f"node long, near {_NEIGHBOURS}")


def neighbourhoods(graph: DataFrame, points: DataFrame, degree: int, parts: int) -> DataFrame:
    """``(node, members)``: per node its neighbours and the ``degree`` nearest nodes that name it, with their vectors and worst neighbours."""
    edges = graph.select(F.col("node").alias("w"), F.explode("near").alias("e")).select("w", F.col("e.id").alias("u"), "e.far")
    named = Window.partitionBy("u").orderBy("far", "w")
    back = edges.withColumn("_n", F.row_number().over(named)).where(F.col("_n") <= degree).select(F.col("u").alias("w"), F.col("w").alias("u"))
    both = edges.select("w", "u").union(back).distinct()
    worst = graph.select(F.col("node").alias("_g"), F.when(F.size("near") < degree, F.lit(float("inf"))).otherwise(F.element_at("near", -1)["far"]).alias("worst"))
    member = points.join(worst, F.col("node") == F.col("_g"), "left").select(F.col("node").alias("_u"), F.struct(
        F.col("node").alias("id"), "x", F.coalesce("worst", F.lit(float("inf"))).alias("worst")).alias("m"))
    return both.join(member, F.col("u") == F.col("_u")).repartition(parts, "w").groupBy(F.col("w").alias("node")).agg(F.collect_list("m").alias("members"))


def descend(graph: DataFrame, points: DataFrame, dim: int, kind: str, degree: int, offers: int, parts: int) -> DataFrame:
    """One round: members of a neighbourhood are offered their best of the other members. ``(node, near, moved)``: the new lists, and their new entries."""
    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(1)
                bounds, items = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
                ids, worst = items.field("id").to_numpy(), items.field("worst").to_numpy()
                x = _vectors(items.field("x").to_pylist(), dim, kind)
                fars, others, lengths, owners = [], [], [], []
                for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    k = min(offers, hi - lo - 1)
                    if k < 1:
                        continue
                    far = -(x[lo:hi] @ x[lo:hi].T)
                    np.fill_diagonal(far, np.inf)
                    best = np.argpartition(far, k - 1, axis=1)[:, :k]
                    value = np.take_along_axis(far, best, 1)
                    good = value < worst[lo:hi][:, None]
                    fars.append(value[good])
                    others.append(ids[lo:hi][best][good])
                    n = good.sum(1)
                    some = n > 0
                    lengths.append(n[some])
                    owners.append(ids[lo:hi][some])
                if owners:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(owners)), _neighbour_lists(np.concatenate(fars), np.concatenate(others), np.concatenate(lengths))], names=["node", "near"])

    offered = neighbourhoods(graph, points, degree, parts).mapInArrow(offer, f"node long, near {_NEIGHBOURS}")
    ids = lambda c: F.transform(c, lambda x: x["id"])
    lists = graph.select("node", "near", F.col("near").alias("old")).union(offered.select("node", "near", F.lit(None).cast(_NEIGHBOURS)))
    merged = _firsts(lists, "node", [F.first("old", ignorenulls=True).alias("old")], degree)
    return staged(merged.select("node", "near", F.size(F.array_except(ids("near"), F.coalesce(ids("old"), F.array().cast("array<long>")))).alias("moved")), "graph")


def build(nodes: DataFrame, points: DataFrame, dim: int, kind: str, n: int, parts: int, degree: int = DEGREE, partitions: int = PARTITIONS, offers: int = OFFERS, still: float = STILL) -> DataFrame:
    """``(node, near)``: the neighbour graph, neighbours in order. Lists only get better, so the rounds end."""
    lists = first_neighbours(nodes, points, dim, kind, degree, 0, n)
    for p in range(1, partitions):
        lists = lists.union(first_neighbours(nodes, points, dim, kind, degree, p, n))
    graph = staged(_firsts(lists, "node", [], degree), "graph")
    while True:
        turned = descend(graph, points, dim, kind, degree, offers, parts)
        graph = turned.select("node", "near")
        if (turned.agg(F.sum("moved")).first()[0] or 0) <= still * n * degree:
            return graph


def _packed(near: DataFrame) -> DataFrame:
    """Neighbourhoods as two binaries a node: ids, vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(1)
                bounds, items = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
                ids, xs = items.field("id").to_numpy(), items.field("x").to_pylist()
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([ids[lo:hi].tobytes() for lo, hi in spans], pa.binary()), pa.array([b"".join(xs[lo:hi]) for lo, hi in spans], pa.binary())], names=["w", "ids", "xs"])

    return near.mapInArrow(run, "w long, ids binary, xs binary")


def _follow(frontier: DataFrame, dim: int, kind: str) -> DataFrame:
    """``(query, near)``: of each followed neighbourhood what is better than the pool's worst."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                query, worst = part.column(0).to_numpy(), part.column(2).to_numpy()
                q = _vectors(part.column(1).to_pylist(), dim, kind)
                ids = [np.frombuffer(x, np.int64) for x in part.column(3).to_pylist()]
                n = np.array([len(x) for x in ids])
                x = _vectors(part.column(4).to_pylist(), dim, kind)
                owner = np.repeat(np.arange(len(n)), n)
                far = -np.einsum("ij,ij->i", x, q[owner])
                good = far < worst[owner]
                kept = np.bincount(owner[good], minlength=len(n))
                yield pa.RecordBatch.from_arrays([pa.array(query), _neighbour_lists(far[good], np.concatenate(ids)[good], kept)], names=["query", "near"])

    return frontier.select("query", "x", "worst", "ids", "xs").mapInArrow(run, f"query long, near {_NEIGHBOURS}")


def search(starts: DataFrame, graph: DataFrame, points: DataFrame, dim: int, kind: str, parts: int, degree: int = DEGREE, pool: int = POOL) -> DataFrame:
    """``(query, pool)`` for the nodes ``starts(query)``: the nearest nodes found, in order, the query's own node first."""
    adjacency = _packed(neighbourhoods(graph, points, degree, parts)).persist(StorageLevel.DISK_ONLY)
    entry = lambda far, node, new: F.struct(far.alias("far"), node.alias("id"), new.alias("new"))
    own = points.withColumnsRenamed({"node": "_n"})
    begun = starts.join(own, F.col("query") == F.col("_n")).select("query", "x", F.array(entry(F.lit(float("-inf")), F.col("query"), F.lit(True))).alias("pool"))
    state = staged(begun, "search")
    # a node that has left a pool is worse than its worst for good, so the rounds end
    while state.where(F.exists("pool", lambda x: x["new"])).limit(1).count():
        fresh = F.transform(F.filter("pool", lambda x: x["new"]), lambda x: x["id"])
        worst = F.when(F.size("pool") < pool, F.lit(float("inf"))).otherwise(F.element_at("pool", -1)["far"])
        frontier = state.select("query", "x", worst.alias("worst"), F.explode(fresh).alias("follow")).join(adjacency, F.col("follow") == F.col("w"))
        found = _follow(frontier, dim, kind).select("query", F.lit(None).cast("binary").alias("x"), F.transform("near", lambda x: entry(x["far"], x["id"], F.lit(True))).alias("pool"))
        old = state.withColumn("pool", F.transform("pool", lambda x: entry(x["far"], x["id"], F.lit(False))))
        by_id = F.array_sort(F.transform(F.flatten(F.collect_list("pool")), lambda x: F.struct(x["id"], x["new"], x["far"])))
        merged = old.unionByName(found).groupBy("query").agg(F.max("x").alias("x"), by_id.alias("_all"))
        # one entry a node: the followed one (new = false) where there is one, so the own node keeps its place at the top
        distinct = F.filter("_all", lambda x, i: (i == 0) | (F.get(F.col("_all"), i - 1)["id"] != x["id"]))
        ranked = F.array_sort(F.transform(distinct, lambda x: entry(x["far"], x["id"], x["new"])))
        state = staged(merged.select("query", "x", F.slice(ranked, 1, pool).alias("pool")), "search")
    adjacency.unpersist()
    return state.select("query", F.transform("pool", lambda x: x["id"]).alias("pool"))


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", degree: int = DEGREE, pool: int = POOL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of all other rows for each row with ``is_query`` (a condition on ``vec_id``)."""
    nodes, named = nodes_of(vectors, k + 1, id_col, vector_col)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dim, n = dimension(nodes, "v"), nodes.count()
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    points = staged(carried(nodes, dim, kind), "points")
    graph = build(nodes, points, dim, kind, n, parts, degree)
    asked = staged(named.where(is_query), "queries")
    found = search(asked.select(F.col("node").alias("query")).distinct(), graph, points, dim, kind, parts, degree, pool)
    pairs = found.select("query", F.explode("pool").alias("node"))
    left = nodes.select(F.col("node").alias("_q"), F.col("v").alias("_x"))
    right = nodes.select(F.col("node").alias("_c"), F.col("v").alias("_y"), "members")
    product = F.aggregate(F.zip_with("_x", "_y", lambda a, b: F.coalesce(a, F.lit(0.0)) * F.coalesce(b, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    scored = pairs.join(left, F.col("query") == F.col("_q")).join(right, F.col("node") == F.col("_c")).select("query", product.alias("score"), F.explode("members").alias("m"))
    hit = F.struct((-F.col("score")).alias("far"), F.col("m.vec_id").alias("vec_id"), F.col("m.times").alias("times"), "score")
    lists = scored.groupBy("query").agg(F.array_sort(F.collect_list(hit)).alias("found"))
    # the own id goes before the cut: it may stand at several nodes
    others = asked.join(lists, F.col("node") == F.col("query")).select(
        F.col("vec_id").alias("query_id"), F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("found"))
    rows = F.flatten(F.transform("found", lambda x: F.array_repeat(x, F.least(x["times"], F.lit(k)).cast("int"))))
    return others.select("query_id", F.posexplode(F.slice(rows, 1, k)).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
