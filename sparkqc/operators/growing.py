"""Growth of trees that will be pruned at a given alpha (L1, L3): only what the pruning can keep is grown.

R(t), impurity times share of the weight, is what a node costs as a leaf. An inner node's worth is at most R(t), since the leaves below it cost
nothing or more and are two or more. So a node with R(t) <= alpha is a leaf of the pruned tree whatever stands below it, and
its growth stops there. The R(t) of a level add up to less than 1, so a tree has fewer than 1 / alpha open nodes at a time, whatever the rows.

* Split candidates are those of Spark ML: at most ``MAX_BINS`` - 1 midpoints per column that part the weight evenly, from all rows or, of more
  than ``CANDIDATE_ROWS``, from a hash sample of about so many. Every row is binned and counted.
* A level is one pass for all trees of a forest: every task adds up the class weights per (tree, node, column, bin) of its rows, one group per node
  adds up the tasks' sums and finds the split of largest Gini gain. One row per open node comes to the driver.
* Open nodes beyond what ``SUMS_BYTES`` hold wait for a pass of their own.
* A forest's tree takes each row as often as a Poisson draw of mean 1 says, a function of row, tree and seed.

Defined results: equal gains go to the first column, then the smallest threshold; NULL and NaN go right; rows without label take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.operators.pruning import NodeTable
from sparkqc.operators.trees import feature_matrix
from sparkqc.session import cut_lineage

MAX_BINS = 32
MAX_DEPTH = 30
CANDIDATE_ROWS = 10_000
SUMS_BYTES = 64 << 20
CHUNK_ROWS = 16384
#: Gains that differ by less are equal: their sums depend on the order of the rows.
TIE = 1e-12


# ------------------------------------------------------------------ bins

def split_candidates(values: np.ndarray, weights: np.ndarray, max_bins: int = MAX_BINS) -> np.ndarray:
    """Midpoints between neighbouring values: all of them, or those nearest to equal parts of the weight."""
    known = ~np.isnan(values)
    distinct, at = np.unique(values[known], return_inverse=True)
    if len(distinct) < 2:
        return np.zeros(0)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < max_bins:
        return middle
    upto = np.cumsum(np.bincount(at, weights[known]))
    stride = upto[-1] / max_bins
    out, target = [], stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[:max_bins - 1])


def _candidates(rows: DataFrame, features: Sequence[str], n: int) -> list[np.ndarray]:
    if n > CANDIDATE_ROWS:
        rows = rows.where(F.pmod("_draw", F.lit(1 << 20)) < math.ceil(CANDIDATE_ROWS / n * (1 << 20)))
    t = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(features)], "_weight").toArrow()
    w = t.column("_weight").to_numpy()
    return [split_candidates(np.asarray(t.column(f"c{i}").to_numpy(), float), w, min(MAX_BINS, max(n, 2))) for i in range(len(features))]


def _chunks(rows: DataFrame, features: Sequence[str], cuts: list[np.ndarray]) -> DataFrame:
    """``(y, w, draw, bins)``: rows by thousands as binary columns, a byte per row and column for the bins."""
    shared, features = rows.sparkSession.sparkContext.broadcast(cuts), list(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, CHUNK_ROWS):
                piece = batch.slice(s, CHUNK_ROWS)
                x = feature_matrix(piece, features)
                bins = np.stack([np.searchsorted(at, x[:, i], side="left") for i, at in enumerate(shared.value)]).astype(np.uint8)  # NaN is beyond all
                cols = [piece.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes() for c, t in (("_label", "<i4"), ("_weight", "<f8"), ("_draw", "<i8"))]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (*cols, bins.tobytes())], names=["y", "w", "draw", "bins"])

    return cut_lineage(rows.mapInArrow(run, "y binary, w binary, draw binary, bins binary"))


# ---------------------------------------------------------------- growth

def _poisson(draw: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson draws of mean 1 per row."""
    x = draw.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    share = ((x ^ (x >> np.uint64(33))) >> np.uint64(11)).astype(float) / float(1 << 53)
    upto = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])
    return np.searchsorted(upto, share, side="right").astype(float)


def _walk(feature: np.ndarray, bin_of: np.ndarray, left: np.ndarray, right: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Node that each row (columns of ``bins``) has come to."""
    node = np.zeros(bins.shape[1], np.int64)
    going = np.arange(len(node)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(going):
        at = node[going]
        node[going] = at = np.where(bins[feature[at], going] <= bin_of[at], left[at], right[at])
        going = going[feature[at] >= 0]
    return node


def best_split(sums: np.ndarray, least_gain: float = 0.0) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(column, bin, class weights left and right) of largest Gini gain from class weights per (column, bin); column -1 where nothing gains."""
    upto = np.cumsum(sums, axis=1)[:, :-1]
    beyond = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1][:, 1:]
    total = sums[0].sum(0)
    wl, wr, whole = upto.sum(2), beyond.sum(2), total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = lambda c, w: 1 - ((c / w[..., None]) ** 2).sum(-1)
        gain = impurity(total, whole) - wl / whole * impurity(upto, wl) - wr / whole * impurity(beyond, wr)
    gain = np.where((wl > 0) & (wr > 0), gain, -np.inf)
    if not gain.size or not gain.max() > 0 or gain.max() < least_gain:
        return -1, -1, total, total
    col, b = np.unravel_index(int(np.argmax(gain > gain.max() - TIE)), gain.shape)
    return int(col), int(b), upto[col, b], beyond[col, b]


class _Growing:
    """One tree on its way: parallel lists over its nodes, the root first."""

    def __init__(self) -> None:
        self.parent, self.left, self.right, self.feature, self.bin, self.depth = [-1], [-1], [-1], [-1], [0], [0]
        self.counts: list[np.ndarray | None] = [None]

    def child(self, parent: int, counts: np.ndarray) -> int:
        for of, v in ((self.parent, parent), (self.left, -1), (self.right, -1), (self.feature, -1), (self.bin, 0), (self.depth, self.depth[parent] + 1), (self.counts, counts)):
            of.append(v)
        return len(self.parent) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v, np.int64) for v in (self.feature, self.bin, self.left, self.right))

    def open(self, node: int, alpha: float, depth: int) -> bool:
        """Can the pruned tree have an inner node here?"""
        c = self.counts[node]
        if c is None:
            return True
        w = c.sum()
        return self.depth[node] < depth and w > 0 and (c < w).all() and (1 - ((c / w) ** 2).sum()) * w / self.counts[0].sum() > alpha

    def table(self, cuts: list[np.ndarray]) -> NodeTable:
        counts = np.stack(self.counts)
        weight = counts.sum(1)
        share = counts / np.where(weight > 0, weight, 1)[:, None]
        feature, b, left, right = self.arrays()
        threshold = np.array([cuts[f][i] if f >= 0 else 0.0 for f, i in zip(feature, b, strict=True)])
        return NodeTable(np.array(self.parent, np.int64), left, right, feature, threshold, weight, np.where(weight > 0, 1 - (share ** 2).sum(1), 0.0),
                         np.where(weight[:, None] > 0, share, 1 / counts.shape[1]))


def _splits(chunks: DataFrame, trees: list[_Growing], nodes: list[tuple[int, int]], columns: int, classes: int, seed: int, bootstrap: bool, least_gain: float) -> list:
    """Best split of each of ``nodes`` (tree, node), by one pass."""
    by_tree: dict[int, list[int]] = {}
    for t, n in nodes:
        by_tree.setdefault(t, []).append(n)
    shared = chunks.sparkSession.sparkContext.broadcast({t: (trees[t].arrays(), np.array(at)) for t, at in by_tree.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((columns, len(at), MAX_BINS, classes)) for t, (_, at) in shared.value.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                y, w, draw, bins = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in (("y", "<i4"), ("w", "<f8"), ("draw", "<i8"), ("bins", "u1")))
                bins = bins.reshape(columns, -1)
                for t, (arrays, at) in shared.value.items():
                    place = np.full(len(arrays[0]), -1)
                    place[at] = np.arange(len(at))
                    here = place[_walk(*arrays, bins)]
                    weight = w * _poisson(draw, t, seed) if bootstrap else w
                    mine = np.flatnonzero((here >= 0) & (weight > 0))
                    first, weight = here[mine] * (MAX_BINS * classes) + y[mine], weight[mine]
                    for c in range(columns):
                        sums[t][c] += np.bincount(first + bins[c, mine] * np.int64(classes), weight, len(at) * MAX_BINS * classes).reshape(len(at), MAX_BINS, classes)
        pid = TaskContext.get().partitionId()
        for t, (_, at) in shared.value.items():
            some = np.flatnonzero(sums[t][0].any(axis=(1, 2)))
            for s in range(0, len(some), 512):
                part = some[s:s + 512]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), t), pa.int32()), pa.array(at[part], pa.int32()), pa.array(np.full(len(part), pid), pa.int32()),
                                                  pa.array([np.ascontiguousarray(sums[t][:, n]).tobytes() for n in part], pa.binary())], names=["tree", "node", "pid", "sums"])

    def best(group: pa.Table) -> pa.Table:
        group = group.sort_by("pid")  # sums in a fixed order
        total = np.zeros((columns, MAX_BINS, classes))
        for v in group.column("sums").to_pylist():
            total += np.frombuffer(v).reshape(total.shape)
        col, b, lo, hi = best_split(total, least_gain)
        return pa.table({"tree": group.column("tree")[:1], "node": group.column("node")[:1], "col": pa.array([col], pa.int32()), "bin": pa.array([b], pa.int32()),
                         "lo": pa.array([lo.tolist()], pa.list_(pa.float64())), "hi": pa.array([hi.tolist()], pa.list_(pa.float64()))})

    found = chunks.mapInArrow(run, "tree int, node int, pid int, sums binary").groupBy("tree", "node").applyInArrow(best, "tree int, node int, col int, bin int, lo array<double>, hi array<double>")
    return sorted(found.collect(), key=lambda r: (r["tree"], r["node"]))  # one row per open node


def grow(df: DataFrame, features: Sequence[str], label: str, weight: str, alpha: float, trees: int = 1, bootstrap: bool = False, seed: int = 42, key: str | None = None,
         depth: int = MAX_DEPTH, least_gain: float = 0.0) -> list[NodeTable]:
    """Node tables of trees whose nodes that cost more than ``alpha`` are split as far as a split gains (labels 0, 1, ...)."""
    features = list(features)
    drawn = F.xxhash64(key) if key else F.xxhash64(*features, label)
    rows = df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias("_label"), F.col(weight).cast("double").alias("_weight"), drawn.alias("_draw"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("_label").alias("top")).first()
    classes = max(int(size["top"] or 0) + 1, 2)
    cuts = _candidates(rows, features, size["n"])
    chunks = _chunks(rows, features, cuts)
    forest = [_Growing() for _ in range(trees)]
    todo = [(t, 0) for t in range(trees)]
    most = max(1, SUMS_BYTES // (8 * len(features) * MAX_BINS * classes))
    while todo:
        now, todo = todo[:most], todo[most:]
        for r in _splits(chunks, forest, now, len(features), classes, seed, bootstrap, least_gain):
            tree, node = forest[r["tree"]], r["node"]
            lo, hi = np.array(r["lo"]), np.array(r["hi"])
            if tree.counts[node] is None:
                tree.counts[node] = lo if r["col"] < 0 else lo + hi
                if not tree.open(node, alpha, depth):
                    continue
            if r["col"] < 0:
                continue
            tree.feature[node], tree.bin[node] = r["col"], r["bin"]
            tree.left[node], tree.right[node] = tree.child(node, lo), tree.child(node, hi)
            todo += [(r["tree"], c) for c in (tree.left[node], tree.right[node]) if tree.open(c, alpha, depth)]
    for tree in forest:
        if tree.counts[0] is None:  # no rows
            tree.counts[0] = np.zeros(classes)
    return [t.table(cuts) for t in forest]
