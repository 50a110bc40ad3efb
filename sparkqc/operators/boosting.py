"""Regularised boosted trees and the regularised linear booster.

Second-order boosting of the logistic loss. A row with label y and margin m has gradient p - y and hessian p (1 - p), with
p = 1 / (1 + exp(-m)). For rows with sums G and H, the best weight is w = -T(G) / (H + lambda), where T takes alpha off |G|, cut
to +-max_delta_step; it lowers the loss by score(G, H) = -(2 G w + (H + lambda) w^2 + 2 alpha |w|).

* Features are binned once at quantiles (``max_bins``; bin 0 holds NULL and NaN). The binned rows are a checkpointed table.
* A level of a tree is one pass: every task sums gradients and hessians per (node, column, bin) of its rows, Spark adds them up, and
  a window over each (node, column), at most ``max_bins`` rows, gives the gain of every split and both ways for missing values. Only the
  best split of each open node comes to the driver.
* A split needs min_child_weight of hessian on both sides. Grown trees are pruned from below: a split with two leaves stays
  only if its gain reaches gamma.
* Columns are drawn per tree, of these per level, of these per node; rows are drawn per tree by a hash of the row. All draws
  are functions of the seed, so reruns agree.
* Margins are replayed from the last checkpoint inside the batch step (at most ``checkpoint_every`` trees).

The linear booster updates the bias, then all coefficients at once from one pass of sums per round.

Defined results: rows with a null label take no part in the fit; a column without values never splits; without rows, or when
no split gains, trees are single leaves; equal gains go to the first column, then the smallest bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.operators.profile import ranked_values
from sparkqc.operators.shape import to_long
from sparkqc.operators.trees import Tree, feature_matrix, with_scores
from sparkqc.session import cut_lineage

MAX_BINS = 64
ROUNDS = 100
MAX_DEPTH = 6
SUMS = "node int, col int, bin int, g double, h double"


@dataclass(frozen=True)
class Penalty:
    """Regularisation of a fit (``lambda_``, ``alpha``, ``gamma``, ``min_child_weight``, ``max_delta_step``: 0 is no limit)."""

    lambda_: float = 1.0
    alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_delta_step: float = 0.0

    def weight(self, g: float, h: float) -> float:
        w = -math.copysign(max(abs(g) - self.alpha, 0.0), g) / (h + self.lambda_) if h + self.lambda_ > 0 else 0.0
        return max(-self.max_delta_step, min(self.max_delta_step, w)) if self.max_delta_step > 0 else w

    def weight_of(self, g: Column, h: Column) -> Column:
        w = -F.signum(g) * F.greatest(F.abs(g) - F.lit(self.alpha), F.lit(0.0)) / (h + F.lit(self.lambda_))
        return F.greatest(F.lit(-self.max_delta_step), F.least(F.lit(self.max_delta_step), w)) if self.max_delta_step > 0 else w

    def score_of(self, g: Column, h: Column) -> Column:
        """Twice the decrease of the loss by the best weight."""
        w = self.weight_of(g, h)
        return -(g * w * 2 + (h + F.lit(self.lambda_)) * w * w + F.lit(2 * self.alpha) * F.abs(w))


# ------------------------------------------------------------------ bins

def quantile_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """At most ``max_bins`` - 1 cut points per column: values of the column that part its rows evenly."""
    keyed = df.select(F.lit(0).alias("_k"), *[F.col(c).cast("double").alias(c) for c in features])
    long = to_long(keyed, ["_k"], list(features)).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return {**{c: [] for c in features}, **{r["col"]: r["cuts"] for r in long_cuts(long, max_bins).collect()}}  # one row per column


def long_cuts(long: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """``(col, cuts)`` of long values ``(col, v)``: the largest value of each of ``max_bins`` - 1 equal parts in rank order, but for the column's largest."""
    ranked = ranked_values(long)
    part = F.floor(F.col("cum_before") * (max_bins - 1) / F.col("n"))
    ends = ranked.groupBy("col", part.alias("part")).agg(F.max("v").alias("v"), F.max(F.col("cum_before") + F.col("c")).alias("upto"), F.first("n").alias("n"))
    return ends.groupBy("col").agg(F.array_sort(F.collect_list(F.when(F.col("upto") < F.col("n"), F.col("v")))).alias("cuts"))


def binned_rows(df: DataFrame, features: Sequence[str], label: str, cuts: dict[str, list[float]]) -> DataFrame:
    """``(y, draw, bins, margin)``: ``bins`` holds two bytes per column; ``draw`` is a hash of the row."""
    features = list(features)
    edges = df.sparkSession.sparkContext.broadcast([np.array(cuts[c]) for c in features])  # columns x bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(batch, features)
            bins = np.zeros(x.shape, "<u2")
            for i, at in enumerate(edges.value):
                known = ~np.isnan(x[:, i])
                bins[known, i] = np.searchsorted(at, x[known, i], side="left") + 1
            yield pa.RecordBatch.from_arrays([batch.column("_y"), batch.column("_draw"), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(np.zeros(len(x)))],
                                             names=["y", "draw", "bins", "margin"])

    rows = df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y"), F.xxhash64(*features, label).alias("_draw"))
    return rows.mapInArrow(run, "y double, draw long, bins binary, margin double")


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """Bin numbers, NaN for missing values."""
    x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "<u2").reshape(-1, columns).astype(float)
    x[x == 0] = np.nan
    return x


def _drawn(draw: np.ndarray, seed: int, share: float) -> np.ndarray:
    """A pseudo-random share of the rows, another one for each seed."""
    x = draw.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


# ----------------------------------------------------------------- trees

def gradient_sums(rows: DataFrame, columns: int, done: Sequence[Tree] = (), growing: Tree | None = None, open_nodes: dict[int, np.ndarray] | None = None,
                  seed: int = 0, subsample: float = 1.0) -> DataFrame:
    """``(node, col, bin, g, h)`` summed over ``rows``: per open node of ``growing`` (default: the root) and its drawn columns."""
    open_nodes = open_nodes or {0: np.arange(columns)}
    shared = rows.sparkSession.sparkContext.broadcast((list(done), growing, open_nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, tree, nodes = shared.value
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            draw = batch.column("draw").to_numpy()
            x = _matrix(batch, columns)
            margin = batch.column("margin").to_numpy() + sum((t.value[t.leaf_of(x), 0] for t in trees), np.zeros(len(x)))
            p = 1 / (1 + np.exp(-margin))
            g, h = p - batch.column("y").to_numpy(), np.maximum(p * (1 - p), 1e-16)
            at = tree.leaf_of(x) if tree is not None else np.zeros(len(x), np.int64)
            taken = _drawn(draw, seed, subsample) if subsample < 1 else np.ones(len(x), bool)
            for node, cols in nodes.items():
                here = np.flatnonzero((at == node) & taken)
                for c in cols.tolist():
                    b = np.nan_to_num(x[here, c]).astype(np.int64)
                    found = np.stack([np.bincount(b, g[here]), np.bincount(b, h[here])]) if len(b) else np.zeros((2, 1))
                    old = sums.get((node, c))
                    if old is not None:
                        wide = max(old.shape[1], found.shape[1])
                        found = np.pad(found, ((0, 0), (0, wide - found.shape[1]))) + np.pad(old, ((0, 0), (0, wide - old.shape[1])))
                    sums[node, c] = found
        for (node, c), found in sums.items():
            b = np.flatnonzero(found[1] > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), node), pa.int32()), pa.array(np.full(len(b), c), pa.int32()), pa.array(b, pa.int32()), pa.array(found[0][b]), pa.array(found[1][b])],
                                             names=["node", "col", "bin", "g", "h"])

    # a task's sums are combined already; one exchange serves the sums and the windows over them
    return rows.mapInArrow(run, SUMS).repartition("node", "col").groupBy("node", "col", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def split_gains(sums: DataFrame, penalty: Penalty) -> DataFrame:
    """``(node, col, bin, missing_left, gain, gl, hl, gr, hr)`` of every split "up to this bin goes left" that both sides have weight for."""
    group = Window.partitionBy("node", "col")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known = lambda c: F.when(F.col("bin") > 0, F.col(c)).otherwise(0.0)
    missing = lambda c: F.when(F.col("bin") == 0, F.col(c)).otherwise(0.0)
    cum = sums.select("node", "col", "bin", F.sum(known("g")).over(upto).alias("gk"), F.sum(known("h")).over(upto).alias("hk"),
                      F.sum("g").over(group).alias("gt"), F.sum("h").over(group).alias("ht"), F.sum(missing("g")).over(group).alias("gm"), F.sum(missing("h")).over(group).alias("hm"))
    ways = cum.where("bin > 0").withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True)))).where("NOT missing_left OR hm > 0")
    side = F.col("missing_left").cast("double")
    cut = ways.select("node", "col", "bin", "missing_left", "gt", "ht", (F.col("gk") + F.col("gm") * side).alias("gl"), (F.col("hk") + F.col("hm") * side).alias("hl"))
    cut = cut.withColumn("gr", F.col("gt") - F.col("gl")).withColumn("hr", F.col("ht") - F.col("hl"))
    least = F.lit(max(penalty.min_child_weight, 1e-12))
    fits = cut.where((F.col("hl") >= least) & (F.col("hr") >= least))
    gain = penalty.score_of(F.col("gl"), F.col("hl")) + penalty.score_of(F.col("gr"), F.col("hr")) - penalty.score_of(F.col("gt"), F.col("ht"))
    return fits.select("node", "col", "bin", "missing_left", gain.alias("gain"), "gl", "hl", "gr", "hr")


def best_splits(gains: DataFrame, by: Sequence[str] = ("node",)) -> DataFrame:
    """The split with the largest gain of each group; ties go to the first column, bin and way."""
    rest = [c for c in ("node", "col", "bin", "missing_left", "gain", "gl", "hl", "gr", "hr") if c not in by]
    first = F.min(F.struct((-F.col("gain")).alias("_g"), "col", "bin", "missing_left", "node", *[F.col(c).alias(f"_{c}") for c in ("gl", "hl", "gr", "hr")])).alias("s")
    back = {"gain": -F.col("s._g"), "gl": F.col("s._gl"), "hl": F.col("s._hl"), "gr": F.col("s._gr"), "hr": F.col("s._hr")}
    return gains.groupBy(*by).agg(first).select(*by, *[back.get(c, F.col(f"s.{c}")).alias(c) for c in rest])


def _sampled(cols: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    return np.sort(rng.choice(cols, max(1, int(round(share * len(cols)))), replace=False)) if share < 1 and len(cols) else cols


def _grow(rows: DataFrame, columns: int, done: Sequence[Tree], penalty: Penalty, eta: float, max_depth: int, share: tuple[float, float, float], subsample: float, seed: int) -> Tree:
    """One tree over bin numbers."""
    rng = np.random.default_rng(seed)
    of_tree = _sampled(np.arange(columns), share[0], rng)
    nodes = [{"feature": -1, "threshold": 0.0, "missing_left": False, "left": -1, "right": -1, "gain": 0.0, "w": 0.0}]

    def flat(scale: float = 1.0) -> Tree:
        col = lambda k, kind: np.array([n[k] for n in nodes], kind)
        return Tree(col("feature", np.int64), col("threshold", float), col("missing_left", bool), col("left", np.int64), col("right", np.int64), scale * col("w", float)[:, None])

    opened = [0]
    for depth in range(max_depth):
        of_level = _sampled(of_tree, share[1], rng)
        wanted = {n: _sampled(of_level, share[2], rng) for n in opened}
        sums = gradient_sums(rows, columns, done, flat(), wanted, seed, subsample)
        found = best_splits(split_gains(sums, penalty)).where("gain > 1e-6").collect()  # at most one row per open node
        if depth == 0:
            total = (found[0]["gl"] + found[0]["gr"], found[0]["hl"] + found[0]["hr"]) if found else sums.where(F.col("col") == int(wanted[0][0])).agg(F.sum("g"), F.sum("h")).first()
            nodes[0]["w"] = penalty.weight(total[0] or 0.0, total[1] or 0.0)
        opened = []
        for r in sorted(found, key=lambda r: r["node"]):
            n = nodes[r["node"]]
            n.update(feature=r["col"], threshold=float(r["bin"]), missing_left=r["missing_left"], left=len(nodes), right=len(nodes) + 1, gain=r["gain"])
            for g, h in ((r["gl"], r["hl"]), (r["gr"], r["hr"])):
                opened.append(len(nodes))
                nodes.append({"feature": -1, "threshold": 0.0, "missing_left": False, "left": -1, "right": -1, "gain": 0.0, "w": penalty.weight(g, h)})
        if not opened:
            break
    for n in reversed(nodes):  # children stand behind their parents
        if n["feature"] >= 0 and n["gain"] < penalty.gamma and nodes[n["left"]]["feature"] < 0 and nodes[n["right"]]["feature"] < 0:
            n.update(feature=-1, left=-1, right=-1)
    return flat(eta)


# ---------------------------------------------------------------- models

def _margins(model: BoostedModel, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), model.bias)
    for t in model.trees:
        out += t.value[t.leaf_of(x), 0]
    if len(model.weights):
        out += np.where(np.isnan(x), 0.0, x) @ np.asarray(model.weights)
    return out


@dataclass
class BoostedModel:
    """Trees over raw feature values, or a bias and one weight per feature."""

    features: list
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    bias: float = 0.0

    def margins(self, df: DataFrame, out: str = "margin") -> DataFrame:
        """``df`` with the margin of every row (columns of vectors are left out)."""
        return with_scores(df, self.features, _margins, self, out)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.margins(df, "margin").withColumn("prediction", (F.col("margin") > 0).cast("double"))

    def as_dict(self) -> dict:
        return {"features": list(self.features), "trees": [t.as_dict() for t in self.trees], "weights": list(map(float, self.weights)), "bias": float(self.bias)}

    @staticmethod
    def from_dict(d: dict) -> BoostedModel:
        return BoostedModel(d["features"], [Tree.from_dict(t) for t in d["trees"]], d["weights"], d["bias"])


def fit_boosted_trees(df: DataFrame, features: Sequence[str], label: str, eta: float = 0.3, penalty: Penalty = Penalty(), rounds: int = ROUNDS, max_depth: int = MAX_DEPTH,
                      colsample_bytree: float = 1.0, colsample_bylevel: float = 1.0, colsample_bynode: float = 1.0, subsample: float = 1.0, max_bins: int = MAX_BINS,
                      seed: int = 42, checkpoint_every: int = 10, cuts: dict[str, list[float]] | None = None) -> BoostedModel:
    """Boosted trees; ``label`` is 0 or 1."""
    features = list(features)
    cuts = cuts or quantile_cuts(df, features, max_bins)
    rows = cut_lineage(binned_rows(df, features, label, cuts))
    trees: list[Tree] = []
    since: list[Tree] = []
    for r in range(rounds):
        tree = _grow(rows, len(features), since, penalty, eta, max_depth, (colsample_bytree, colsample_bylevel, colsample_bynode), subsample, seed * 10_007 + r)
        trees.append(tree)
        since.append(tree)
        if len(since) == checkpoint_every and r + 1 < rounds:
            rows, since = cut_lineage(_replayed(rows, len(features), since)), []
    for t in trees:  # bin numbers become values
        inner = t.feature >= 0
        t.threshold[inner] = [cuts[features[f]][int(b) - 1] if b <= len(cuts[features[f]]) else math.inf for f, b in zip(t.feature[inner], t.threshold[inner], strict=True)]
    return BoostedModel(features, trees)


def _replayed(rows: DataFrame, columns: int, trees: list[Tree]) -> DataFrame:
    """The rows with the trees' values in their margins."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, columns)
            margin = batch.column("margin").to_numpy() + sum(t.value[t.leaf_of(x), 0] for t in shared.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("y", "draw", "bins")), pa.array(margin)], names=["y", "draw", "bins", "margin"])

    return rows.mapInArrow(run, rows.schema)


def fit_boosted_linear(df: DataFrame, features: Sequence[str], label: str, eta: float = 0.5, penalty: Penalty = Penalty(lambda_=0.0), rounds: int = ROUNDS) -> BoostedModel:
    """The linear booster: each round one pass of sums, then all coefficients move at once by their own second-order step.

    ``lambda_`` and ``alpha`` weigh against the sums of all rows; NULL and NaN count as 0.
    """
    features = list(features)
    value = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = cut_lineage(df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), F.array(*map(value, features)).alias("_x")))
    model = BoostedModel(features, weights=[0.0] * len(features))
    for _ in range(rounds):
        def step(bias: float, weights: Sequence[float]) -> np.ndarray:
            shared = rows.sparkSession.sparkContext.broadcast((bias, np.asarray(weights)))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                b, w = shared.value
                total = np.zeros(2 * len(w) + 2)
                for batch in batches:
                    x = batch.column("_x").flatten().to_numpy().reshape(-1, len(w))
                    p = 1 / (1 + np.exp(-(x @ w + b)))
                    g, h = p - batch.column("_y").to_numpy(), p * (1 - p)
                    total += np.concatenate([[g.sum(), h.sum()], g @ x, h @ (x * x)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "s"])

            found = rows.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # two rows per column
            out = np.zeros(2 * len(features) + 2)
            for r in found:
                out[r["i"]] = r["s"]
            return out

        g, h, *_ = step(model.bias, model.weights)
        model.bias += eta * (-g / h if h > 0 else 0.0)
        sums = step(model.bias, model.weights)
        w, gx, hx = np.asarray(model.weights), sums[2:2 + len(features)], sums[2 + len(features):]
        gl, hl = gx + penalty.lambda_ * w, hx + penalty.lambda_
        with np.errstate(divide="ignore", invalid="ignore"):
            plain = w - gl / hl
            moved = np.sign(plain) * np.maximum(np.abs(plain) - penalty.alpha / hl, 0.0) - w
        model.weights = (w + eta * np.where(hl > 1e-12, moved, 0.0)).tolist()
    return model
