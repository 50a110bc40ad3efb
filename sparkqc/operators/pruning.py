"""Minimal cost-complexity pruning of fitted trees.

A fitted Spark ML tree becomes a node table (node, parent, children, split, weight, impurity, value); the row count of a node is its
weight. Weakest-link pruning: with R(t) = impurity times the node's share of the weight, and R(T) the sum over the leaves below it,
an inner node is worth g = (R(t) - R(T)) / (leaves - 1) per leaf. The node with the smallest g goes first, then the
next in what is left; the values of g on the way are the alphas of the path. ``prune`` takes away everything worth ``alpha`` or less.

Tables are bounded by a tree's nodes, not by the rows it was fitted on; fits and predictions are Spark jobs. Defined
results: a tree of one leaf has the path [0]; equal g go together, the smaller node number first; NULL values go right, as
NaN does in Spark ML; a node without weight is worth nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.operators.trees import Tree, with_scores

NODES = ("tree int, node int, parent int, left int, right int, feature int, threshold double, weight double, impurity double, value array<double>")


@dataclass
class NodeTable:
    """Nodes of one tree, the root first and children behind their parents."""

    parent: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    weight: np.ndarray
    impurity: np.ndarray
    value: np.ndarray  # nodes x classes: share of each class

    def rows(self, tree: int = 0) -> list[tuple]:
        return [(tree, i, int(self.parent[i]), int(self.left[i]), int(self.right[i]), int(self.feature[i]), float(self.threshold[i]), float(self.weight[i]), float(self.impurity[i]),
                 [float(v) for v in self.value[i]]) for i in range(len(self.parent))]

    def tree(self) -> Tree:
        return Tree(self.feature, self.threshold, np.zeros(len(self.parent), bool), self.left, self.right, self.value)


def node_table(root) -> NodeTable:
    """Nodes of a fitted Spark ML tree from its root node."""
    nodes: list[dict] = []

    def add(node, parent: int) -> int:
        i = len(nodes)
        counts = np.array(list(node.impurityStats().stats()), float)
        total = counts.sum()
        nodes.append({"parent": parent, "left": -1, "right": -1, "feature": -1, "threshold": 0.0, "weight": total, "impurity": float(node.impurity()),
                      "value": counts / total if total > 0 else np.full(len(counts), 1 / max(1, len(counts)))})
        return i

    todo = [(root, add(root, -1))]
    while todo:
        node, i = todo.pop()
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[i].update(feature=split.featureIndex(), threshold=float(split.threshold()))
            for side, child in (("left", node.leftChild()), ("right", node.rightChild())):
                nodes[i][side] = add(child, i)
                todo.append((child, nodes[i][side]))
    col = lambda k, kind: np.array([n[k] for n in nodes], kind)
    return NodeTable(col("parent", np.int64), col("left", np.int64), col("right", np.int64), col("feature", np.int64), col("threshold", float), col("weight", float), col("impurity", float),
                     np.stack([n["value"] for n in nodes]))


def node_tables(model) -> list[NodeTable]:
    """Node tables of a Spark ML classification tree or forest."""
    java = model._java_obj
    return [node_table(t.rootNode()) for t in java.trees()] if hasattr(model, "trees") else [node_table(java.rootNode())]


def as_frame(spark: SparkSession, tables: Sequence[NodeTable]) -> DataFrame:
    return spark.createDataFrame([r for t, table in enumerate(tables) for r in table.rows(t)], NODES)


def _collapse(table: NodeTable, upto: float | None) -> tuple[list[float], np.ndarray]:
    """(alphas of the path, which nodes are leaves at the end): weakest links go while they are worth ``upto`` or less (None: all)."""
    n = len(table.parent)
    whole = table.weight[0] or 1.0
    risk = table.impurity * table.weight / whole
    leaf = table.feature < 0
    below, leaves = np.where(leaf, risk, 0.0), leaf.astype(float)
    for i in range(n - 1, 0, -1):  # children stand behind their parents
        below[table.parent[i]] += below[i]
        leaves[table.parent[i]] += leaves[i]
    alive = np.ones(n, bool)
    alphas = [0.0]
    while not leaf[0]:
        inner = np.flatnonzero(alive & ~leaf)
        worth = (risk[inner] - below[inner]) / (leaves[inner] - 1)
        at = int(inner[np.argmin(worth)])
        g = max(float(worth.min()), 0.0)
        if upto is not None and g > upto:
            break
        if g > alphas[-1] + 1e-15:
            alphas.append(g)
        todo = [int(table.left[at]), int(table.right[at])]
        while todo:
            x = todo.pop()
            alive[x] = False
            if not leaf[x]:
                todo += [int(table.left[x]), int(table.right[x])]
        lost, gained, up = leaves[at] - 1, risk[at] - below[at], at
        leaf[at] = True
        while up >= 0:
            leaves[up] -= lost
            below[up] += gained
            up = int(table.parent[up])
    return alphas, leaf


def pruning_path(table: NodeTable) -> list[float]:
    """Alphas at which the tree loses nodes, from 0 to that which leaves the root alone."""
    return _collapse(table, None)[0]


def prune(table: NodeTable, alpha: float) -> NodeTable:
    """The smallest subtree whose inner nodes are all worth more than ``alpha``."""
    _, leaf = _collapse(table, alpha)
    keep, todo = [], [0]
    while todo:
        x = todo.pop()
        keep.append(x)
        if not leaf[x]:
            todo += [int(table.left[x]), int(table.right[x])]
    keep = sorted(keep)
    new = {old: i for i, old in enumerate(keep)}
    to = lambda of: np.array([new.get(int(of[i]), -1) for i in keep], np.int64)
    idx = np.array(keep)
    return NodeTable(to(table.parent), np.where(leaf[idx], -1, to(table.left)), np.where(leaf[idx], -1, to(table.right)), np.where(leaf[idx], -1, table.feature[idx]),
                     np.where(leaf[idx], 0.0, table.threshold[idx]), table.weight[idx], table.impurity[idx], table.value[idx])


def _leaf(tree: Tree, x: np.ndarray) -> np.ndarray:
    return tree.leaf_of(x).astype(float)


def measured(tree: Tree, df: DataFrame, features: Sequence[str], label: str, classes: int) -> NodeTable:
    """Node table of a given tree with the class counts of the rows of ``df``: a tree can so be pruned by rows that it wasn't grown on.

    Rows are counted per leaf and class by one aggregate; labels are 0 to ``classes`` - 1, others and NULL don't count.
    """
    at = with_scores(df.select(label, *features), features, _leaf, tree, "_leaf")
    rows = at.where(F.col(label).between(0, classes - 1)).groupBy(F.col("_leaf").cast("int").alias("leaf"), F.col(label).cast("int").alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = len(tree.feature)
    counts, parent = np.zeros((n, classes)), np.full(n, -1, np.int64)
    for r in rows:  # at most leaves x classes
        counts[r["leaf"], r["c"]] = r["n"]
    for i in range(n):
        if tree.feature[i] >= 0:
            parent[tree.left[i]] = parent[tree.right[i]] = i
    for i in range(n - 1, 0, -1):
        counts[parent[i]] += counts[i]
    weight = counts.sum(1)
    share = counts / np.where(weight > 0, weight, 1)[:, None]
    return NodeTable(parent, tree.left, tree.right, tree.feature, tree.threshold, weight, np.where(weight > 0, 1 - (share ** 2).sum(1), 0.0), np.where(weight[:, None] > 0, share, 1 / classes))


def _shares(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    return sum(t.value[t.leaf_of(x)] for t in trees) / len(trees)


@dataclass
class PrunedTrees:
    """A pruned tree or forest: class shares are averaged over the trees."""

    features: list
    tables: list

    def transform(self, df: DataFrame) -> DataFrame:
        scored = with_scores(df, self.features, _shares, [t.tree() for t in self.tables], "probability")
        best = F.array_max("probability")
        return scored.withColumn("prediction", (F.array_position("probability", best) - 1).cast("double"))

    def as_dict(self) -> dict:
        return {"features": list(self.features), "tables": [[list(r) for r in t.rows()] for t in self.tables]}

    @staticmethod
    def from_dict(d: dict) -> PrunedTrees:
        tables = []
        for rows in d["tables"]:
            cols = list(zip(*rows, strict=True))
            ints = [np.array(c, np.int64) for c in cols[2:6]]
            tables.append(NodeTable(*ints, np.array(cols[6], float), np.array(cols[7], float), np.array(cols[8], float), np.array(cols[9], float)))
        return PrunedTrees(d["features"], tables)
