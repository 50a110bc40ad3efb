"""Decision trees as flat node tables, and their batch evaluation.

A tree is a set of parallel arrays over its nodes, the root first: ``feature`` (-1 at a leaf), ``threshold`` (rows with a value
up to it go left), ``missing_left`` (where NULL and NaN go), ``left`` / ``right`` and a ``value`` row per node. Trees are bounded by
their depth, so they travel as one broadcast; rows are evaluated in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType


@dataclass
class Tree:
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.feature < 0).sum())

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf that each row of ``x`` (rows x features) comes to."""
        node = np.zeros(len(x), np.int64)
        going = np.flatnonzero(self.feature[node] >= 0)
        while len(going):
            at = node[going]
            v = x[going, self.feature[at]]
            goes_left = np.where(np.isnan(v), self.missing_left[at], v <= self.threshold[at])
            node[going] = np.where(goes_left, self.left[at], self.right[at])
            going = going[self.feature[node[going]] >= 0]
        return node

    def as_dict(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("feature", "threshold", "missing_left", "left", "right", "value")}

    @staticmethod
    def from_dict(d: dict) -> Tree:
        return Tree(np.array(d["feature"], np.int64), np.array(d["threshold"], float), np.array(d["missing_left"], bool),
                    np.array(d["left"], np.int64), np.array(d["right"], np.int64), np.array(d["value"], float))


def feature_matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    """Columns of a batch as a float matrix; NULL becomes NaN."""
    out = np.empty((batch.num_rows, len(features)))
    for i, c in enumerate(features):
        out[:, i] = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def with_scores(df: DataFrame, features: Sequence[str], score: Callable[[np.ndarray], np.ndarray], shared, out: str) -> DataFrame:
    """``df`` with ``out``: ``score(shared value, matrix)`` per row, an array if it has several columns, in one Arrow pass.

    Vector columns (user-defined types) are not carried along.
    """
    keep = [f for f in df.schema.fields if f.dataType.typeName() != "udt" and "Vector" not in type(f.dataType).__name__ and f.name != out]
    bc = df.sparkSession.sparkContext.broadcast(shared)
    features, names = list(features), [f.name for f in keep]
    several = np.ndim(score(shared, np.zeros((1, len(features))))) == 2
    schema = StructType([*keep, StructField(out, ArrayType(DoubleType()) if several else DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = score(bc.value, feature_matrix(batch, features))
            col = pa.array(list(found), pa.list_(pa.float64())) if several else pa.array(found, pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), col], names=[*names, out])

    return df.select(*names).mapInArrow(run, schema)
