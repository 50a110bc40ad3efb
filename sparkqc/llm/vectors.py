"""Vectors in Arrow batches and rows sorted into groups: helpers of the two vector searches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def matrix(column: pa.ListArray | pa.ChunkedArray, dim: int, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column; shorter vectors are padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim).astype(kind, copy=False)
    out = np.zeros((len(lengths), dim), kind)
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else np.zeros(0, int)] = flat
    return out


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``names``, whole, from sorted rows."""
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        cols = [rows.column(c).to_numpy() for c in names]
        change = np.zeros(max(0, len(rows) - 1), bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(rows)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.concat_tables(held)


def dimension(rows: DataFrame, column: str) -> int:
    return int(rows.agg(F.max(F.size(column))).first()[0] or 0)


def pivots(rows: DataFrame, id_col: str, vector_col: str, n: int, dim: int, seed: int) -> np.ndarray:
    """``n`` rows in the order of a hash of their ids: at most n vectors come to the driver."""
    found = rows.select(vector_col, id_col).orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(n).collect()
    out = np.zeros((len(found), dim))
    for i, r in enumerate(found):
        out[i, :len(r[0])] = r[0]
    return np.unique(out, axis=0)
