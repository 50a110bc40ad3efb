"""Regression imputation under one joint model of all columns (M3).

A gap gets its conditional mean given every observed cell of its row. That is where column-by-column regression sweeps over a row's
gaps end, whatever their order; here it is solved at once: with precision matrix P and the row's missing columns m, the gaps are
``mean_m - inv(P_mm) (P d)_m``, d being the row's deviations with zeros in the gaps.

The model is fitted by expectation and maximisation. One pass over the rows fills the gaps under the current model and adds up the
Gram matrix of the filled rows; each gap also adds its conditional covariance ``inv(P_mm)``, without which filled cells would count as
certain and every refill would shrink the variances. The maximisation is a p x p problem of the driver, bounded by the schema. A prior
worth ``prior_rows`` rows of independent columns ridges all regressions alike.

A pass is one Spark job: tasks add up over Arrow batches and send p rows of p + 1 numbers each, which are summed per row of the matrix.
Rows of a batch with the same gaps share one small inverse. The input is checkpointed once and never rewritten.

Defined results: NULL and NaN are gaps; infinite values are not allowed (ingest quarantines them); observed cells are returned
unchanged; a column without a value is filled with 0, a constant one with its constant; a row without a value gets the means; an
empty table yields a fit that fills with 0. Columns other than the features pass through untouched, also repeated rows and keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkqc.session import cut_lineage


@dataclass
class JointImputerFit:
    columns: list
    centre: list     # observed mean and deviation of each column: the model's unit
    scale: list
    mean: list       # of the model, in these units
    precision: list  # p x p
    iterations: int = 0


def _cells(batch: pa.RecordBatch, at: Sequence[int], centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    x = np.column_stack([batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in at]) if at else np.zeros((batch.num_rows, 0))
    return (x - centre) / scale


def fill(x: np.ndarray, mean: np.ndarray, precision: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x`` with its gaps (NaN) at their conditional means, and the sum of the gaps' conditional covariances."""
    p = len(mean)
    covariance = np.zeros((p, p))
    gaps = np.isnan(x)
    rows = np.flatnonzero(gaps.any(1))
    if not len(rows):
        return x, covariance
    out = x.copy()
    pull = np.where(gaps[rows], 0.0, x[rows] - mean) @ precision
    bits = np.packbits(gaps[rows], axis=1)
    _, first, which = np.unique(bits, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    for same in np.split(order, np.cumsum(np.bincount(which))[:-1]):
        m = np.flatnonzero(gaps[rows[same[0]]])
        spread = np.linalg.inv(precision[np.ix_(m, m)])
        out[np.ix_(rows[same], m)] = mean[m] - pull[np.ix_(same, m)] @ spread
        covariance[np.ix_(m, m)] += len(same) * spread
    return out, covariance


def _expectation(base: DataFrame, centre: np.ndarray, scale: np.ndarray, mean: np.ndarray, precision: np.ndarray) -> np.ndarray:
    """``(p + 1) x p``: the sums of the filled columns, then their Gram matrix with the gaps' covariances."""
    p = len(mean)
    model = base.sparkSession.sparkContext.broadcast((centre, scale, mean, precision))  # p x p numbers

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, width, mu, inverse = model.value
        total = np.zeros((p + 1, p))
        for batch in batches:
            x, covariance = fill(_cells(batch, range(p), unit, width), mu, inverse)
            total[0] += x.sum(0)
            total[1:] += x.T @ x + covariance
        yield pa.RecordBatch.from_arrays([pa.array(range(p + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "line"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # the lines of this task: p + 1 of p numbers at most
        for batch in batches:
            lines = batch.column(1).flatten().to_numpy().reshape(-1, p)
            for i, line in zip(batch.column(0).to_pylist(), lines, strict=True):
                held[i] = held[i] + line if i in held else line.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["i", "line"])

    kind = "i int, line array<double>"
    out = np.zeros((p + 1, p))
    for r in base.mapInArrow(sums, kind).repartition("i").mapInArrow(add, kind).collect():  # p + 1 lines
        out[r["i"]] = r["line"]
    return out


def fit_joint_imputer(df: DataFrame, features: Sequence[str], max_iter: int = 25, prior_rows: float = 20.0, tol: float = 1e-4) -> JointImputerFit:
    """Fitted on ``features`` (numeric). Passes end when no mean or covariance (in units of the columns' deviations) moves by ``tol``."""
    cols = list(features)
    p = len(cols)
    if not p:
        return JointImputerFit([], [], [], [], [])
    clean = df.select(*[F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    base = cut_lineage(clean)
    first = base.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(p)], *[F.stddev_pop(f"c{i}").alias(f"s{i}") for i in range(p)]).first()
    n = first["n"]
    centre = np.array([first[f"m{i}"] or 0.0 for i in range(p)])
    scale = np.array([first[f"s{i}"] or 1.0 for i in range(p)])
    mean, covariance = np.zeros(p), np.eye(p)
    fit = JointImputerFit(cols, centre.tolist(), scale.tolist(), mean.tolist(), covariance.tolist())
    while n and fit.iterations < max_iter:
        found = _expectation(base, centre, scale, mean, np.linalg.inv(covariance))
        new_mean = found[0] / n
        new = (found[1:] - n * np.outer(new_mean, new_mean) + prior_rows * np.eye(p)) / (n + prior_rows)
        new[np.diag_indices(p)] += 1e-10  # constant columns have no variance of their own
        moved = max(np.abs(new_mean - mean).max(), np.abs(new - covariance).max())
        mean, covariance = new_mean, new
        fit.iterations += 1
        if moved < tol:
            break
    fit.mean, fit.precision = mean.tolist(), np.linalg.inv(covariance).tolist()
    return fit


def apply_joint(df: DataFrame, fit: JointImputerFit) -> DataFrame:
    """``df`` with the gaps of the fitted columns filled: one pass without a shuffle."""
    if not fit.columns:
        return df
    at = [df.columns.index(c) for c in fit.columns]
    schema = StructType([StructField(f.name, DoubleType()) if i in at else f for i, f in enumerate(df.schema.fields)])
    model = df.sparkSession.sparkContext.broadcast((np.array(fit.centre), np.array(fit.scale), np.array(fit.mean), np.array(fit.precision)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, scale, mean, precision = model.value
        for batch in batches:
            x = _cells(batch, at, centre, scale)
            full, _ = fill(x, mean, precision)
            columns = list(batch.columns)
            for j, i in enumerate(at):
                seen = columns[i].cast(pa.float64()).to_numpy(zero_copy_only=False)
                columns[i] = pa.array(np.where(np.isnan(x[:, j]), full[:, j] * scale[j] + centre[j], seen))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, schema)
