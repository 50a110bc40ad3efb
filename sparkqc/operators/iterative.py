"""Round-robin regression imputation at scale (M3).

Per round: one distributed pass gives the column means, variances and the
Pearson correlation matrix of the current filled frame (p x p, bounded by the
schema, via Spark ML's ``Summarizer`` and ``Correlation``); the driver solves a
small ridge system for every column on its ``n_nearest`` most correlated
predictors; the refill of the originally missing cells runs inside the tasks
on Arrow batches (``mapInPandas``), as a sparse product with the round's
coefficients. Written as Column expressions, rounds would nest p x 20 terms
per column per round and Catalyst would inline them through every round; as a
batch operator each round is a flat, vectorised step. The input is
checkpointed once; round r replays rounds 1..r-1 inside the batch step (cheap
numpy work on cells) instead of writing the whole table every round.

All columns get a regression (also complete ones), so NULLs seen only at
prediction time are filled too. Rounds update all columns together (Jacobi
order) and predictors are the top-|r| ones, so values differ slightly from a
sequential sampler.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkqc.session import cut_lineage


@dataclass
class IterativeImputerFit:
    columns: list
    means: dict
    rounds: list = field(default_factory=list)  # [{target: (intercept, [(predictor, coef), ...])}]

    def fit_rows(self) -> list[tuple[int, str, str, float]]:
        """Flat (round, target, term, value) rows for a fit table; term '' is the intercept."""
        out = [(-1, c, "", float(m)) for c, m in self.means.items()]
        for r, rnd in enumerate(self.rounds):
            for t, (b0, terms) in rnd.items():
                out.append((r, t, "", float(b0)))
                out += [(r, t, p, float(b)) for p, b in terms]
        return out

    def arrays(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per round: intercepts (p,), predictor indices (p, m), coefficients (p, m), has-model flags (p,)."""
        pos = {c: i for i, c in enumerate(self.columns)}
        p = len(self.columns)
        out = []
        for rnd in self.rounds:
            m = max([len(t) for _, t in rnd.values()] + [1])
            b0 = np.array([rnd[c][0] if c in rnd else 0.0 for c in self.columns])
            idx = np.zeros((p, m), dtype=np.int64)
            coef = np.zeros((p, m))
            has = np.zeros(p, dtype=bool)
            for c, (_, terms) in rnd.items():
                i = pos[c]
                has[i] = True
                for k, (pc, b) in enumerate(terms):
                    idx[i, k] = pos[pc]
                    coef[i, k] = b
            out.append((b0, idx, coef, has))
        return out


def _moments(df: DataFrame, cols: Sequence[str], change: str | None = None):
    """Mean, variance (and the max of ``change``) in one Summarizer pass; correlation in one more."""
    extra = [change] if change else []
    vec = VectorAssembler(inputCols=[*cols, *extra], outputCol="_vec").transform(df).select("_vec")
    s = vec.select(Summarizer.metrics("mean", "variance", "max").summary(F.col("_vec")).alias("s")).first()["s"]
    p = len(cols)
    corr = Correlation.corr(vec, "_vec").first()[0].toArray()[:p, :p]
    mx = float(s["max"].toArray()[p]) if change else float("inf")
    return (np.asarray(s["mean"].toArray())[:p], np.asarray(s["variance"].toArray())[:p], np.nan_to_num(corr), mx)


def _solve(mean, var, corr, t: int, n_nearest: int, ridge: float):
    p = len(mean)
    cand = [j for j in range(p) if j != t and var[j] > 0]
    if var[t] <= 0 or not cand:
        return float(mean[t]), []
    cand = sorted(cand, key=lambda j: (-abs(corr[t, j]), j))[:n_nearest]
    sd = np.sqrt(var)
    cov_pp = corr[np.ix_(cand, cand)] * np.outer(sd[cand], sd[cand])
    cov_pt = corr[cand, t] * sd[cand] * sd[t]
    a = cov_pp + ridge * np.diag(np.diag(cov_pp))
    beta = np.linalg.solve(a, cov_pt)
    b0 = float(mean[t] - beta @ mean[cand])
    return b0, [(j, float(b)) for j, b in zip(cand, beta)]


def _refill(df: DataFrame, cols: list, means: np.ndarray, rounds: list, mask_cols: list | None = None,
            track_change: bool = False) -> DataFrame:
    """Apply ``rounds`` to the missing cells, batch by batch.

    Without ``mask_cols`` the NULL cells of ``cols`` are the mask and start from
    the means; with them (``_m*`` booleans) ``cols`` already hold the current fill.
    ``track_change`` adds ``_chg``: the row's largest change of an imputed cell.
    """
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((means, rounds))  # p x m x rounds numbers: bounded by the schema
    out_fields = [f if f.name not in cols else StructField(f.name, DoubleType(), True)
                  for f in df.schema.fields if f.name != "_chg"]
    if track_change:
        out_fields.append(StructField("_chg", DoubleType(), True))
    schema = StructType(out_fields)

    def run(batches):
        mu, rnds = bc.value
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float, na_value=np.nan)
            if mask_cols is None:
                miss = np.isnan(x)
                x = np.where(miss, mu, x)
            else:
                miss = pdf[mask_cols].to_numpy(dtype=bool)
            start = x
            for b0, idx, coef, has in rnds:
                start = x
                pred = np.broadcast_to(b0, x.shape).copy()
                for k in range(idx.shape[1]):
                    pred += x[:, idx[:, k]] * coef[:, k]
                x = np.where(miss & has, pred, x)
            res = pdf.copy()
            res[cols] = x
            if track_change:  # change made by the last round
                res["_chg"] = np.where(miss, np.abs(x - start), 0.0).max(axis=1) if x.shape[1] else 0.0
            yield res[[f.name for f in out_fields]]

    return df.mapInPandas(run, schema)


def fit_iterative_imputer(df: DataFrame, features: Sequence[str], max_iter: int = 10, n_nearest: int = 20,
                          ridge: float = 1e-3, tol: float = 1e-3) -> tuple[IterativeImputerFit, DataFrame]:
    """Returns (fit, imputed frame, lazy). ``df`` keeps its other columns (keys, label)."""
    cols = list(features)
    first = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    means = {c: (first[c] if first[c] is not None else 0.0) for c in cols}
    mu = np.array([means[c] for c in cols])
    base = cut_lineage(df.select(*df.columns))  # read once per pass, never rewritten
    fit = IterativeImputerFit(cols, means)
    current = _refill(base, cols, mu, [])  # round 0: mean fill
    for _ in range(max_iter):
        current = current.persist()  # shared by the two statistics passes; recomputable from lineage
        mean, var, corr, change = _moments(current, cols, "_chg" if fit.rounds else None)
        current.unpersist()
        scale = float(np.sqrt(np.max(var))) if len(var) else 1.0
        if fit.rounds and scale > 0 and change / scale < tol:
            break
        rnd = {}
        for t, c in enumerate(cols):
            b0, terms = _solve(mean, var, corr, t, n_nearest, ridge)
            rnd[c] = (b0, [(cols[j], b) for j, b in terms])
        fit.rounds.append(rnd)
        current = _refill(base, cols, mu, fit.arrays(), track_change=True)
    return fit, _refill(base, cols, mu, fit.arrays())


def apply_iterative(df: DataFrame, fit: IterativeImputerFit) -> DataFrame:
    """Replay on new rows: mean fill, then every round's regressions on the NULL cells
    (per Arrow batch; no shuffle)."""
    mu = np.array([fit.means[c] for c in fit.columns])
    return _refill(df, list(fit.columns), mu, fit.arrays())
