"""Missing-value profile, plan and imputation (A2, M1, M2, M4).

The null-indicator correlation of every column pair comes from co-occurrence
counts: for indicators over N rows with n_a, n_b missing cells and n_ab rows
missing both,

    r = (N n_ab - n_a n_b) / sqrt(n_a (N - n_a) n_b (N - n_b)).

Rows are numbered, and a column's missing rows are bitmaps, one per slice of
32,768 rows (``bitmap_construct_agg``, combined map-side). The bitmaps of a slice
meet in one task, at most one per column; n_ab is the popcount of their AND,
added up over slices. Cells are never shuffled by row, and no pairs are made
per row: pair counts leave a task as at most p x p sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.operators.profile import missing_profile, moments, per_column, quantiles


def _ddl(cols: list) -> str:
    return "bigint" if cols and isinstance(cols[0], int) else "string"


def _numbered(holes: DataFrame, key: str) -> DataFrame:
    """``holes`` with a dense row number ``_slot`` for every key."""
    ids = holes.select(F.col(key).alias("_k")).distinct().withColumn("_slot", F.monotonically_increasing_id())
    return holes.join(ids, F.col(key).eqNullSafe(F.col("_k"))).drop("_k")


def missing_pairs(holes: DataFrame, cols: list, col: str = "col", slot: str = "_slot") -> DataFrame:
    """``(col_a, col_b, n_a, n_b, n_ab)`` for all ordered pairs of ``cols``: missing cells of both, and rows that miss both.

    ``holes`` has one row per missing cell: its column and the number of its row.
    """
    names = holes.sparkSession.sparkContext.broadcast(cols)  # one per column
    kind = dict(holes.dtypes)[col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {c: i for i, c in enumerate(names.value)}
        m = len(order)
        both = np.zeros((m, m), np.int64)
        held: dict[int, np.ndarray] = {}
        slice_ = None

        def add() -> None:
            at = np.array(sorted(held), np.int64)
            bits = np.stack([held[i] for i in at.tolist()])
            for i, row in zip(at.tolist(), bits, strict=True):
                both[i, at] += np.bitwise_count(bits & row).sum(1, dtype=np.int64)

        for batch in batches:
            for s, c, bitmap in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if held and s != slice_:
                    add()
                    held = {}
                slice_ = s
                held[order[c]] = np.frombuffer(bitmap, np.uint64)
        if held:
            add()
        a, b = np.divmod(np.arange(m * m), m)
        own = both.diagonal()
        labels = pa.array(names.value)
        yield pa.RecordBatch.from_arrays([labels.take(pa.array(a)), labels.take(pa.array(b)), pa.array(own[a]), pa.array(own[b]), pa.array(both[a, b])], names=["col_a", "col_b", "n_a", "n_b", "n_ab"])

    bitmaps = holes.where(F.col(col).isin(cols)).groupBy(F.bitmap_bucket_number(slot).alias("slice"), F.col(col)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    met = bitmaps.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, f"col_a {kind}, col_b {kind}, n_a long, n_b long, n_ab long")
    return met.groupBy("col_a", "col_b").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_ab")])


def missingness_corr(long: DataFrame, key: str, col: str = "col", value: str = "v", slot: str | None = None) -> DataFrame:
    """A2: ``(col_a, col_b, r)`` for every pair of columns whose indicator varies (0 < n_missing < N).

    ``slot`` names a column with a whole number per row, dense as row numbers are (from ``monotonically_increasing_id`` or
    an unbroken key); without it the keys of incomplete rows are numbered first, by one more exchange.
    """
    spark = long.sparkSession
    prof = long.groupBy(col).agg(F.count_if(F.col(value).isNull()).alias("n_missing"), F.count(F.lit(1)).alias("N"))
    varying = prof.where((F.col("n_missing") > 0) & (F.col("n_missing") < F.col("N")))
    info = {r[col]: r["N"] for r in varying.collect()}  # one row per column
    cols = sorted(info)
    if not cols:
        return spark.createDataFrame([], f"col_a {_ddl(cols)}, col_b {_ddl(cols)}, r double")
    holes = long.where(F.col(value).isNull())
    numbered = holes.select(F.col(col), F.col(slot).cast("long").alias("_slot")) if slot else _numbered(holes, key)
    pairs = missing_pairs(numbered, cols, col)
    total = F.lit(float(max(info.values())))
    na, nb, nab = (F.col(c).cast("double") for c in ("n_a", "n_b", "n_ab"))
    r = (total * nab - na * nb) / F.sqrt(na * (total - na) * nb * (total - nb))
    return pairs.select("col_a", "col_b", r.alias("r"))


def impute_plan(long: DataFrame, key: str, col: str = "col", value: str = "v", drop_above: float = 0.8,
                corr_above: float = 0.6, skew_band: float = 0.5, strict_order: bool = True, order: Sequence | None = None, slot: str | None = None) -> DataFrame:
    """M1: ``(col, prop_missing, skew, strategy)`` for every column with a NULL.

    drop if share > 0.8; else 'mean' / 'median' (by |skew| < 0.5) when no other
    column's null indicator has |r| > 0.6 with it; else 'iterative'. With
    ``strict_order`` a column dropped earlier in column order is not counted
    (columns are dropped in a loop over them). ``order`` lists the columns in
    their table's order; without it ids are compared (numbers, never names). ``slot``: see ``missingness_corr``.
    """
    prof = missing_profile(long, col, value)
    mo = moments(long, col, value).select(col, "skew")
    p = prof.join(per_column(mo), col).where(F.col("n_missing") > 0)
    drop_flag = F.col("prop_missing") > drop_above
    corr = missingness_corr(long, key, col, value, slot)
    dropped = p.where(drop_flag).select(F.col(col).alias("col_b"), F.lit(True).alias("_b_drop"))
    c = corr.join(per_column(dropped), "col_b", "left")
    before = F.col("col_b") < F.col("col_a")
    if order is not None:  # one row per column
        places = long.sparkSession.createDataFrame([(x, i) for i, x in enumerate(order)], f"c {_ddl(list(order))}, i int")
        for side in ("a", "b"):
            c = c.join(per_column(places.select(F.col("c").alias(f"col_{side}"), F.col("i").alias(f"_i_{side}"))), f"col_{side}")
        before = F.col("_i_b") < F.col("_i_a")
    excluded = F.coalesce(F.col("_b_drop"), F.lit(False)) & before if strict_order else F.lit(False)
    strong = (c.where((F.abs("r") > corr_above) & ~excluded)
              .groupBy(F.col("col_a").alias(col)).agg(F.count(F.lit(1)).alias("n_strong")))
    j = p.join(per_column(strong), col, "left").fillna(0, ["n_strong"])
    strat = (F.when(drop_flag, "drop")
             .when(F.col("n_strong") - 1 <= 0, F.when((F.col("skew") > -skew_band) & (F.col("skew") < skew_band), "mean").otherwise("median"))
             .otherwise("iterative"))
    return j.select(col, "prop_missing", "skew", strat.alias("strategy"))


def fit_simple_imputer(long: DataFrame, strategy: str, col: str = "col", value: str = "v") -> DataFrame:
    """M2 fit: ``(col, fill)`` mean or exact median of the observed values."""
    if strategy == "mean":
        return long.groupBy(col).agg(F.avg(value).alias("fill"))
    if strategy == "median":
        return quantiles(long, (0.5,), col, value, names=("fill",)).select(col, "fill")
    raise ValueError(strategy)


def impute_long(long: DataFrame, fit: DataFrame, col: str = "col", value: str = "v") -> DataFrame:
    """M2 apply: ``coalesce(v, fill)``; columns without a fit row pass unchanged."""
    j = long.join(per_column(fit.select(col, F.col("fill").alias("_fill"))), col, "left")
    return j.withColumn(value, F.coalesce(F.col(value), F.col("_fill"))).drop("_fill")


def impute_wide(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """M2 apply on wide: one projection with literal fills."""
    return df.select(*[F.coalesce(F.col(c), F.lit(float(fills[c]))).alias(c) if c in fills else F.col(c) for c in df.columns])


def imputation_report(plan: DataFrame, col: str = "col") -> DataFrame:
    """M4: ``(Column_Name, Impute_Strategy)`` for the imputed (not dropped) columns."""
    return plan.where(F.col("strategy") != "drop").select(F.col(col).alias("Column_Name"), F.col("strategy").alias("Impute_Strategy"))
