"""Skew-safe running counts inside groups.

Several operators need the rank of a value inside a group: exact quantiles,
the Anderson-Darling statistic, stratified split quotas, ntile folds, the
running maximum of the Pareto front. ``Window.partitionBy(group)`` sends a whole
group to one task, which breaks when one column (or one class) holds a third of
all rows. So rows are range-partitioned on (group, order), which spreads a huge
group over many tasks, checkpointed once so that partition ids are fixed,
summed inside each (partition, group) slice, and shifted by the slice's offset
from a table of per-slice totals (at most #partitions + #groups rows).

There is one strategy at every size. Callers collapse ties first
(``groupBy(group, value).count()``), so a heavy single value is one row with a
large weight, and pass only key, group and order columns, never wide rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqc.session import cut_lineage


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    """``df`` dealt by (group, order) with the partition as column ``_pid``: data, hence stable under retries."""
    cols = [*[F.col(b) for b in by], *[F.col(o) if isinstance(o, str) else o for o in order]]
    return cut_lineage(df.repartitionByRange(*cols).withColumn("_pid", F.spark_partition_id()))


def cumulative_sums(df: DataFrame, by: Sequence[str], order: Sequence, weight: str | None = None,
                    out_before: str = "cum_before", out_total: str = "group_total") -> DataFrame:
    """Add ``cum_before`` (sum of ``weight`` over rows strictly earlier in the group
    order) and ``group_total`` (sum over the group).

    Rows must be unique on ``by + order`` (the order must be total inside a group).
    ``order`` items may be column names or Columns (e.g. ``F.desc("x")``).
    """
    by = list(by)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = _ranged(df.withColumn("_w", F.col(weight).cast("long") if weight else F.lit(1).cast("long")), by, order)
    slices = ranged.groupBy("_pid", *by).agg(F.sum("_w").alias("_slice"))
    over_group = Window.partitionBy(*by)
    offsets = (slices
               .withColumn("_off", F.coalesce(F.sum("_slice").over(over_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn(out_total, F.sum("_slice").over(over_group))
               .select("_pid", *[F.col(b).alias(f"_by_{b}") for b in by], "_off", out_total))
    local = Window.partitionBy("_pid", *by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    here = ranged.withColumn("_local", F.coalesce(F.sum("_w").over(local), F.lit(0)))
    return (_join_slices(here, offsets, by)
            .withColumn(out_before, F.col("_off") + F.col("_local"))
            .drop("_off", "_local", "_w"))


def _join_slices(rows: DataFrame, offsets: DataFrame, by: Sequence[str]) -> DataFrame:
    """NULL groups are groups too."""
    on = rows["_pid"] == offsets["_pid"]
    for b in by:
        on = on & rows[b].eqNullSafe(offsets[f"_by_{b}"])
    return rows.join(offsets, on).drop(rows["_pid"]).drop(offsets["_pid"]).drop(*[f"_by_{b}" for b in by])


def running_max_before(df: DataFrame, by: Sequence[str], order: Sequence, value: str, out: str = "max_before") -> DataFrame:
    """Max of ``value`` over rows strictly earlier in the group order (NULL for the first).

    Dealt like ``cumulative_sums``; rows unique on ``by + order``.
    """
    by = list(by)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = _ranged(df, by, order)
    slices = ranged.groupBy("_pid", *by).agg(F.max(value).alias("_smax"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_pid", *[F.col(b).alias(f"_by_{b}") for b in by], F.max("_smax").over(earlier).alias("_off"))
    local = Window.partitionBy("_pid", *by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (_join_slices(ranged.withColumn("_local", F.max(value).over(local)), offsets, by)
            .withColumn(out, F.greatest(F.col("_off"), F.col("_local")))
            .drop("_off", "_local"))
