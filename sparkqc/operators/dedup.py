"""Deduplication and set operations.

Copies of one row may be a third of the table, so survivors are chosen with
an aggregate (partial, map-side) rather than a window over the copy group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, order_key: str | None = None) -> DataFrame:
    """One row per distinct ``subset`` (all columns by default); NULLs compare equal.

    With a subset, the survivor is the row with the smallest ``order_key``
    (deterministic 'keep first').
    """
    if not subset or set(subset) == set(df.columns):
        return df.distinct()
    subset = list(subset)
    rest = [c for c in df.columns if c not in subset]
    if order_key is None:
        order_key = rest[0]
    others = [order_key] + [c for c in rest if c != order_key]
    pick = F.min(F.struct(*[F.col(c) for c in others])).alias("_keep")
    out = df.groupBy(*subset).agg(pick)
    return out.select(*subset, *[F.col("_keep")[c].alias(c) for c in others]).select(*df.columns)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """The 2nd and later copies of fully-equal rows, with their copy number."""
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return counted.select(*cols, F.explode(F.sequence(F.lit(2).cast("long"), F.col("_n"))).alias("copy_no"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """D3: SELECT DISTINCT (hash aggregate with map-side combine)."""
    return df.distinct()


def union_rows(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (missing columns become NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
