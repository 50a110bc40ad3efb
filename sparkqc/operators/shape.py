"""Wide <-> long reshaping.

Per-column statistics over hundreds of columns are one ``groupBy(col)`` on the
long shape (partial aggregation on the map side, one shuffle of tiny partial
buffers), instead of a wide ``agg`` with thousands of aggregate expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str] | None = None,
            col: str = "col", value: str = "v") -> DataFrame:
    """Unpivot ``features`` into ``(ids..., col, v)``; values cast to double."""
    ids = list(ids)
    features = list(features) if features is not None else [c for c in df.columns if c not in ids]
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in features])
    return casted.unpivot(ids, features, col, value)


def to_wide(long: DataFrame, ids: Sequence[str], columns: Sequence, col: str = "col", value: str = "v") -> DataFrame:
    """Pivot long back to wide; ``columns`` must be given (no extra distinct job)."""
    names = list(columns)
    return long.groupBy(*ids).pivot(col, names).agg(F.first(value, ignorenulls=True))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]
