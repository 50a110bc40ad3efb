"""Exact, reproducible stratified split and folds.

Rows are ordered inside their class by ``md5(key || seed)`` (then key), ranked
with the skew-safe ``cumulative_sums`` (one class may hold most rows), and
compared to per-class quotas computed from the class counts (k rows). Only key and
label are ranked; the rank is joined back to the rows by key (unique).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkqc.operators.ranking import cumulative_sums


def split_quotas(counts: dict, test_size: float = 0.2) -> dict:
    """Per-class test quota: n_test = ceil(test_size * n); train quotas by largest remainder
    (ties to the smaller class value); test quota = class count - train quota."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    n_train = n - n_test
    last = {c: (c is None, 0 if c is None else c) for c in counts}
    classes = sorted(counts, key=last.get)
    cont = {c: counts[c] * n_train / n for c in classes}
    floor = {c: int(math.floor(cont[c])) for c in classes}
    need = n_train - sum(floor.values())
    for c in sorted(classes, key=lambda c: (-(cont[c] - floor[c]), last[c]))[:need]:
        floor[c] += 1
    return {c: counts[c] - floor[c] for c in classes}


def _hash_rank(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    ranked = cumulative_sums(df.select(label, key).withColumn("_h", h), [label], ["_h", key], out_before="_before", out_total="_n_c")
    return df.join(ranked.select(key, (F.col("_before") + 1).alias("_rn"), "_n_c"), key)


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` in {'train', 'test'} with exact per-class quotas.

    Rows without a label are a class of their own, the last one. Keys are unique and not NULL.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    quotas = split_quotas(counts, test_size)
    q = df.sparkSession.createDataFrame([(k, int(v)) for k, v in quotas.items()], StructType([StructField("_class", df.schema[label].dataType), StructField("_quota", LongType())]))
    ranked = _hash_rank(df, label, key, seed).join(F.broadcast(q), F.col(label).eqNullSafe(F.col("_class")))
    return ranked.withColumn("split", F.when(F.col("_rn") <= F.col("_quota"), "test").otherwise("train")).drop("_rn", "_n_c", "_quota", "_class")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 1..k, the ntile of the hash order inside each class."""
    r = _hash_rank(df, label, key, seed)
    n, rn = F.col("_n_c"), F.col("_rn")
    q = (n / k).cast("long")
    rem = n % k
    big = rem * (q + 1)
    fold = F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(rem + F.floor((rn - big - 1) / q) + 1)
    return r.withColumn("fold", fold.cast("int")).drop("_rn", "_n_c")
