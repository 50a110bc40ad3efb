"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sparkqc.session import ensure_checkpoint_dir

U64 = np.uint64
_T = TypeVar("_T")
_KEPT: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting: an execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. Shuffle files of the write are not needed after it and go.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["staged_at"] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more: what came from them is staged itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.__dict__["staged_at"])
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def kept(key: str, make: Callable[[], _T]) -> _T:
    """What this Python worker keeps from task to task: one table at a time, whichever operator made it."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Workers outlive stages: an operator that keeps nothing itself drops what those before it kept."""
    _KEPT.clear()


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str | None]:
    return column.to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one flat array and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
