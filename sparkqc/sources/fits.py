"""Fit tables (S7): fitted statistics persisted as one long parquet table.

Layout ``(stage string, col string, stat string, value double, text string)``:
imputer fills, capper bounds, transform types and lambdas, scaler centres and
scales, selected features, model paths. Loading a stage gives back a small
DataFrame (one row per column) that is joined or turned into literals at
apply time. Spark ML models use their own ``MLWritable`` format.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIT_SCHEMA = "stage string, col string, stat string, value double, text string"


def to_fit_rows(df: DataFrame, stage: str, col: str, stats: list[str], texts: list[str] = ()) -> DataFrame:
    """Wide per-column fit (col, stat1, stat2, ...) -> long fit rows for one stage."""
    parts = [df.select(F.lit(stage).alias("stage"), F.col(col).cast("string").alias("col"), F.lit(s).alias("stat"),
                       F.col(s).cast("double").alias("value"), F.lit(None).cast("string").alias("text")) for s in stats]
    parts += [df.select(F.lit(stage).alias("stage"), F.col(col).cast("string").alias("col"), F.lit(t).alias("stat"),
                        F.lit(None).cast("double").alias("value"), F.col(t).cast("string").alias("text")) for t in texts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save_fit(fit_rows: DataFrame, path: str) -> None:
    """All stages of one run; an earlier run's rows are replaced."""
    fit_rows.write.mode("overwrite").parquet(path)


def save_json(spark: SparkSession, value, path: str) -> None:
    """One JSON document through Spark, so that any store Spark can write will do."""
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything stands at ``path``, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).where("value <> ''").first()[0])


def load_fit(spark: SparkSession, path: str, stage: str, stats: list[str], texts: list[str] = ()) -> DataFrame:
    """One stage back to ``(col, stat1, ..., text1, ...)``."""
    t = spark.read.schema(FIT_SCHEMA).parquet(path).where(F.col("stage") == stage)
    aggs = [F.max(F.when(F.col("stat") == s, F.col("value"))).alias(s) for s in stats]
    aggs += [F.max(F.when(F.col("stat") == s, F.col("text"))).alias(s) for s in texts]
    return t.groupBy("col").agg(*aggs)


def fit_dict(fit: DataFrame, col: str, fields: list[str]) -> dict:
    """Small fit table (one row per column, schema-bounded) -> {col: tuple(fields)}."""
    return {r[col]: tuple(r[f] for f in fields) for r in fit.collect()}
