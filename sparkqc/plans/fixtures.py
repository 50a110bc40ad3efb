"""Deterministic views over the driver tables (FIXTURES.md part B).

Each view exists twice: as a Spark DataFrame builder and as DuckDB SQL text
used by the oracle queries. Both derive every row from the given tables, so
work grows with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.session import ensure_checkpoint_dir

N_DIMS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------- Spark side

def long_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, y, pos, v)``: 64 sensors per item, label y = (label == 0)."""
    emb = table(spark, sf_dir, "embeddings")
    return (emb.select("vec_id", (F.col("label") == 0).cast("int").alias("y"),
                       F.posexplode("embedding").alias("p", "e"))
            .select("vec_id", "y", (F.col("p") + 1).cast("bigint").alias("pos"), F.col("e").cast("double").alias("v")))


def wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, y, e1..e64)``: the same matrix as one row per item (no shuffle)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", (F.col("label") == 0).cast("int").alias("y"),
                      *[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(N_DIMS)])


def holes_expr(vec_id, pos, v):
    """``v`` with the holes of its column ``pos``; of a number only the branch of that column is built."""
    d = lambda x: F.lit(float(x))
    if isinstance(pos, int):
        null = F.lit(None).cast("double")
        match pos:
            case 1 | 2:
                return F.when(vec_id % 9 == 0, null).otherwise(v)
            case 3:
                return F.when(vec_id % 10 < 9, null).otherwise(v)
            case 4:
                return d(1)
            case 5:
                return F.when(vec_id % 11 == 3, null).otherwise(v)
            case 6:
                return F.when(vec_id % 13 == 5, null).otherwise(F.exp(d(8) * v))
            case 7:
                return F.exp(d(8) * v)
            case 8:
                return (v + d(0.6)) * (v + d(0.6))
            case 9:
                return d(1) / (v + d(0.6))
            case _:
                return v
    return (F.when(pos.isin(1, 2) & (vec_id % 9 == 0), F.lit(None).cast("double"))
            .when((pos == 3) & (vec_id % 10 < 9), F.lit(None).cast("double"))
            .when(pos == 4, d(1))
            .when((pos == 5) & (vec_id % 11 == 3), F.lit(None).cast("double"))
            .when((pos == 6) & (vec_id % 13 == 5), F.lit(None).cast("double"))
            .when(pos.isin(6, 7), F.exp(d(8) * v))
            .when(pos == 8, (v + d(0.6)) * (v + d(0.6)))
            .when(pos == 9, d(1) / (v + d(0.6)))
            .otherwise(v))


def holes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``long`` with NULLs, a constant column and skewed columns (every plan branch)."""
    lg = long_view(spark, sf_dir)
    return lg.select("vec_id", "y", "pos", holes_expr(F.col("vec_id"), F.col("pos"), F.col("v")).alias("v"))


def holes_wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``holes`` as one row per item (projection only)."""
    emb = table(spark, sf_dir, "embeddings")
    cols = []
    for i in range(N_DIMS):
        v = F.col("embedding")[i].cast("double")
        cols.append(holes_expr(F.col("vec_id"), i + 1, v).alias(f"e{i + 1}"))
    return emb.select("vec_id", (F.col("label") == 0).cast("int").alias("y"), *cols)


def sensor_holes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``holes`` with contract-like names (Sensor1, Sensor2, ... Sensor10), where the order of columns is not that of the text:
    Sensor2 is dropped before Sensor10, whose gaps lie within its own; Sensor1 and Sensor12 share theirs."""
    h = holes_view(spark, sf_dir)
    k, p, null = F.col("vec_id"), F.col("pos"), F.lit(None).cast("double")
    v = (F.when((p == 12) & (k % 9 == 0), null).when((p == 2) & (k % 20 < 17), null).when((p == 10) & (k % 20 < 15), null).otherwise(F.col("v")))
    return h.select("vec_id", "y", F.concat(F.lit("Sensor"), p.cast("string")).alias("pos"), v.alias("v"))


SENSORS = [f"Sensor{i}" for i in range(1, N_DIMS + 1)]


def trials_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuning results derived from ``part`` (one trial per part key)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t0 = p.select(
        k.alias("trial_id"), F.col("p_type").alias("family"), F.col("p_size").alias("num_features"),
        F.when(k % 2 == 0, "yes").otherwise("no").alias("clustering"),
        (((k * 37) % 101) / F.lit(125.0) - F.lit(0.1)).alias("train_val_mcc"),
        (F.lit(0.4) + ((k * 29) % 50) / F.lit(125.0)).alias("train_val_recall"),
        ((((k * 53) % 41) - 20) / F.lit(100.0)).alias("g1"),
        ((((k * 31) % 43) - 21) / F.lit(100.0)).alias("g2"),
        (((k * 71) % 89) / F.lit(125.0)).alias("val_mcc"),
        (((k * 67) % 53) / F.lit(500.0)).alias("r"),
    )
    return t0.select("*", (F.col("train_val_mcc") * (1 + F.col("g1"))).alias("test_mcc"),
                     (F.col("train_val_recall") * (1 + F.col("g2"))).alias("test_recall"),
                     (F.lit(0.8) - F.lit(0.4) * F.col("val_mcc") + F.col("r")).alias("val_recall"))


def preds_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier output at lineitem scale: ``(y, pred, fold, side)``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
                     F.when(F.col("l_discount") >= F.lit(0.06), 1).otherwise(0).alias("pred"),
                     (F.col("l_orderkey") % 5).cast("int").alias("fold"),
                     (F.col("l_linenumber") % 2).cast("int").alias("side"))


def events_dup_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events plus the 'error' events delivered a second time (exact row copies)."""
    ev = table(spark, sf_dir, "events")
    return ev.unionByName(ev.where(F.col("event_type") == "error"))


def names_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered file names derived from ``pages`` (five naming classes)."""
    pg = table(spark, sf_dir, "pages")
    k = F.col("page_id") % 5
    nm = (F.when(k == 0, "wafer_01012020_120000.csv").when(k == 1, "wafer_0101202_120000.csv")
          .when(k == 2, "lot_01012020_120000.csv").when(k == 3, "wafer_01012020.csv")
          .otherwise("wafer_abcdefgh_ijklmn.csv.bak"))
    return pg.select("page_id", nm.alias("nm"))


# Delivery files by event type, and one that holds its header only.
DELIVERIES = {"view": "wafer_01012020_120000.csv", "click": "wafer_0101202_120000.csv", "signup": "wafer_02012020_120000.csv",
              "purchase": "wafer_03012020_120000.csv", "error": "wafer_04012020_120000.csv", "": "wafer_05012020_120000.csv"}


def deliveries(spark: SparkSession, sf_dir: str) -> str:
    """CSV delivery files of all events below the shared checkpoint folder: a bad name (click), a missing column (signup),
    a column without values (purchase), no rows, and in the others short rows, over-long ids, infinite and unparsable cells."""
    k, kind = F.col("event_id"), F.col("event_type")
    wafer = F.concat(F.lit("W"), k.cast("string"), F.when(k % 23 == 0, F.repeat(F.lit("x"), 300)).otherwise(""))
    first = F.when(k % 17 == 0, "Infinity").when(k % 29 == 0, "abc").when(k % 13 == 0, "NaN").otherwise(F.col("value").cast("string"))
    second = F.when(kind == "purchase", F.when(k % 2 == 0, "NA").otherwise("")).otherwise(F.col("user_id").cast("string"))
    third = F.when(k % 7 == 0, " ").otherwise("2.5")
    out = (k % 2).cast("string")
    line = (F.when(kind == "signup", F.concat_ws(",", wafer, first, second, out)).when(k % 19 == 0, F.concat_ws(",", wafer, first))
            .otherwise(F.concat_ws(",", wafer, first, second, third, out)))
    rows = table(spark, sf_dir, "events").select(kind.alias("kind"), k.alias("ord"), line.alias("value"))
    head = spark.createDataFrame([(t, -1, "Wafer,Sensor1,Sensor2,Output" if t == "signup" else "Wafer,Sensor1,Sensor2,Sensor3,Output") for t in DELIVERIES], "kind string, ord long, value string")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/deliveries-{uuid.uuid4().hex}"
    written = rows.unionByName(head).withColumn("file", F.when(F.col("kind") == "", "empty").otherwise(F.col("kind")))
    written.repartition("file").sortWithinPartitions("file", "ord").select("file", "value").write.partitionBy("file").text(f"{folder}/by-type")
    # the writer names its files itself: give the six their delivery names
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(f"{folder}/in"))
    for t, name in DELIVERIES.items():
        part = next(p.getPath() for p in fs.listStatus(fs_path(f"{folder}/by-type/file={t or 'empty'}")) if p.getPath().getName().startswith("part-"))
        fs.rename(part, fs_path(f"{folder}/in/{name}"))
    return f"{folder}/in"


# ---------------------------------------------------------------- DuckDB side

SQL_CELLS = "cells AS (SELECT event_id, CASE event_type " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in DELIVERIES.items() if t) + """ END AS file_name, event_type,
    'W' || event_id || CASE WHEN event_id % 23 = 0 THEN repeat('x', 300) ELSE '' END AS wafer,
    CASE WHEN event_id % 17 = 0 OR (event_id % 29 = 0) THEN 'bad' WHEN event_id % 13 = 0 THEN 'missing' ELSE 'value' END AS s1,
    value, user_id, CASE WHEN event_id % 7 <> 0 THEN 2.5e0 END AS s3, CAST(event_id % 2 AS INTEGER) AS out, event_id % 19 = 0 AS short FROM events),
judged AS (SELECT *, CASE WHEN short THEN 'wrong number of fields' WHEN length(wafer) > 255 THEN 'Wafer longer than 255' WHEN s1 = 'bad' THEN 'bad value in Sensor1' END AS reason
    FROM cells WHERE event_type IN ('view', 'error'))"""

SQL_LONG = """long AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS y,
    CAST(generate_subscripts(embedding, 1) AS BIGINT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""

SQL_HOLES = """holes AS (SELECT vec_id, y, pos, CASE
    WHEN pos IN (1, 2) AND vec_id % 9 = 0 THEN NULL
    WHEN pos = 3 AND vec_id % 10 < 9 THEN NULL
    WHEN pos = 4 THEN CAST(1 AS DOUBLE)
    WHEN pos = 5 AND vec_id % 11 = 3 THEN NULL
    WHEN pos = 6 AND vec_id % 13 = 5 THEN NULL
    WHEN pos IN (6, 7) THEN exp(8e0 * v)
    WHEN pos = 8 THEN (v + 0.6e0) * (v + 0.6e0)
    WHEN pos = 9 THEN 1e0 / (v + 0.6e0)
    ELSE v END AS v FROM long)"""

SQL_SENSOR_HOLES = SQL_HOLES.replace("holes AS", "holes0 AS", 1) + """,
holes AS (SELECT vec_id, y, pos, CASE WHEN pos = 12 AND vec_id % 9 = 0 THEN NULL WHEN pos = 2 AND vec_id % 20 < 17 THEN NULL
    WHEN pos = 10 AND vec_id % 20 < 15 THEN NULL ELSE v END AS v FROM holes0)"""

SQL_TRIALS = """t0 AS (SELECT p_partkey AS trial_id, p_type AS family, p_size AS num_features,
    CASE WHEN p_partkey % 2 = 0 THEN 'yes' ELSE 'no' END AS clustering,
    ((p_partkey * 37) % 101) / 125e0 - 0.1e0 AS train_val_mcc, 0.4e0 + ((p_partkey * 29) % 50) / 125e0 AS train_val_recall,
    (((p_partkey * 53) % 41) - 20) / 100e0 AS g1, (((p_partkey * 31) % 43) - 21) / 100e0 AS g2,
    ((p_partkey * 71) % 89) / 125e0 AS val_mcc, ((p_partkey * 67) % 53) / 500e0 AS r FROM part),
trials AS (SELECT *, train_val_mcc * (1 + g1) AS test_mcc, train_val_recall * (1 + g2) AS test_recall,
    0.8e0 - 0.4e0 * val_mcc + r AS val_recall FROM t0)"""

SQL_PREDS = """preds AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
    CASE WHEN l_discount >= 0.06e0 THEN 1 ELSE 0 END AS pred,
    CAST(l_orderkey % 5 AS INTEGER) AS fold, CAST(l_linenumber % 2 AS INTEGER) AS side FROM lineitem)"""

SQL_EVENTS_DUP = """events_dup AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error')"""

SQL_NAMES = """names AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'wafer_01012020_120000.csv'
    WHEN 1 THEN 'wafer_0101202_120000.csv' WHEN 2 THEN 'lot_01012020_120000.csv'
    WHEN 3 THEN 'wafer_01012020.csv' ELSE 'wafer_abcdefgh_ijklmn.csv.bak' END AS nm FROM pages)"""


def with_views(*views: str) -> str:
    """``WITH`` prefix for an oracle query using the named fixture views."""
    parts = {"long": [SQL_LONG], "holes": [SQL_LONG, SQL_HOLES], "sensor_holes": [SQL_LONG, SQL_SENSOR_HOLES],
             "trials": [SQL_TRIALS], "preds": [SQL_PREDS],
             "events_dup": [SQL_EVENTS_DUP], "cells": [SQL_CELLS], "names": [SQL_NAMES]}
    out: list[str] = []
    for v in views:
        for p in parts.get(v, [v]):  # unknown names are extra CTE text
            if p not in out:
                out.append(p)
    return "WITH " + ",\n".join(out) + "\n" if out else ""
