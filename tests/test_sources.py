"""Contract (S1), fit tables (S7), drop replay (P4), watermark dedup."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from sparkqc.operators import features
from sparkqc.sources import fits
from sparkqc.sources.contract import contract_schema, sensor_contract


def test_contract_from_json(tmpdir_path):
    path = os.path.join(tmpdir_path, "schema_training.json")
    with open(path, "w") as fh:
        json.dump(sensor_contract(590), fh)
    c = contract_schema(path)
    assert len(c.columns) == 592 and c.n_columns == 592
    assert isinstance(c.schema["Wafer"].dataType, StringType) and c.varchar_len == {"Wafer": 255}
    assert isinstance(c.schema["Sensor590"].dataType, DoubleType)
    assert isinstance(c.schema["Output"].dataType, IntegerType)
    assert (c.naming.prefix, c.naming.date_len, c.naming.time_len) == ("wafer", 8, 6)


def test_fit_table_roundtrip(spark, tmpdir_path):
    cap = spark.createDataFrame([("s1", -1.0, 2.0), ("s2", 0.5, 0.75)], "col string, lower double, upper double")
    tr = spark.createDataFrame([("s1", "logarithmic", None), ("s3", "yeo-johnson", 0.25)], "col string, type string, lam double")
    path = os.path.join(tmpdir_path, "fits")
    earlier = spark.createDataFrame([("s1", -9.0, 9.0)], "col string, lower double, upper double")
    fits.save_fit(fits.to_fit_rows(earlier, "cap_iqr", "col", ["lower", "upper"]), path)  # a run that is replaced
    fits.save_fit(fits.to_fit_rows(cap, "cap_iqr", "col", ["lower", "upper"]).unionByName(fits.to_fit_rows(tr, "transform", "col", ["lam"], ["type"])), path)
    back = fits.fit_dict(fits.load_fit(spark, path, "cap_iqr", ["lower", "upper"]), "col", ["lower", "upper"])
    assert back == {"s1": (-1.0, 2.0), "s2": (0.5, 0.75)}
    t = fits.fit_dict(fits.load_fit(spark, path, "transform", ["lam"], ["type"]), "col", ["type", "lam"])
    assert t == {"s1": ("logarithmic", None), "s3": ("yeo-johnson", 0.25)}


def test_json_through_spark(spark, tmpdir_path):
    value = {"a": [1, 2.5, None], "é": {"x": "line\nbreak"}}
    for _ in range(2):
        fits.save_json(spark, value, os.path.join(tmpdir_path, "doc"))
    assert fits.load_json(spark, os.path.join(tmpdir_path, "doc")) == value


def test_drop_log_and_replay(spark):
    df = spark.createDataFrame([(1, "w", 1.0, 2.0, 3.0)], "k long, Wafer string, a double, b double, c double")
    out, log = features.drop_columns(df, ["Wafer"], "Irrelevant column")
    log = log.unionByName(spark.createDataFrame([("b", "More than 80% missing values"), ("c", "Constant variance")],
                                                "Columns_Removed string, Reason string"))
    assert out.columns == ["k", "a", "b", "c"]
    assert features.replay_drops(df, log).columns == ["k", "a", "c"]  # constant columns are dropped later by the fit


def test_dedup_stream_within_watermark(spark, tmpdir_path):
    from sparkqc.streaming.stream import dedup_stream

    src = os.path.join(tmpdir_path, "ev")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.unionByName(ev.where(F.col("event_id") % 10 == 0)).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    out = os.path.join(tmpdir_path, "out")
    q = (dedup_stream(stream, ["event_id"], "ts", "3650 days").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == ev.count() and got.select("event_id").distinct().count() == ev.count()
