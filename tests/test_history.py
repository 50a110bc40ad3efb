"""The growing set of delivered rows: replays, later columns, equality of rows."""

import numpy as np
import pytest

from sparkqc.sources import history

TWO = "id string, v double"


def test_replays_later_columns_and_equal_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    first = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None), ("c", float("nan")), ("d", 0.0), (None, None)], TWO)
    history.append_new(spark, first, path)
    history.append_new(spark, first, path)
    assert history.read_history(spark, path).count() == 5
    again = spark.createDataFrame([("d", -0.0, None, 3), ("a", 1.0, "x", 3), ("c", float("nan"), None, 4)], TWO + ", w string, _epoch int")
    history.append_new(spark, again, path)
    history.append_new(spark, first, path)  # narrow again: the later column stays NULL
    got = history.read_history(spark, path)
    assert got.columns == ["id", "v", "w"]
    rows = sorted(map(str, ((r.id, r.v, r.w) for r in got.collect())))
    assert rows == sorted(map(str, [("a", 1.0, None), ("a", 1.0, "x"), ("b", None, None), ("c", float("nan"), None), ("d", 0.0, None), (None, None, None)]))
    assert [len(s.fields) for _, _, s in history.schema_log(spark, path)] == [2, 3]


def test_values_do_not_change_columns(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    history.append_new(spark, spark.createDataFrame([("x", None), (None, "x"), ('","b":"', None)], "a string, b string"), path, digits=1)
    assert history.read_history(spark, path).count() == 3


def test_other_types_and_nested_columns_write_nothing(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    history.append_new(spark, spark.createDataFrame([("a", 1.0)], TWO), path)
    for rows, schema in (([("a", "1")], "id string, v string"), ([("a", [1])], "id string, n array<int>")):
        with pytest.raises(ValueError):
            history.append_new(spark, spark.createDataFrame(rows, schema), path)
    assert history.read_history(spark, path).count() == 1 and len(history.schema_log(spark, path)) == 1


def test_empty_delivery_and_missing_table(spark, tmpdir_path):
    with pytest.raises(ValueError):
        history.read_history(spark, f"{tmpdir_path}/none")
    history.append_new(spark, spark.createDataFrame([], TWO), f"{tmpdir_path}/t")
    assert history.read_history(spark, f"{tmpdir_path}/t").count() == 0


def test_prepare_and_stream_keep_distinct_rows(spark, tmpdir_path):
    import os

    import test_end_to_end as e2e
    from sparkqc.plans import pipeline
    from sparkqc.streaming.stream import ingest_stream

    src, table, streamed = (os.path.join(tmpdir_path, x) for x in ("src", "table", "streamed"))
    e2e.write_batches(src, np.random.default_rng(1), n_files=2, rows=20)
    for _ in range(2):
        counts = pipeline.prepare(spark, src, e2e.CONTRACT, table, os.path.join(tmpdir_path, "q"), incremental=True)
        assert counts == {"files": 3, "bad_files": 1, "rejected_rows": 0}
    assert history.read_history(spark, table).count() == 40
    for run in range(2):  # a second checkpoint folder replays every file
        ingest_stream(spark, src, e2e.CONTRACT, streamed, os.path.join(tmpdir_path, "q2"), os.path.join(tmpdir_path, f"c{run}"), incremental=True).awaitTermination(120)
    assert history.read_history(spark, streamed).exceptAll(history.read_history(spark, table)).count() == 0
    assert history.read_history(spark, streamed).count() == 40


def test_only_touched_buckets_are_read(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    history.append_new(spark, spark.range(500).selectExpr("cast(id as string) id", "cast(id as double) v"), path)
    stored = history._stored(spark, path, history.schema_log(spark, path)[-1][2])
    plan = stored.where("_bucket IN ('0a')").select("_bucket", "_row")._jdf.queryExecution().executedPlan().toString()
    assert "= 0a)" in plan.split("PartitionFilters")[1] and "ReadSchema: struct<_row:string>" in plan
