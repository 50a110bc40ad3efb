"""Hand-made delivery files (FIXTURES part C): file verdicts, row quarantine, append + distinct, stream."""

import os

from pyspark.sql import functions as F

from sparkqc.sources import ingest
from sparkqc.sources.contract import contract_from_dict, sensor_contract

CONTRACT = contract_from_dict(sensor_contract(n_sensors=3))


def write(d, name, lines):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def make_batch(d):
    hdr = "Wafer,Sensor1,Sensor2,Sensor3,Output"
    write(d, "wafer_01012020_120000.csv", [hdr, "w1,1.0,2.0,3.0,1", "w2,1.5,,3.5,-1", "w3,abc,2.0,3.0,1",
                                          "w4,1.0,2.0", "x" * 300 + ",1,2,3,1", "w6,NA,2.0,3.0,-1"])
    write(d, "wafer_0101202_120000.csv", [hdr, "w7,1,2,3,1"])                  # bad name
    write(d, "wafer_02012020_120000.csv", ["Wafer,Sensor1,Sensor2,Output", "w8,1,2,1"])  # missing column
    write(d, "wafer_03012020_120000.csv", [hdr, "w9,1,,3,1", "w10,2,,4,-1"])  # all-null column
    write(d, "wafer_04012020_120000.csv", ["A,B,C,D,E", "w11,1,2,3,1"])        # wrong header names, right count


def test_verdicts_and_quarantine(spark, tmpdir_path):
    make_batch(tmpdir_path)
    out = ingest.validate_batches(spark, tmpdir_path, CONTRACT)
    v = {r.file_name: r.reason for r in out["verdicts"].collect()}
    assert v["wafer_0101202_120000.csv"] == ingest.REASON_NAME
    assert v["wafer_02012020_120000.csv"] == ingest.REASON_COLUMNS
    assert v["wafer_03012020_120000.csv"] == ingest.REASON_ALL_NULL
    assert v["wafer_01012020_120000.csv"] is None and v["wafer_04012020_120000.csv"] is None
    good = {r.Wafer: r for r in out["good"].collect()}
    assert set(good) == {"w1", "w2", "w6", "w11"}           # positional binding keeps w11
    assert good["w2"].Sensor2 is None and good["w6"].Sensor1 is None
    assert good["w11"].Sensor3 == 3.0 and good["w11"].Output == 1
    rej = {r.Wafer[:3]: r._bad_reason for r in out["rejected_rows"].collect()}
    assert rej["w3"].startswith("bad value") and rej["w4"] == "wrong number of fields" and "longer" in rej["xxx"]
    # good files and bad files partition the input
    assert out["bad_files"].count() + out["verdicts"].where("ok").count() == 5


def make_odd_batch(d):
    hdr = "Wafer,Sensor1,Sensor2,Sensor3,Output"
    write(d, "wafer_01012020_120000.csv", [hdr, "a1,NAN,1,1,1", "a2,Infinity,1,1,1", "a3,-inf,1,1,1", "a4,1,1,1,1", "a5,1,1,1,1.0e400"])
    write(d, "wafer_02012020_120000.csv", [hdr])                                     # header only
    write(d, "wafer_03012020_120000.csv", [hdr, "c1,1,x,1,1", "c2,1,y,1,1"])          # a column of unparsable text
    write(d, "wafer_04012020_120000.csv", [hdr, "d1,1,NA,1,1", "d2,1,,1,1"])          # a column without values


ODD_REASONS = {"wafer_01012020_120000.csv": None, "wafer_02012020_120000.csv": ingest.REASON_ALL_NULL, "wafer_03012020_120000.csv": None,
               "wafer_04012020_120000.csv": ingest.REASON_ALL_NULL}


def test_non_finite_cells_empty_files_and_unparsable_columns(spark, tmpdir_path):
    make_odd_batch(tmpdir_path)
    out = ingest.validate_batches(spark, tmpdir_path, CONTRACT)
    assert {r.file_name: r.reason for r in out["verdicts"].collect()} == ODD_REASONS
    assert [r.Wafer for r in out["good"].collect()] == ["a4"]
    assert {r.Wafer: r._bad_reason for r in out["rejected_rows"].collect()} == {
        "a1": "bad value in Sensor1", "a2": "bad value in Sensor1", "a3": "bad value in Sensor1", "a5": "bad value in Output", "c1": "bad value in Sensor2", "c2": "bad value in Sensor2"}


def test_stream_sees_files_without_rows(spark, tmpdir_path):
    from sparkqc.streaming.stream import ingest_stream

    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    make_odd_batch(src)
    ingest_stream(spark, src, CONTRACT, *(os.path.join(tmpdir_path, x) for x in ("table", "q", "ckpt"))).awaitTermination(120)
    bad = {r.file_name: r.reason for r in spark.read.parquet(os.path.join(tmpdir_path, "q", "files")).collect()}
    assert bad == {k: v for k, v in ODD_REASONS.items() if v}


def test_append_and_compile(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    make_batch(src)
    table = os.path.join(tmpdir_path, "table")
    for _ in range(2):  # same files delivered twice
        good = ingest.validate_batches(spark, src, CONTRACT)["good"]
        ingest.append_table(good, table)
    assert spark.read.parquet(table).count() == 8
    assert ingest.compile_table(spark, table).count() == 4


def test_stream_matches_batch(spark, tmpdir_path):
    from sparkqc.streaming.stream import ingest_stream

    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    make_batch(src)
    table = os.path.join(tmpdir_path, "table")
    q = ingest_stream(spark, src, CONTRACT, table, os.path.join(tmpdir_path, "q"), os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = sorted(r.Wafer for r in spark.read.parquet(table).collect())
    assert got == ["w1", "w11", "w2", "w6"]
    bad = {r.file_name: r.reason for r in spark.read.parquet(os.path.join(tmpdir_path, "q", "files")).collect()}
    assert len(bad) == 3
    # restart: nothing new is appended (checkpoint replaces moving the files)
    q = ingest_stream(spark, src, CONTRACT, table, os.path.join(tmpdir_path, "q"), os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 4


def test_stream_one_file_per_micro_batch(spark, tmpdir_path):
    """Several micro-batches (one file each) give the same table as one batch run."""
    from sparkqc.streaming.stream import ingest_stream

    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    make_batch(src)
    table = os.path.join(tmpdir_path, "table")
    q = ingest_stream(spark, src, CONTRACT, table, os.path.join(tmpdir_path, "q"), os.path.join(tmpdir_path, "ckpt"),
                      max_files_per_trigger=1)
    q.awaitTermination(180)
    got = spark.read.parquet(table)
    assert sorted(r.Wafer for r in got.collect()) == ["w1", "w11", "w2", "w6"]
    assert got.select("_epoch").distinct().count() >= 2  # really several micro-batches
    batch = sorted(r.Wafer for r in ingest.validate_batches(spark, src, CONTRACT)["good"].collect())
    assert batch == ["w1", "w11", "w2", "w6"]


def test_stream_redelivery_compiles_to_distinct_rows(spark, tmpdir_path):
    """A good file delivered again (new name) in a later micro-batch adds raw rows
    under another epoch, but no rows after compile."""
    import shutil

    from sparkqc.streaming.stream import ingest_stream

    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    make_batch(src)
    table, quarantine, ckpt = (os.path.join(tmpdir_path, n) for n in ("table", "q", "ckpt"))
    ingest_stream(spark, src, CONTRACT, table, quarantine, ckpt).awaitTermination(120)
    shutil.copy(os.path.join(src, "wafer_01012020_120000.csv"), os.path.join(src, "wafer_05012020_120000.csv"))
    ingest_stream(spark, src, CONTRACT, table, quarantine, ckpt).awaitTermination(120)
    raw = spark.read.parquet(table)
    assert raw.count() == 7 and raw.select("_epoch").distinct().count() == 2
    assert sorted(r.Wafer for r in ingest.compile_table(spark, table).collect()) == ["w1", "w11", "w2", "w6"]
