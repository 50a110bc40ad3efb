"""E-1 / E-2 / E-3 on hand-made delivery files: prepare, train, predict with saved artefacts."""

import os

import numpy as np

from sparkqc.plans import pipeline
from sparkqc.sources.contract import contract_from_dict, sensor_contract

N_SENSORS = 6
CONTRACT = contract_from_dict(sensor_contract(N_SENSORS))
PRED_CONTRACT = contract_from_dict(sensor_contract(N_SENSORS, with_label=False))


def write_batches(d, rng, n_files=3, rows=60, label=True, start=0):
    os.makedirs(d, exist_ok=True)
    hdr = ",".join(["Wafer", *[f"Sensor{i}" for i in range(1, N_SENSORS + 1)]] + (["Output"] if label else []))
    for f in range(n_files):
        lines = [hdr]
        for r in range(rows):
            y = 1 if rng.random() < 0.3 else -1
            x = rng.normal(size=N_SENSORS) + (1.5 if y == 1 else 0.0) * np.array([1, 1, 0, 0, 0, 0])
            x[5] = 7.0  # constant sensor
            cells = ["" if (i == 2 and rng.random() < 0.1) else f"{v:.5f}" for i, v in enumerate(x)]
            lines.append(",".join([f"W{start + f}-{r}", *cells] + ([str(y)] if label else [])))
        with open(os.path.join(d, f"wafer_0{f + 1}012020_12000{f}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    with open(os.path.join(d, "wafer_bad_name.csv"), "w") as fh:
        fh.write(hdr + "\n")


def test_prepare_train_predict(spark, tmpdir_path):
    rng = np.random.default_rng(7)
    src, table, q, out = (os.path.join(tmpdir_path, x) for x in ("src", "table", "q", "model"))
    write_batches(src, rng)
    counts = pipeline.prepare(spark, src, CONTRACT, table, q)
    assert counts["bad_files"] == 1 and counts["files"] == 4
    res = pipeline.train(spark, table, out, CONTRACT, ks=(3,), families=("LogisticRegression",), clustering=("no",),
                         n_trials=1, threshold=10.0, max_iter=10)
    assert res["family"] == "LogisticRegression" and len(res["features"]) == 3
    reports = set(os.listdir(os.path.join(out, "reports")))
    assert {"Missing_Values_Info", "Columns_Drop_from_Original", "Outliers_Info_Gaussian", "Best_Model_Results"} <= reports
    assert {"Classification_Report", "Confusion_Matrix", "Learning_Curve", "Duplicated_Rows", "Rows_with_Missing_Values", "Train_Set", "Test_Set"} <= reports
    assert spark.read.parquet(os.path.join(out, "reports", "Confusion_Matrix")).agg({"n": "sum"}).first()[0] == 180
    stages = {r.stage for r in spark.read.parquet(os.path.join(out, "fit_table")).select("stage").distinct().collect()}
    assert {"simple_fill", "fallback_fill", "cap_iqr", "scaler", "constant"} <= stages or {"simple_fill", "fallback_fill", "cap_gaussian", "scaler", "constant"} <= stages
    drops = {r.Columns_Removed: r.Reason for r in spark.read.parquet(os.path.join(out, "reports", "Columns_Drop_from_Original")).collect()}
    assert drops["Wafer"] == "Irrelevant column" and drops["Sensor6"] == "Constant variance"
    new = os.path.join(tmpdir_path, "new")
    write_batches(new, rng, n_files=1, rows=25, label=False, start=10)
    pred = pipeline.predict(spark, new, PRED_CONTRACT, out, os.path.join(tmpdir_path, "pred"))
    rows = pred.collect()
    assert len(rows) == 25 and {r.Wafer for r in rows} == {f"W10-{i}" for i in range(25)} and {r.Pred_Output for r in rows} <= {0, 1}
    assert spark.read.parquet(os.path.join(tmpdir_path, "pred")).count() == 25
