"""The three end-to-end actions (E-1 prepare, E-2 train, E-3 predict) over files.

``prepare`` validates delivery files against a contract and appends the good
rows to a table (bad files and rows go to a quarantine table). ``train``
compiles the table, fits the preprocessing chain and a model, writes the report
tables and persists every fitted artefact, all through Spark's writers: a long
fit table (S7) of every per-column stage, a JSON document for the rest, and Spark
ML models in their own format. ``predict`` validates a new delivery folder and
replays the chain with the saved artefacts.
"""

from __future__ import annotations

import os
from dataclasses import asdict, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.operators import evaluate, features, learn, split
from sparkqc.operators.iterative import IterativeImputerFit
from sparkqc.operators.joint_impute import JointImputerFit
from sparkqc.plans import score as sc
from sparkqc.plans.train import N_TRIALS, PreprocessFit, final_model, fit_preprocess, model_frame, search
from sparkqc.sources import fits, history, ingest
from sparkqc.session import cut_lineage
from sparkqc.sources.contract import Contract

ROW_KEY = "_row_key"

# Report table names and their column layouts.
REPORT_LAYOUT = {
    "missing_profile": ("Missing_Values_Info", {"col": "col", "n_missing": "Number_Missing_Values",
                                                "prop_missing": "Proportion_Missing_Values"}),
    "columns_dropped": ("Columns_Drop_from_Original", None),
    "imputation_methods": ("Imputation_Methods", None),
    "outliers_gaussian": ("Outliers_Info_Gaussian", {"col": "Variable", "n_outliers": "Number_Outliers",
                                                     "prop_outliers": "Prop_Outliers"}),
    "outliers_non_gaussian": ("Outliers_Info_Non_Gaussian", {"col": "Variable", "n_outliers": "Number_Outliers",
                                                             "prop_outliers": "Prop_Outliers"}),
    "best_transformation": ("Best_Transformation_Non_Gaussian", {"col": "Variable", "type": "Transformation_Type",
                                                                 "a2": "Test-stats"}),
    "duplicate_rows": ("Duplicated_Rows", None),
    "rows_with_missing": ("Rows_with_Missing_Values", None),
    "train_set": ("Train_Set", None),
    "test_set": ("Test_Set", None),
}


#: Stages of the fit table: their statistics in order, and which of them is text.
FIT_STAGES = {
    "simple_fill": (("fill",), None),
    "fallback_fill": (("fill",), None),
    "cap_iqr": (("lower", "upper"), None),
    "cap_gaussian": (("lower", "upper"), None),
    "transforms": (("type", "lam"), "type"),
    "scaler": (("centre", "scale"), None),
}


def with_row_key(df: DataFrame, cols: list[str]) -> DataFrame:
    """A deterministic row key from the full row content (dedup makes it unique)."""
    return df.withColumn(ROW_KEY, F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
                                                                for c in cols]), 256))


def prepare(spark: SparkSession, src_dir: str, contract: Contract, table_path: str, quarantine_path: str, incremental: bool = False) -> dict:
    """E-1: validate, quarantine, append. Returns counts, taken from the written verdicts and rejected rows.

    ``incremental`` keeps the table as a set of distinct rows (``sources.history``), so that ``train`` needs no DISTINCT over it.
    A table is kept one way or the other from its first delivery on.
    """
    parts = ingest.validate_batches(spark, src_dir, contract, write_verdicts=True)
    if incremental:
        history.append_new(spark, parts["good"], table_path)
    else:
        ingest.append_table(parts["good"], table_path)
    parts["bad_files"].write.mode("append").parquet(os.path.join(quarantine_path, "files"))
    rejected = cut_lineage(parts["rejected_rows"])
    rejected.write.mode("append").parquet(os.path.join(quarantine_path, "rows"))
    return {"files": parts["verdicts"].count(), "bad_files": parts["bad_files"].count(), "rejected_rows": rejected.count()}


def report_tables(prep: PreprocessFit) -> dict[str, DataFrame]:
    """Report DataFrames in the reference's report layouts."""
    spark = None
    out = {}
    for key, (name, cols) in REPORT_LAYOUT.items():
        df = prep.reports.get(key)
        if df is None:
            continue
        spark = df.sparkSession
        out[name] = df.select(*[F.col(a).alias(b) for a, b in cols.items()]) if cols else df
    if spark is not None:
        out["Gaussian_columns"] = spark.createDataFrame([(c,) for c in prep.normal], "Variable string")
        out["Non_gaussian_columns"] = spark.createDataFrame([(c,) for c in prep.non_normal], "Variable string")
    return out


def _prep_to_json(prep: PreprocessFit) -> dict:
    d = {f.name: getattr(prep, f.name) for f in fields(prep) if f.name not in ("reports", "iterative", "joint", *FIT_STAGES)}
    d["iterative"] = asdict(prep.iterative) if prep.iterative is not None else None
    if d["iterative"] is not None:
        d["iterative"]["rounds"] = [{t: [b0, [list(x) for x in terms]] for t, (b0, terms) in r.items()}
                                    for r in prep.iterative.rounds]
    d["joint"] = asdict(prep.joint) if prep.joint is not None else None
    return d


def _fit_rows(spark: SparkSession, prep: PreprocessFit, scaler: dict) -> DataFrame:
    """Every per-column stage as rows of the fit table (one row per column and statistic)."""
    rows = []
    for stage, (kinds, text) in FIT_STAGES.items():
        for c, v in (scaler if stage == "scaler" else getattr(prep, stage)).items():
            values = v if isinstance(v, (tuple, list)) else (v,)
            rows += [(stage, c, k, None, x) if k == text else (stage, c, k, None if x is None else float(x), None) for k, x in zip(kinds, values)]
    rows += [(stage, c, "dropped", None, None) for stage in ("dropped_missing", "constant") for c in getattr(prep, stage)]
    return spark.createDataFrame(rows, fits.FIT_SCHEMA)


def _load_stages(spark: SparkSession, path: str) -> dict[str, dict]:
    out = {}
    for stage, (kinds, text) in FIT_STAGES.items():
        stats = [k for k in kinds if k != text]
        table = fits.load_fit(spark, path, stage, stats, [text] if text else [])
        found = fits.fit_dict(table, "col", list(kinds))
        out[stage] = {c: v[0] for c, v in found.items()} if len(kinds) == 1 else found
    return out


def _prep_from_json(d: dict, stages: dict[str, dict]) -> PreprocessFit:
    it, joint = d.pop("iterative"), d.pop("joint", None)
    prep = PreprocessFit(**d, **{k: v for k, v in stages.items() if k != "scaler"})
    if it is not None:
        rounds = [{t: (b0, [tuple(x) for x in terms]) for t, (b0, terms) in r.items()} for r in it["rounds"]]
        prep.iterative = IterativeImputerFit(it["columns"], it["means"], rounds)
    if joint is not None:
        prep.joint = JointImputerFit(**joint)
    return prep


def train(spark: SparkSession, table_path: str, out_dir: str, contract: Contract, id_col: str = "Wafer",
          label: str = "Output", ks=None, families=None, clustering=("no", "yes"),
          n_trials: int = N_TRIALS, threshold: float = 0.10, max_iter: int = 100) -> dict:
    """E-2: compile -> preprocess fit -> search -> final fit; writes reports and artefacts."""
    compiled = os.path.join(out_dir, "compiled")
    kept = history.read_history(spark, table_path) if history.schema_log(spark, table_path) else ingest.compile_table(spark, table_path)
    kept.write.mode("overwrite").parquet(compiled)
    data = ingest.read_table(spark, compiled, contract.schema)
    feats = [c for c in contract.columns if c not in (id_col, label)]
    data = with_row_key(data.select(id_col, *feats, label), [id_col, *feats, label])
    prep, tr, te = fit_preprocess(data, ROW_KEY, label, id_cols=(id_col,))
    res = search(tr, te, ROW_KEY, label, prep.normal, prep.non_normal, ks=ks, families=families,
                 clustering=clustering, n_trials=n_trials, threshold=threshold, max_iter=max_iter)
    model, base, fam, params, km, n_cl = final_model(tr, te, ROW_KEY, label, res, max_iter)
    best = res.best.first()
    chosen = list(best["column_list"])
    for name, df in report_tables(prep).items():
        ingest.write_report(df, os.path.join(out_dir, "reports", name))
    res.trials.write.mode("overwrite").parquet(os.path.join(out_dir, "reports", "Model_Results"))
    res.best.write.mode("overwrite").parquet(os.path.join(out_dir, "reports", "Best_Model_Results"))
    fits.save_fit(_fit_rows(spark, prep, res.scaler), os.path.join(out_dir, "fit_table"))
    learn.save_model(model, os.path.join(out_dir, "model"))
    if km is not None:
        km.write().overwrite().save(os.path.join(out_dir, "kmeans"))
    meta = {"prep": _prep_to_json(prep), "selected": base, "family": fam, "params": params, "n_clusters": n_cl, "id_col": id_col, "label": label}
    fits.save_json(spark, meta, os.path.join(out_dir, "pipeline.json"))
    for name, df in final_reports(tr, te, label, res, base, fam, params, model, km, n_cl, max_iter).items():
        ingest.write_report(df, os.path.join(out_dir, "reports", name))
    return {"family": fam, "features": chosen, "test_mcc": best["test_matthews_corrcoef"],
            "test_recall": best["test_recall_score"]}


def final_reports(tr: DataFrame, te: DataFrame, label: str, res, base: list, fam: str, params: dict, model, km, n_cl: int, max_iter: int) -> dict[str, DataFrame]:
    """Classification report and confusion table of the final model over all rows, and the learning curve of its configuration."""
    every = tr.unionByName(te)
    frame, use = model_frame(every, res.scaler, base, fam, km, n_cl, keep=(ROW_KEY, label))
    told = learn.predict(model, learn.assemble(frame, use), "pred").withColumnRenamed(label, "y")
    folded = split.stratified_folds(frame.select(ROW_KEY, label, *use), label, ROW_KEY)
    return {"Classification_Report": evaluate.classification_report(told), "Confusion_Matrix": evaluate.confusion(told),
            "Learning_Curve": learn.learning_curve(cut_lineage(folded), use, label, fam, params, ROW_KEY, max_iter=max_iter)}


def load_scoring_model(model_dir: str) -> tuple[sc.ScoringModel, dict]:
    from pyspark.ml.clustering import KMeansModel

    spark = SparkSession.getActiveSession()
    meta = fits.load_json(spark, os.path.join(model_dir, "pipeline.json"))
    stages = _load_stages(spark, os.path.join(model_dir, "fit_table"))
    prep = _prep_from_json(meta["prep"], stages)
    model = learn.load_model(spark, meta["family"], os.path.join(model_dir, "model"))
    km = KMeansModel.load(os.path.join(model_dir, "kmeans")) if meta["n_clusters"] else None
    return sc.ScoringModel(prep, stages["scaler"], meta["selected"], meta["family"], model, km, meta["n_clusters"]), meta


def predict(spark: SparkSession, src_dir: str, contract: Contract, model_dir: str, out_path: str | None = None) -> DataFrame:
    """E-3: validate the new deliveries, replay the chain, score; optionally write."""
    sm, meta = load_scoring_model(model_dir)
    good = ingest.validate_batches(spark, src_dir, contract)["good"].drop("file_name")
    feats = [c for c in contract.columns if c != meta["id_col"]]
    keyed = with_row_key(features.reorder_columns(good, [meta["id_col"], *sm.prep.features]), [meta["id_col"], *feats])
    prepped = sc.preprocess_new(keyed, sm.prep)
    scored = sc.score(prepped, sm, keep=(meta["id_col"],))
    if out_path:
        ingest.write_predictions(scored, out_path)
    return scored
