"""Command line: the three actions of the engine.

    python -m sparkqc prepare --src DIR --contract JSON --table DIR --quarantine DIR
    python -m sparkqc train   --table DIR --contract JSON --out DIR
    python -m sparkqc predict --src DIR --contract JSON --model DIR --out DIR
"""

from __future__ import annotations

import argparse
import json

from sparkqc.plans import pipeline
from sparkqc.session import get_session
from sparkqc.sources.contract import contract_schema


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="sparkqc")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("--src", required=True)
    p.add_argument("--contract", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--quarantine", required=True)
    p.add_argument("--incremental", action="store_true", help="keep the table as a set of distinct rows")
    t = sub.add_parser("train")
    t.add_argument("--table", required=True)
    t.add_argument("--contract", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--ks", default="", help="numbers of features, e.g. 5,10; all from 1 to 50 by default")
    t.add_argument("--families", default="", help="all by default")
    t.add_argument("--trials", type=int, default=pipeline.N_TRIALS)
    t.add_argument("--threshold", type=float, default=0.10)
    r = sub.add_parser("predict")
    r.add_argument("--src", required=True)
    r.add_argument("--contract", required=True)
    r.add_argument("--model", required=True)
    r.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = get_session(master=None)
    c = contract_schema(a.contract)
    if a.cmd == "prepare":
        print(json.dumps(pipeline.prepare(spark, a.src, c, a.table, a.quarantine, a.incremental)))
    elif a.cmd == "train":
        res = pipeline.train(spark, a.table, a.out, c, ks=tuple(int(x) for x in a.ks.split(",") if x) or None,
                             families=tuple(x for x in a.families.split(",") if x) or None, n_trials=a.trials, threshold=a.threshold)
        print(json.dumps(res, default=str))
    else:
        pipeline.predict(spark, a.src, c, a.model, a.out)
        print(json.dumps({"predictions": a.out}))
    spark.stop()


if __name__ == "__main__":
    main()
