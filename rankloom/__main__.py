"""Command line: ``python -m rankloom matrices|recommend|tune ...``.

  matrices  --events E.csv --props P1.csv P2.csv --out DIR [--models 1 2 3 4] [--on-unknown drop]
  recommend --matrix DIR/model1 --model 1 --out DIR [--rank 10 --iters 10 --n 10]
            [--ids dictionary --id-type string] [--models DIR] [--unseen]
  tune      --matrix DIR/model2 --model 2 --out DIR [--method cv|tvs]

Under spark-submit (or PYSPARK_SUBMIT_ARGS) the launcher's master and settings hold.
"""

from __future__ import annotations

import argparse
import json

from .session import build_session
from .workflow import build_matrices, train_and_recommend, tune_model


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="rankloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("matrices")
    a.add_argument("--events", required=True)
    a.add_argument("--props", nargs="+", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--models", nargs="+", type=int, default=[1, 2, 3, 4])
    a.add_argument("--on-unknown", choices=["error", "drop"], default="error")
    b = sub.add_parser("recommend")
    b.add_argument("--matrix", required=True)
    b.add_argument("--model", type=int, required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--rank", type=int, default=10)
    b.add_argument("--iters", type=int, default=10)
    b.add_argument("--reg", type=float, default=0.01)
    b.add_argument("--alpha", type=float, default=0.01)
    b.add_argument("--n", type=int, default=10)
    b.add_argument("--implicit", choices=["yes", "no"], default=None)
    b.add_argument("--collapse", choices=["none", "max", "sum", "mean"], default="none")
    b.add_argument("--ids", choices=["int", "dictionary"], default="int")
    b.add_argument("--id-type", choices=["long", "string"], default="long")
    b.add_argument("--models")
    b.add_argument("--unseen", action="store_true")
    c = sub.add_parser("tune")
    c.add_argument("--matrix", required=True)
    c.add_argument("--model", type=int, required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--method", choices=["cv", "tvs"], default="cv")
    args = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession() or build_session()
    if args.cmd == "matrices":
        res = build_matrices(spark, args.events, args.props, args.out, args.models,
                             on_unknown=args.on_unknown)
    elif args.cmd == "tune":
        res = tune_model(spark, args.matrix, args.model, args.out, args.method)
    else:
        imp = None if args.implicit is None else args.implicit == "yes"
        res = train_and_recommend(spark, args.matrix, args.model, args.out, imp, args.rank,
                                  args.iters, args.reg, args.alpha, args.n,
                                  collapse=args.collapse, ids=args.ids, id_type=args.id_type,
                                  models=args.models, unseen=args.unseen)
    print(json.dumps({str(k): v for k, v in res.items()}))


if __name__ == "__main__":
    main()
