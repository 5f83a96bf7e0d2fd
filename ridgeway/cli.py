"""Command-line jobs: the reference's programs as Spark jobs over paths.

    python -m ridgeway.cli gd    --loss logistic --input rows_tsv/ --n-features 3 \\
                                 [--init-weights w.csv] --output model_out/ [--format record]
    python -m ridgeway.cli sgd   --kind softmax --input feats.parquet --id-col id \\
                                 --features features --label label --shards 4 --output model.parquet
    python -m ridgeway.cli score --model model.parquet --input feats.parquet --features features \\
                                 --output scored.parquet

Text inputs are label-first TSV (``--sep '\\t'``, default) or CSV; weights are
read from ``idx,weight`` lines or a ``weights,w0,...`` record and written in
either format, or as a Parquet model table.  Paths may be on any filesystem
Spark can reach.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName(f"ridgeway-{args.cmd}")
    if args.master:
        b = b.master(args.master)
    return b.getOrCreate()


def _read_model(spark: SparkSession, path: str, fmt: str):
    from ridgeway.sources.model_io import read_model
    return read_model(spark, path, fmt)


def _write_model(df, path: str, fmt: str) -> None:
    from ridgeway.sources.model_io import write_model
    write_model(df, path, fmt)


def _log(spark: SparkSession, args):
    if not args.log:
        return None
    from ridgeway.sources.training_log import TrainingLog
    return TrainingLog(spark, args.log)


def cmd_gd(args) -> None:
    from ridgeway.model import LinearModel
    from ridgeway.operators.gd import LINEAR_DEFAULTS, LINEAR_L2_DEFAULTS, LOGISTIC_DEFAULTS, GDConfig, train_gd
    from ridgeway.sources.text import read_labelled_text
    spark = _session(args)
    rows = read_labelled_text(spark, args.input, args.n_features, args.sep)
    init = None
    if args.init_weights:
        init = LinearModel.from_table(_read_model(spark, args.init_weights, args.init_format))
    given = {k: v for k, v in (("lr", args.lr), ("l2", args.l2), ("tol", args.tol)) if v is not None}
    base = LOGISTIC_DEFAULTS if args.loss == "logistic" else LINEAR_L2_DEFAULTS if args.l2 else LINEAR_DEFAULTS
    cfg = GDConfig(**{**base, **given}, max_epochs=args.max_epochs, materialize=args.materialize)
    features = [f"x{i}" for i in range(1, args.n_features + 1)]
    res = train_gd(rows, features, "y", cfg, init=init, log=_log(spark, args),
                   on_epoch=lambda h: print(f"epoch {h[0]} loss {h[2]:.10g} stopped {h[4]}", file=sys.stderr))
    _write_model(res.model_table(spark), args.output, args.format)
    if args.history:
        res.history_table(spark).coalesce(1).write.mode("errorifexists").parquet(args.history)


def cmd_sgd(args) -> None:
    from ridgeway.model import LinearModel
    from ridgeway.operators.sgd import HINGE_DEFAULTS, MULTICLASS_HINGE_DEFAULTS, SOFTMAX_DEFAULTS, SGDConfig, train_sgd
    spark = _session(args)
    rows = spark.read.parquet(args.input)
    features = args.features if len(args.features) > 1 else args.features[0]
    init = LinearModel.from_table(_read_model(spark, args.init_weights, args.init_format)) \
        if args.init_weights else None
    base = {"hinge": HINGE_DEFAULTS, "multiclass_hinge": MULTICLASS_HINGE_DEFAULTS, "softmax": SOFTMAX_DEFAULTS}[args.kind]
    given = {k: v for k, v in (("alpha", args.alpha), ("l2", args.l), ("max_iter", args.max_iter), ("tol", args.tol)) if v is not None}
    cfg = SGDConfig(**{**base, **given}, shards=args.shards, rows_per_shard=args.rows_per_shard,
                    materialize=args.materialize, fit_intercept=not args.no_intercept)
    res = train_sgd(rows, args.id_col, features, args.label, cfg, init=init, log=_log(spark, args),
                    on_epoch=lambda h: print(f"epoch {h[0]} delta {h[3]:.10g}", file=sys.stderr))
    _write_model(res.model_table(spark), args.output, args.format)
    if args.history:
        res.history_table(spark).coalesce(1).write.mode("errorifexists").parquet(args.history)


def cmd_score(args) -> None:
    from pyspark.sql import types as T
    from ridgeway.model import LinearModel
    from ridgeway.operators.scoring import (decision_score, with_class_scores, with_prediction,
                                            with_probabilities)
    spark = _session(args)
    model = LinearModel.from_table(_read_model(spark, args.model, args.model_format))
    rows = spark.read.parquet(args.input)
    feats = args.features
    is_array = len(feats) == 1 and isinstance(rows.schema[feats[0]].dataType, T.ArrayType)
    if not is_array:
        if model.n_classes != 1:
            raise SystemExit("a K-class model scores an array<double> feature column")
        out = decision_score(rows, feats, model)
    elif model.n_classes == 1:
        out = with_class_scores(rows, feats[0], model).withColumn("score", F.col("scores")[0]).drop("scores")
    else:
        out = with_probabilities(with_prediction(with_class_scores(rows, feats[0], model)))
    out.write.mode("errorifexists").parquet(args.output)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ridgeway")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("gd", help="full-batch gradient descent on label-first text rows")
    g.add_argument("--loss", choices=["squared", "logistic"], required=True)
    g.add_argument("--input", required=True)
    g.add_argument("--n-features", type=int, required=True)
    g.add_argument("--sep", default="\t")
    g.add_argument("--init-weights")
    g.add_argument("--init-format", choices=["lines", "record", "parquet"], default="lines")
    g.add_argument("--lr", type=float, help="default: the reference program's, by loss")
    g.add_argument("--l2", type=float)
    g.add_argument("--tol", type=float)
    g.add_argument("--max-epochs", type=int, default=100000)
    g.add_argument("--materialize", choices=["persist", "checkpoint", "none"], default="persist")
    g.add_argument("--output", required=True)
    g.add_argument("--format", choices=["lines", "record", "parquet"], default="lines")
    g.add_argument("--history")
    g.add_argument("--log", help="training log folder: record every epoch, resume after a restart")
    g.set_defaults(fn=cmd_gd)

    s = sub.add_parser("sgd", help="parameter-averaged SGD over shards")
    s.add_argument("--kind", choices=["hinge", "multiclass_hinge", "softmax"], required=True)
    s.add_argument("--input", required=True)
    s.add_argument("--id-col", default="id")
    s.add_argument("--features", nargs="+", required=True)
    s.add_argument("--label", default="label")
    s.add_argument("--init-weights")
    s.add_argument("--init-format", choices=["lines", "record", "parquet"], default="parquet")
    s.add_argument("--alpha", type=float, help="this, l, max-iter and tol default to the reference program's, by kind")
    s.add_argument("--l", type=float)
    s.add_argument("--shards", type=int, help="exactly this many shards (default 4)")
    s.add_argument("--rows-per-shard", type=int, help="or shards of this many rows")
    s.add_argument("--max-iter", type=int)
    s.add_argument("--tol", type=float)
    s.add_argument("--no-intercept", action="store_true")
    s.add_argument("--materialize", choices=["persist", "checkpoint", "none"], default="persist")
    s.add_argument("--output", required=True)
    s.add_argument("--format", choices=["lines", "record", "parquet"], default="parquet")
    s.add_argument("--history")
    s.add_argument("--log", help="training log folder: record every epoch, resume after a restart")
    s.set_defaults(fn=cmd_sgd)

    c = sub.add_parser("score", help="score rows with a stored model")
    c.add_argument("--model", required=True)
    c.add_argument("--model-format", choices=["lines", "record", "parquet"], default="parquet")
    c.add_argument("--input", required=True)
    c.add_argument("--features", nargs="+", required=True)
    c.add_argument("--output", required=True)
    c.set_defaults(fn=cmd_score)

    args = ap.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
