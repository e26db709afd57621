"""Command line for the end-to-end jobs.

    python -m sampwise words FILE [--out DIR]
    python -m sampwise top-fields FILE [--sep ,] [--index 3] [--k 10]
    python -m sampwise sample FILE [--step 5] [--seed N] [--sep ";"]
    python -m sampwise experiments FILE [--model dt|rf|svm] [--seed N] [--key COL]
    python -m sampwise iris FILE [--method systematic|random]

Results are shown on the console (the first ``--show`` rows); ``--out DIR``
writes the whole result as CSV instead.  Spark settings come from the usual
``spark-submit`` / ``spark-defaults.conf`` mechanisms.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .plans import workflows as W


def _emit(df: DataFrame, args) -> None:
    if args.out:
        df.write.mode("overwrite").option("header", True).csv(args.out)
        print(f"written to {args.out}")
    else:
        df.show(args.show, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sampwise")
    p.add_argument("job", choices=["words", "top-fields", "sample", "experiments", "iris"])
    p.add_argument("path")
    p.add_argument("--out")
    p.add_argument("--show", type=int, default=20)
    p.add_argument("--sep")
    p.add_argument("--index", type=int, default=3)
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--step", type=int, default=5)
    p.add_argument("--seed", type=int)
    p.add_argument("--model", choices=["dt", "rf", "svm"], default="dt")
    p.add_argument("--key")
    p.add_argument("--method", choices=["systematic", "random"], default="systematic")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"sampwise-{args.job}").getOrCreate()
    if args.job == "words":
        _emit(W.words_in_file(spark, args.path), args)
    elif args.job == "top-fields":
        _emit(W.top_fields_in_file(spark, args.path, sep=args.sep or ",", index=args.index,
                                   k=args.k), args)
    elif args.job == "sample":
        offset, sample, first = W.sample_file(spark, args.path, step=args.step,
                                              seed=args.seed, sep=args.sep or ";",
                                              n_show=args.show)
        print(f"start offset {offset}, sampled rows {sample.count()}")
        _emit(sample if args.out else first, args)
    elif args.job == "experiments":
        results, summary = W.bank_experiments(spark, args.path, args.model,
                                              offset_seed=args.seed, step=args.step,
                                              key=args.key)
        results.show(truncate=False)
        summary.show(truncate=False)
    elif args.job == "iris":
        _emit(W.iris_parts(spark, args.path, method=args.method), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
