"""Run one job from the command line or with spark-submit; master and credentials come from there.

    spark-submit --py-files scorekit.zip run_job.py train --algo rf \\
        --train s3a://bucket/train.csv --valid s3a://bucket/valid.csv \\
        --model s3a://bucket/model --predictions s3a://bucket/predictions
    spark-submit --py-files scorekit.zip run_job.py predict \\
        --input s3a://bucket/new.csv --model s3a://bucket/model \\
        --predictions s3a://bucket/new_predictions

With `--release` a job publishes all it makes at once in a folder of releases, and `predict` takes the
model from the current release in `--model`.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession

import scorekit as sk


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--model", help="where the model is saved, or its releases lie")
    common.add_argument("--predictions", help="where predictions are written")
    common.add_argument("--release", help="publish what the job makes here, instead")
    common.add_argument("--corrupt", help="a name for the column that keeps bad CSV rows; takes --schema")
    common.add_argument("--format", choices=["csv", "parquet"], default="csv")
    common.add_argument("--sep", default=",")
    common.add_argument("--quote", default='"')
    common.add_argument("--schema", help="DDL of a CSV table; without it types are inferred")
    common.add_argument(
        "--mode", help="what to do with bad CSV rows: FAILFAST (if a schema is given) or PERMISSIVE"
    )
    common.add_argument("--target", default=sk.TARGET)
    common.add_argument("--features", nargs="+", help="the default of predict is what the model has")

    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    train = jobs.add_parser("train", parents=[common])
    train.add_argument("--train", required=True)
    train.add_argument("--valid", required=True)
    train.add_argument("--algo", choices=["rf", "lr"], default="rf")
    train.add_argument("--num-classes", type=int, help="highest label plus one, if known")
    train.add_argument("--partitions", type=int, help="merge splits to this many for the fit")
    train.add_argument(
        "--stable", action="store_true", help="lay rows out in --partitions for repeatable trees"
    )
    train.add_argument("--fit-rows", type=int, help="fit on so many rows, chosen by their hashes")
    train.add_argument("--cache", action="store_true", help="keep the training rows for the fit")
    train.add_argument(
        "--param", action="append", default=[], type=parameter, metavar="NAME=VALUE",
        help="a parameter of the estimator, such as numTrees=20; may be repeated",
    )
    rows = "hold this many rows in a partition at most, in as many more partitions as that takes"
    train.add_argument("--partition-rows", type=int, help=rows)
    predict = jobs.add_parser("predict", parents=[common])
    predict.add_argument("--input", required=True)
    predict.add_argument("--unlabelled", action="store_true", help="the table has no target")
    predict.add_argument("--partitions", type=int, help="deal rows out to this many tasks")
    predict.add_argument("--partition-rows", type=int, help=rows)
    args = parser.parse_args(argv)
    if args.release is None and (args.model is None or args.predictions is None):
        parser.error("give --model and --predictions, or --release")
    if args.release is not None and args.job == "predict" and args.model is None:
        parser.error("--model names the folder that the model is released in")
    return args


def parameter(text: str) -> tuple[str, object]:
    """`numTrees=20` as a name and a number, a truth value or else a text."""
    name, sign, value = text.partition("=")
    if not sign:
        raise argparse.ArgumentTypeError(f"{text} is not NAME=VALUE")
    for kind in (int, float):
        try:
            return name, kind(value)
        except ValueError:
            pass
    return name, {"true": True, "false": False}.get(value.lower(), value)


def read(spark: SparkSession, args: argparse.Namespace, path: str) -> DataFrame:
    if args.format == "parquet":
        return spark.read.parquet(path)
    return sk.read_csv(spark, path, args.schema, args.sep, args.quote, args.mode, args.corrupt)


def show_metrics(title: str, metrics: DataFrame) -> None:
    print(f"\n{title}")
    for metric, value in sk.metric_report(metrics).collect():
        print(f"{metric}: {value}")


def show_counts(title: str, counts: sk.RowCounts | None) -> None:
    if counts is not None:
        print(f"\n{title}: {counts.scanned} read, {counts.bad} bad, {counts.dropped} dropped")


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"scorekit {args.job}").getOrCreate()
    names = {
        "target": args.target,
        "corrupt": args.corrupt,
        "partition_rows": args.partition_rows,
    }
    release = None
    if args.job == "train":
        tables = read(spark, args, args.train), read(spark, args, args.valid), args.algo
        options = {
            "features": args.features or sk.FEATURES,
            "num_classes": args.num_classes,
            "partitions": args.partitions,
            "stable": args.stable,
            "cache": args.cache,
            "fit_rows": args.fit_rows,
            **names,
            **dict(args.param),
        }
        if args.release:
            result, release = sk.train_release(*tables, args.release, **options)
        else:
            result = sk.train_job(*tables, args.model, args.predictions, **options)
        if args.algo == "rf":
            print("\nfeature importances")
            for row in result.report.orderBy("idx").collect():
                print(f"{row.idx} {row.feature}: {row.importance}")
        else:
            show_metrics("training metrics", result.report)
        show_counts("training rows", result.train_counts)
        show_counts("validation rows", result.valid_counts)
    else:
        options = {"labelled": not args.unlabelled, "partitions": args.partitions, **names}
        table = read(spark, args, args.input)
        if args.release:
            result, release = sk.predict_release(
                table, args.model, args.release, features=args.features, **options
            )
        else:
            result = sk.predict_job(
                table, args.model, args.predictions, features=args.features, **options
            )
        show_counts("rows", result.counts)
    result.preview.show(truncate=False)
    if result.metrics is not None:
        show_metrics("metrics", result.metrics)
    if release is not None:
        print(f"\npublished as release {release.number} of {release.root}")


if __name__ == "__main__":
    main()
