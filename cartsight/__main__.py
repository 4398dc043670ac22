"""Command line: ``spark-submit -m cartsight <command>`` or ``python -m cartsight <command>``."""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.plans import jobs

SAMPLE_WIDTH = 60


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cartsight", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare", help="join features with target and write two equal slices")
    prepare.add_argument("features")
    prepare.add_argument("target")
    prepare.add_argument("out")

    profile = commands.add_parser("profile", help="describe the columns of CSV files")
    profile.add_argument("paths", nargs="+")

    train = commands.add_parser("train", help="clean, train and evaluate on CSV files")
    train.add_argument("paths", nargs="+")
    train.add_argument("--tune", action="store_true", help="also cross-validate the tree settings")

    compare = commands.add_parser("compare", help="compare models by slice and over both")
    compare.add_argument("path", help="folder with slice=1 and slice=2")

    for name, extra in (("stream-tree", ("table",)), ("stream-online", ("weights", "table"))):
        stream = commands.add_parser(name, help="train on every micro-batch of a line stream")
        stream.add_argument("source", help="folder of text files, or host:port with --format socket")
        for argument in (*extra, "checkpoint"):
            stream.add_argument(argument)
        stream.add_argument("--format", default="text")
        stream.add_argument("--every", help="batch interval")
        stream.add_argument("--once", action="store_true", help="stop after the lines that are there")
        stream.add_argument("--progress", help="table of input rows and times of every batch")
        stream.add_argument("--batches", type=int, help="stop after so many batches; needs --progress")
        if name == "stream-online":
            stream.add_argument("--fraction", type=float, default=1.0, help="part of a batch that a descent step reads")
    return top


def shown(table: DataFrame) -> DataFrame:
    """``table`` with sample values cut to the width of a screen."""
    if "sample_values" not in table.columns:
        return table
    return table.withColumn("sample_values", F.left("sample_values", F.lit(SAMPLE_WIDTH)))


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    commands = parser()
    given = commands.parse_args(arguments)
    if getattr(given, "batches", None) is not None and given.progress is None:
        commands.error("--batches needs --progress")
    spark = spark or SparkSession.builder.appName(f"cartsight-{given.command}").getOrCreate()
    job = getattr(jobs, given.command.replace("-", "_"))
    options = {k: v for k, v in vars(given).items() if k != "command"}
    for title, table in job(spark, **options):
        print(f"\n{title}")
        shown(table).show(20, truncate=False)


if __name__ == "__main__":
    main()
