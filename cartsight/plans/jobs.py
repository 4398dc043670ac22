"""The application's jobs, from files to reports.  Each yields titled tables."""

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cartsight.functions import content_key
from cartsight.operators import features, metrics, models, quality, split
from cartsight.schema import KEY, KEYED_SCHEMA, LABEL
from cartsight.sources import line_stream, read_sessions, read_texts, with_key, write_slices
from cartsight.storage import kept
from cartsight.streaming import online as online_jobs
from cartsight.streaming import online_stream, read_batches, run, run_logged, tree_stream
from cartsight.streaming import progress as progress_jobs
from cartsight.streaming import tree as tree_jobs

Report = Iterator[tuple[str, DataFrame]]


def prepare(spark: SparkSession, features: str, target: str, out: str) -> Report:
    """Join a CSV file of key and features with one of key and label, and write two equal slices."""
    *fields, label = KEYED_SCHEMA.fields
    known = read_sessions(spark, features, StructType(fields))
    wanted = read_sessions(spark, target, StructType([fields[0], label]))
    for name, rows in (("features", known), ("target", wanted)):
        repeated = rows.groupBy(KEY).count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"{KEY} {repeated[KEY]} occurs {repeated['count']} times in the {name} file")
    sessions = split.join_features_target(known, wanted)
    write_slices(split.split_exact_halves(sessions), out)
    written = spark.read.option("header", True).csv(out)
    yield "Rows per slice", written.groupBy("slice").count().orderBy("slice")


def profile(spark: SparkSession, paths: Sequence[str]) -> Report:
    texts = read_texts(spark, paths)
    if KEY not in texts.columns:
        texts = texts.withColumn(KEY, content_key(*texts.columns))
    yield "Columns", quality.profile_columns(texts)


def train(spark: SparkSession, paths: Sequence[str], tune: bool = False) -> Report:
    sessions = with_key(read_sessions(spark, paths, KEYED_SCHEMA, view="session_records", optional=[KEY]))
    derived = features.batch_features(sessions)
    yield "Null values", quality.null_columns(derived)
    yield "Rows with null values", quality.rows_with_nulls(derived)

    rows = features.model_features(sessions)
    with kept(rows):
        filled = quality.rows_with_nulls(rows)
        yield "Rows with null values after filling", filled
        part = F.when(split.is_train(), "train").otherwise("test").alias("part")
        yield "Rows per part", rows.groupBy(part).count()
        training, test = split.split_train_test(rows)
        yield "Classes in the training part", metrics.class_distribution(training)
        scored = models.fit_tree(training).transform(test)
        yield "Predictions", metrics.preview(scored, 20, KEY, LABEL, "prediction", "probability")
        yield "Quality of the tree", models.evaluate_tree(scored)
        yield "Confusion matrix", metrics.confusion_matrix(scored, LABEL)
        if tune:
            results = models.cross_validate(training)
            yield "Cross-validation", models.results_table(spark, results)
            best = models.fit_tree(training, models.tree_with(**models.best_point(results))).transform(test)
            yield "Quality of the tuned tree", models.evaluate_tree(best)
            yield "Confusion matrix of the tuned tree", metrics.confusion_matrix(best, LABEL)


def compare(spark: SparkSession, path: str) -> Report:
    """Trees trained on slice 1, on slice 2 and on both, from the slice folders under ``path``."""
    sliced = (
        with_key(read_sessions(spark, f"{path}/slice={n}", KEYED_SCHEMA, optional=[KEY])).withColumn("slice", F.lit(n))
        for n in (1, 2)
    )
    yield "Quality by slice", models.compare_slices(features.model_features(next(sliced).unionByName(next(sliced))))


def _lines(spark: SparkSession, source: str, fmt: str) -> DataFrame:
    if fmt == "socket":
        host, port = source.rsplit(":", 1)
        return line_stream(spark, fmt=fmt, host=host, port=port)
    return line_stream(spark, source, fmt)


def _wait(spark: SparkSession, query: StreamingQuery, progress: str | None, batches: int | None) -> Report:
    """Wait until ``query`` ends; with ``progress``, report its batches there, and stop it after so many ``batches``."""
    if progress is None:
        run(query)
        return
    run_logged(spark, query, progress, None if batches is None else lambda done: done >= batches)
    yield "Batches", read_batches(spark, progress, progress_jobs.PROGRESS).drop("phase_ms").orderBy("batch_id")


def stream_tree(
    spark: SparkSession, source: str, table: str, checkpoint: str, format: str = "text",
    every: str | None = None, once: bool = False, progress: str | None = None, batches: int | None = None,
) -> Report:
    interval = every or tree_jobs.EVERY
    query = tree_stream(_lines(spark, source, format), table, checkpoint, interval, available_now=once)
    yield from _wait(spark, query, progress, batches)
    yield "Quality by batch", read_batches(spark, table, tree_jobs.METRICS).orderBy("batch_id")


def stream_online(
    spark: SparkSession, source: str, weights: str, table: str, checkpoint: str, format: str = "text",
    every: str | None = None, once: bool = False, progress: str | None = None, batches: int | None = None,
    fraction: float = 1.0,
) -> Report:
    interval = every or online_jobs.EVERY
    lines = _lines(spark, source, format)
    query = online_stream(lines, weights, table, checkpoint, interval, available_now=once, fraction=fraction)
    yield from _wait(spark, query, progress, batches)
    yield "Quality by batch", read_batches(spark, table, online_jobs.METRICS).orderBy("batch_id")
