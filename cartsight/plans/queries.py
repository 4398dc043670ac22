"""The registered queries: each operator over the session records of a table folder."""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartsight import functions as fn
from cartsight.operators import encode, features, metrics, models, nodes, online, quality, split
from cartsight.schema import (
    BATCH_NUMERIC, CATEGORICAL, KEY, KEYED_SCHEMA, LABEL, ONLINE_FEATURES, RATIOS,
)
from cartsight.sources import (
    damaged_lines, line_stream, read_sessions, session_lines, session_texts, shop_sessions,
    write_slices,
)
from cartsight.storage import cut_lineage, shared_path
from cartsight.streaming import batch_files, online_stream, parsed_sink, read_batches, run, run_logged, tree_stream
from cartsight.streaming import online as online_stream_module
from cartsight.streaming import progress as progress_module
from cartsight.streaming import tree as tree_stream_module

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
STREAM_BATCHES = 4

# Weights of the fixed score that the quality measures are checked on.
SCORE_WEIGHTS = (-0.03, -0.02, -2.0, -3.0, 0.08, 0.1, -0.1, 0.05, 0.2, -0.2, 0.1)
SCORE_DIGITS = 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame) -> DataFrame:
    """Fractions as doubles with ``DIGITS`` decimals, so that two engines can be compared."""
    def shown(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return F.round(F.col(field.name).cast("double"), DIGITS).alias(field.name)
        return F.col(field.name)

    return df.select(*map(shown, df.schema.fields))


def whole_as_double(df: DataFrame) -> DataFrame:
    """Whole numbers that may be null as doubles, which both engines hand over alike."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegerType)]
    return df.withColumns({c: F.col(c).cast("double") for c in whole})


def _model_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.model_features(shop_sessions(spark, folder))


def _damaged_texts(spark: SparkSession, folder: str, complete_only: bool = True) -> DataFrame:
    lines = damaged_lines(shop_sessions(spark, folder))
    return features.parse_lines(lines, complete_only=complete_only)


def _online(spark: SparkSession, folder: str) -> DataFrame:
    return features.online_features(features.parse_lines(session_lines(shop_sessions(spark, folder))))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    scored = online.score(_online(spark, folder), SCORE_WEIGHTS, SCORE_DIGITS)
    return scored.select(
        KEY, "score", F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )


# Sources and sinks


@query
def scan_csv_sessions(spark, folder):
    path = shared_path(spark, "sessions")
    shop_sessions(spark, folder).write.option("header", True).csv(path)
    return read_sessions(spark, path, KEYED_SCHEMA)


@query
def scan_csv_by_header(spark, folder):
    """The same records from files that hold their columns in different orders."""
    path, sessions = shared_path(spark, "sessions"), shop_sessions(spark, folder)
    orders = (sessions.columns, sorted(sessions.columns), sessions.columns[::-1])
    for i, order in enumerate(orders):
        sessions.where(F.pmod(KEY, F.lit(len(orders))) == i).select(*order).write.mode("append").option("header", True).csv(path)
    return read_sessions(spark, path, KEYED_SCHEMA)


def _written_slices(spark: SparkSession, folder: str) -> str:
    path = shared_path(spark, "slices")
    write_slices(split.split_exact_halves(shop_sessions(spark, folder)), path)
    return path


@query
def write_slices_csv(spark, folder):
    schema = T.StructType([*KEYED_SCHEMA.fields, T.StructField("slice", T.IntegerType())])
    return read_sessions(spark, _written_slices(spark, folder), schema)


@query
def union_slices(spark, folder):
    path = _written_slices(spark, folder)
    return read_sessions(spark, [f"{path}/slice=1", f"{path}/slice=2"], KEYED_SCHEMA, view="session_records")


@query
def view_sessions(spark, folder):
    path = shared_path(spark, "sessions")
    shop_sessions(spark, folder).write.option("header", True).csv(path)
    read_sessions(spark, path, KEYED_SCHEMA, view="session_records")
    return spark.sql("SELECT * FROM session_records")


@query
def preview_top_rows(spark, folder):
    return metrics.preview(_scored(spark, folder), 20, KEY, "label", "prediction", "score")


# Data preparation


@query
def join_features_target(spark, folder):
    sessions = shop_sessions(spark, folder)
    return split.join_features_target(sessions.drop(LABEL), sessions.select(KEY, LABEL))


@query
def split_exact_halves(spark, folder):
    return split.split_exact_halves(shop_sessions(spark, folder)).select(KEY, "slice")


@query
def split_train_test(spark, folder):
    train, test = split.split_train_test(_model_features(spark, folder).select(KEY, LABEL))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def cap_rows(spark, folder):
    return rounded(split.cap_rows(_model_features(spark, folder), 200))


@query
def cv_folds(spark, folder):
    train, _ = split.split_train_test(_model_features(spark, folder))
    return metrics.class_distribution(split.with_fold(train), "fold", LABEL)


# Projections, predicates and scalar functions


@query
def features_batch(spark, folder):
    return rounded(features.flags_to_int(features.batch_features(shop_sessions(spark, folder))))


@query
def features_stream_static(spark, folder):
    return rounded(features.stream_features(_damaged_texts(spark, folder)))


@query
def features_online(spark, folder):
    return rounded(features.online_features(_damaged_texts(spark, folder)))


@query
def parse_csv_lines(spark, folder):
    return whole_as_double(features.typed_fields(_damaged_texts(spark, folder, complete_only=False)))


@query
def parse_numeric_default(spark, folder):
    return features.parsed_with_defaults(_damaged_texts(spark, folder, complete_only=False))


@query
def filter_malformed_lines(spark, folder):
    return features.drop_short_lines(damaged_lines(shop_sessions(spark, folder)))


@query
def label_categories(spark, folder):
    return features.label_categories(shop_sessions(spark, folder)).select(KEY, *CATEGORICAL)


@query
def month_number(spark, folder):
    return shop_sessions(spark, folder).select(
        KEY, "Month", fn.month_number(F.col("Month")).alias("Month_Number"),
        fn.month_number(F.left("Month", F.lit(3))).cast("double").alias("Short_Name_Number"),
    )


@query
def rows_with_nulls(spark, folder):
    return rounded(quality.rows_with_nulls(features.batch_features(shop_sessions(spark, folder))))


@query
def drop_null_rows(spark, folder):
    texts = _damaged_texts(spark, folder, complete_only=False)
    return rounded(quality.drop_null_rows(features.stream_features(texts)))


@query
def fill_null_ratios(spark, folder):
    filled = quality.fill_null_ratios(features.batch_features(shop_sessions(spark, folder)))
    return rounded(filled.select(KEY, *RATIOS))


# Aggregates


@query
def class_distribution(spark, folder):
    train, _ = split.split_train_test(_model_features(spark, folder))
    return metrics.class_distribution(train)


@query
def conversion_by_visitor(spark, folder):
    return metrics.class_distribution(_model_features(spark, folder), "VisitorType", LABEL)


@query
def split_counts(spark, folder):
    derived = features.batch_features(shop_sessions(spark, folder))
    return derived.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(quality.any_null(derived.columns)).alias("n_null_rows"),
        F.count_if(split.is_train()).alias("n_train"),
        F.count_if(~split.is_train()).alias("n_test"),
    )


@query
def null_counts(spark, folder):
    return quality.null_counts(features.batch_features(shop_sessions(spark, folder)))


@query
def null_columns(spark, folder):
    return quality.null_columns(features.batch_features(shop_sessions(spark, folder)))


@query
def profile_columns(spark, folder):
    return quality.profile_columns(session_texts(shop_sessions(spark, folder)))


@query
def slice_class_distribution(spark, folder):
    halves = split.split_exact_halves(shop_sessions(spark, folder))
    return metrics.class_distribution(features.model_features(halves), "slice", LABEL)


# Fitted transformers: learned from the training rows, applied to all rows


@query
def string_index(spark, folder):
    rows = _model_features(spark, folder)
    train, _ = split.split_train_test(rows)
    indexed = encode.string_index(train, rows)
    return indexed.select(
        KEY, *CATEGORICAL, *(F.col(f"{c}_index").cast("int").alias(f"{c}_index") for c in CATEGORICAL)
    )


@query
def one_hot(spark, folder):
    rows = _model_features(spark, folder).select(KEY, *CATEGORICAL)
    train, _ = split.split_train_test(rows)
    return encode.one_hot(train, rows).drop(*CATEGORICAL)


@query
def one_hot_slots(spark, folder):
    """The filled slot of each sparse vector, -1 for none; the training rows miss a label."""
    rows = _model_features(spark, folder).select(KEY, *CATEGORICAL)
    train, _ = split.split_train_test(rows)
    encoded = encode.one_hot_slots(train.where("OperatingSystems <> 'OS_3'"), rows)
    filled = {c: F.array_position(vector_to_array(f"{c}_encoded"), F.lit(1.0)).cast("bigint") - 1 for c in CATEGORICAL}
    return encoded.select(KEY, *(slot.alias(f"{c}_slot") for c, slot in filled.items()))


@query
def index_customers(spark, folder):
    """A category with as many labels as there are customers, learned from the training orders."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias(KEY), F.col("o_custkey").cast("string").alias("Customer"))
    train, _ = split.split_train_test(orders)
    indexed = encode.string_index(train, orders, ["Customer"])
    return indexed.select(KEY, "Customer", F.col("Customer_index").cast("bigint").alias("Customer_index"))


@query
def standardize(spark, folder):
    rows = _model_features(spark, folder).select(KEY, *BATCH_NUMERIC)
    train, _ = split.split_train_test(rows)
    return rounded(encode.standardize(train, rows))


@query
def assemble_features(spark, folder):
    rows = _model_features(spark, folder)
    train, _ = split.split_train_test(rows)
    return rounded(encode.assemble_features(train, rows, [KEY]))


# Scores and quality measures


@query
def score_label_pairs(spark, folder):
    return _scored(spark, folder)


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_scored(spark, folder))


@query
def classification_metrics(spark, folder):
    return rounded(metrics.classification_metrics(metrics.tally(_scored(spark, folder))))


@query
def class1_metrics(spark, folder):
    return rounded(metrics.class_metrics(metrics.tally(_scored(spark, folder))))


def _areas(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.curve_areas(metrics.tally(_scored(spark, folder), prediction=None)))


@query
def auc_roc(spark, folder):
    return _areas(spark, folder).select("auc_roc")


@query
def auc_pr(spark, folder):
    return _areas(spark, folder).select("auc_pr")


@query
def auc_unrounded(spark, folder):
    # 12 digits, since engines differ in the last bits of a sum.
    scored = online.score(_online(spark, folder), SCORE_WEIGHTS, 12)
    return rounded(metrics.curve_areas(metrics.tally(scored, prediction=None), score_ranges=16))


@query
def sgd_gradient_step(spark, folder):
    return rounded(online.gradient_step(_online(spark, folder)))


@query
def sgd_mini_batch_step(spark, folder):
    return rounded(online.gradient_step(online.mini_batch(_online(spark, folder), 0.25, step=1)))


# Models


@query
def tree_predictions(spark, folder):
    return rounded(models.tree_predictions(_model_features(spark, folder)))


@query
def cv_grid_results(spark, folder):
    train, _ = split.split_train_test(_model_features(spark, folder))
    return rounded(models.grid_results(train))


@query
def best_model_metrics(spark, folder):
    return rounded(models.best_model_metrics(_model_features(spark, folder)))


@query
def slice_model_comparison(spark, folder):
    halves = split.split_exact_halves(shop_sessions(spark, folder))
    return rounded(models.compare_slices(features.model_features(halves)))


# Trees whose every split SQL can list: numbers with few values

#: Fewest rows on a side of a split, and the settings that cross-validation compares.
SIDE = 20
STUMP_GRID = {"maxDepth": (1, 2), "minInstancesPerNode": (20, 400, 1000)}


def _few_valued(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return split.split_train_test(nodes.few_valued(shop_sessions(spark, folder)))


@query
def tree_nodes(spark, folder):
    train, _ = _few_valued(spark, folder)
    fitted = nodes.fit_numeric_tree(train, maxDepth=2, minInstancesPerNode=SIDE)
    return rounded(nodes.tree_nodes(fitted).select("path", "feature", "threshold", "gain", "n", "n_positive", "prediction"))


def _node_scores(spark: SparkSession, folder: str, depth: int) -> DataFrame:
    train, test = _few_valued(spark, folder)
    fitted = nodes.fit_numeric_tree(train, maxDepth=depth, minInstancesPerNode=SIDE)
    encoded = PipelineModel(fitted.stages[:-1]).transform(test)
    return rounded(nodes.score_by_nodes(nodes.tree_nodes(fitted), encoded).select(KEY, LABEL, "prediction", "probability", "score"))


@query
def tree_stump(spark, folder):
    return _node_scores(spark, folder, 1)


@query
def tree_node_scores(spark, folder):
    return _node_scores(spark, folder, 2)


@query
def cv_stump_results(spark, folder):
    train, _ = _few_valued(spark, folder)
    return rounded(models.grid_results(train, grid=STUMP_GRID, numeric=nodes.FEW_VALUED, categorical=()))


# Streams: the lines of all sessions, as files that arrive in a few micro-batches


#: Lines of a file at most; an arrival is so many files of about equal size.
FILE_LINES = 1_000_000


def _run_arrivals(
    lines: DataFrame, start: Callable[[DataFrame, str], StreamingQuery], arrival: Column | None = None,
    wait: Callable[[StreamingQuery], bool] = run,
) -> str:
    """Let the lines arrive in ``STREAM_BATCHES`` parts, chosen by key, and run one query over them: a part is a micro-batch.

    The lines are computed once.  Every part is the same number of files, and
    the stream admits so many files at a time, the oldest first.  Returns the
    checkpoint folder.
    """
    spark = lines.sparkSession
    path, state = shared_path(spark, "lines"), shared_path(spark, "state")
    arrival = fn.bucket(F.col(KEY), STREAM_BATCHES) if arrival is None else arrival
    held = cut_lineage(lines.select("value", arrival.alias("arrival")), "arrivals")
    sizes = [r["count"] for r in held.groupBy("arrival").count().collect()]  # STREAM_BATCHES rows
    files = min(-(-max(sizes, default=1) // FILE_LINES), min(sizes, default=1))
    for i in range(STREAM_BATCHES):
        held.where(F.col("arrival") == i).select("value").repartition(files).write.mode("append").text(path)
    wait(start(line_stream(spark, path, maxFilesPerTrigger=files), state))
    return state


@query
def stream_parse_sessions(spark, folder):
    out = shared_path(spark, "parsed")
    _run_arrivals(session_lines(shop_sessions(spark, folder)), lambda lines, state: parsed_sink(lines, out, state, available_now=True))
    return spark.read.parquet(out).drop(KEY)


@query
def stream_batch_log(spark, folder):
    """Lines of every micro-batch, from the log of the files that it was given."""
    out = shared_path(spark, "parsed")
    state = _run_arrivals(session_lines(shop_sessions(spark, folder)), lambda lines, state: parsed_sink(lines, out, state, available_now=True))
    log = batch_files(spark, state)
    files = [r["path"] for r in log.select("path").collect()]  # as many as the log has lines
    lines = spark.read.text(files).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    name = F.element_at(F.split("path", "/"), -1)
    counted = log.select("batch_id", name.alias("file")).join(lines.select(name.alias("file"), "n"), "file")
    return counted.groupBy("batch_id").agg(F.sum("n").alias("n_lines"))


@query
def stream_batch_progress(spark, folder):
    """Input rows of every micro-batch, as the query's own events report them."""
    out, table = shared_path(spark, "parsed"), shared_path(spark, "progress")
    _run_arrivals(
        session_lines(shop_sessions(spark, folder)), lambda lines, state: parsed_sink(lines, out, state, available_now=True),
        wait=lambda stream: run_logged(spark, stream, table),
    )
    return read_batches(spark, table, progress_module.PROGRESS).select("batch_id", "n_input")


def _tree_metrics(spark: SparkSession, folder: str, **options) -> DataFrame:
    table = shared_path(spark, "tree")
    _run_arrivals(
        session_lines(shop_sessions(spark, folder)), lambda lines, state: tree_stream(lines, table, state, available_now=True, **options)
    )
    return rounded(read_batches(spark, table, tree_stream_module.METRICS))


@query
def stream_tree_metrics(spark, folder):
    return _tree_metrics(spark, folder, max_train_rows=200)


@query
def stream_tree_metrics_all_rows(spark, folder):
    return _tree_metrics(spark, folder)


@query
def stream_tree_guards(spark, folder):
    """Arrivals by browser: cut lines only, garbage in a checked number, one class, and all others."""
    table, browser = shared_path(spark, "tree"), F.col("Browser")
    sessions = shop_sessions(spark, folder)
    arrival = F.when(browser == 13, 0).when(browser == 11, 1).when(browser == 10, 2).otherwise(3).alias("arrival")
    lines = damaged_lines(sessions).join(sessions.select(KEY, arrival), KEY)
    _run_arrivals(lines, lambda lines, state: tree_stream(lines, table, state, available_now=True), F.col("arrival"))
    return read_batches(spark, table, tree_stream_module.METRICS).select("batch_id", "status", "n_rows", "n_clean")


@query
def stream_tree_splits(spark, folder):
    """Rows and positive rows on both sides of the split of every micro-batch, some of them damaged lines."""
    table = shared_path(spark, "tree")
    _run_arrivals(damaged_lines(shop_sessions(spark, folder)), lambda lines, state: tree_stream(lines, table, state, available_now=True))
    columns = ("batch_id", "status", "n_rows", "n_clean", "n_train", "n_test", "n_train_positive", "n_test_positive")
    return read_batches(spark, table, tree_stream_module.METRICS).select(*columns)


def _online_rows(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Quality, first pairs and weights of every micro-batch."""
    weights, table = shared_path(spark, "weights"), shared_path(spark, "online")
    _run_arrivals(
        session_lines(shop_sessions(spark, folder)), lambda lines, state: online_stream(lines, weights, table, state, available_now=True, **options)
    )
    quality_rows = read_batches(spark, table, online_stream_module.METRICS)
    quality_rows = quality_rows.withColumn("preview", F.to_json("preview"))
    kept_weights = read_batches(spark, weights, online_stream_module.WEIGHTS)
    named = (F.get("weights", F.lit(i)).alias(f"w_{c}") for i, c in enumerate(ONLINE_FEATURES))
    return rounded(quality_rows.join(kept_weights.select("batch_id", *named), "batch_id"))


@query
def stream_online_metrics(spark, folder):
    return _online_rows(spark, folder)


@query
def stream_online_weights(spark, folder):
    rows = _online_rows(spark, folder, steps=5, tolerance=0.0)
    return rows.drop("status", "auc_roc", "auc_pr", "preview")
