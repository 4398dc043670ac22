"""Online logistic regression: the weights of one micro-batch are the start of the next."""

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartsight.operators.features import online_features
from cartsight.operators.metrics import evaluate, tally
from cartsight.operators.online import STEP_SIZE, STEPS, TOLERANCE, ZERO_WEIGHTS, descend, score
from cartsight.schema import KEY
from cartsight.storage import kept
from cartsight.streaming.lines import parse_stream
from cartsight.streaming.tables import has_batch, in_layout, read_batch, start, write_batch

# Fixed value: batch interval.
EVERY = "5 seconds"
PREVIEW = 5

WEIGHTS = "weights ARRAY<DOUBLE>"
METRICS = (
    "status STRING, n_rows BIGINT, auc_roc DOUBLE, auc_pr DOUBLE, accuracy DOUBLE, "
    "precision DOUBLE, recall DOUBLE, f1 DOUBLE, "
    "preview ARRAY<STRUCT<prediction: DOUBLE, label: DOUBLE>>"
)
MODES = ("train_then_test", "test_then_train")


def weights_before(
    spark: SparkSession, table: str, batch_id: int, initial: Sequence[float] = ZERO_WEIGHTS
) -> tuple[float, ...]:
    """The weights left by the previous batch; a replayed batch finds the same ones.

    A first batch over a table that holds later batches belongs to a new
    checkpoint over an old table: two runs would mix, so it is refused.
    """
    if batch_id == 0:
        if has_batch(spark, table, 1):
            raise ValueError(f"{table} holds batches of an earlier run; start with a new table")
        return tuple(initial)
    return tuple(read_batch(spark, table, batch_id - 1, WEIGHTS).first()["weights"])


def online_batch(
    batch: DataFrame, batch_id: int, weights_table: str, metrics_table: str,
    mode: str = MODES[0], initial: Sequence[float] = ZERO_WEIGHTS,
    step_size: float = STEP_SIZE, steps: int = STEPS, tolerance: float = TOLERANCE, key: str = KEY,
    fraction: float = 1.0,
) -> None:
    """Update the weights on one batch of online features and record its quality.

    ``train_then_test`` measures the updated weights on the batch they were trained
    on; ``test_then_train`` measures the previous ones on rows they have not seen.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = batch.sparkSession
    before = weights_before(spark, weights_table, batch_id, initial)
    with kept(batch):
        rows = batch.count()
        after = descend(batch, before, step_size, steps, tolerance, fraction, key) if rows else before
        if rows:
            scored = score(batch, after if mode == MODES[0] else before)
            first = scored.orderBy(key).limit(PREVIEW)
            pairs = F.array_sort(F.collect_list(F.struct(key, "prediction", "label")))
            preview = first.agg(pairs.alias("pairs")).select(
                F.transform("pairs", lambda p: F.struct(p["prediction"], p["label"])).alias("preview")
            ).first()["preview"]
            metrics = evaluate(tally(scored), positive=1.0)
            status = F.when(F.col("auc_roc").isNull(), "one_class").otherwise("ok")
            shown = F.array(*(F.struct(*map(F.lit, pair)) for pair in preview))
            record = metrics.withColumns({"status": status, "preview": shown})
        else:
            record = spark.range(1).withColumn("status", F.lit("empty"))
        write_batch(in_layout(record, METRICS, n_rows=rows), metrics_table, batch_id)
    write_batch(spark.createDataFrame([(list(after),)], WEIGHTS), weights_table, batch_id)


def online_stream(
    lines: DataFrame, weights_table: str, metrics_table: str, checkpoint: str,
    every: str = EVERY, available_now: bool = False, **options,
) -> StreamingQuery:
    """Start a query that adds one weights row and one metrics row per micro-batch of ``lines``."""
    features = online_features(parse_stream(lines))
    handle = partial(online_batch, weights_table=weights_table, metrics_table=metrics_table, **options)
    return start(features.writeStream.foreachBatch(handle), checkpoint, every, available_now)
