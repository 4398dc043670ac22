"""A decision tree per micro-batch: trained, scored on held-out rows, recorded, forgotten."""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartsight.operators.features import stream_features
from cartsight.operators.models import evaluate_tree, fit_tree, stream_tree
from cartsight.operators.quality import drop_null_rows, missing
from cartsight.operators.split import cap_rows, is_train, split_train_test
from cartsight.schema import KEY, LABEL, STREAM_NUMERIC
from cartsight.storage import kept
from cartsight.streaming.lines import parse_stream
from cartsight.streaming.tables import in_layout, start, write_batch

# Batch interval, fewest clean rows worth training on.
EVERY = "30 seconds"
MIN_ROWS = 20

METRICS = (
    "status STRING, n_rows BIGINT, n_clean BIGINT, n_train BIGINT, n_test BIGINT, n_train_positive BIGINT, n_test_positive BIGINT, "
    "auc_roc DOUBLE, auc_pr DOUBLE, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE"
)


def tree_batch(
    batch: DataFrame, batch_id: int, table: str,
    min_rows: int = MIN_ROWS, max_train_rows: int | None = None, key: str = KEY,
) -> None:
    """Train and evaluate on one batch of stream features; write one row whatever happens.

    All held-out rows are scored.  ``max_train_rows`` bounds the rows that the
    tree is fitted on, the same ones each time; ``n_train`` counts them.
    ``n_train_positive`` counts the positive rows before that bound.
    """
    with kept(batch):
        counts = batch.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(~missing(batch)).alias("n_clean")
        )
        sizes = counts.first().asDict()
        known = dict(sizes)
        one_row = batch.sparkSession.range(1)
        if sizes["n_rows"] == 0:
            return write_batch(in_layout(one_row, METRICS, status="empty", **known), table, batch_id)
        if sizes["n_clean"] < min_rows:
            return write_batch(in_layout(one_row, METRICS, status="too_few_rows", **known), table, batch_id)

        clean = drop_null_rows(batch)
        positive = F.col(LABEL).cast("int") == 1
        known |= clean.agg(
            F.count_if(is_train(key)).alias("n_train"), F.count_if(~is_train(key)).alias("n_test"),
            F.count_if(is_train(key) & positive).alias("n_train_positive"), F.count_if(~is_train(key) & positive).alias("n_test_positive"),
        ).first().asDict()
        if known["n_train"] == 0 or known["n_test"] == 0:
            return write_batch(in_layout(one_row, METRICS, status="empty_split", **known), table, batch_id)
        train, test = split_train_test(clean, key=key)
        if max_train_rows is not None:
            train, known["n_train"] = cap_rows(train, max_train_rows, key), min(known["n_train"], max_train_rows)
        metrics = evaluate_tree(fit_tree(train, stream_tree(), STREAM_NUMERIC, hold=False).transform(test))
        status = F.when(F.col("auc_roc").isNull(), "one_class").otherwise("ok")
        write_batch(in_layout(metrics.withColumn("status", status), METRICS, **known), table, batch_id)


def tree_stream(
    lines: DataFrame, table: str, checkpoint: str, every: str = EVERY, available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Start a query that adds one metrics row per micro-batch of ``lines`` to ``table``."""
    features = stream_features(parse_stream(lines))
    writer = features.writeStream.foreachBatch(partial(tree_batch, table=table, **options))
    return start(writer, checkpoint, every, available_now)
