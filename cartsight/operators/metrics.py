"""Classification quality as DataFrames, from counts that one pass collects.

``tally`` counts rows per (score, label, prediction).  Everything else reads the
tally, so a hot score or class costs one row, not a long task.
"""

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartsight.schema import LABEL
from cartsight.storage import kept

# Distinct scores in a range, about; a range is ranked by one task.  The ranges' totals are broadcast, a row per range.
RANGE_SCORES = 100_000
MOST_RANGES = 1 << 16


def class_distribution(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*(by or (LABEL,))).agg(F.count(F.lit(1)).alias("count"))


def tally(
    scored: DataFrame, label: str = "label", score: str | Column = "score",
    prediction: str | Column | None = "prediction",
) -> DataFrame:
    score = F.col(score) if isinstance(score, str) else score
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    columns = {"score": score, "label": F.col(label)}
    if prediction is not None:
        columns["prediction"] = prediction
    named = [c.cast("double").alias(n) for n, c in columns.items()]
    return scored.groupBy(*named).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (
        scored.groupBy(label, prediction)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(label, prediction)
    )


def _class_counts(counts: DataFrame) -> DataFrame:
    """Per class: rows of it, rows predicted as it, and rows that are both.  Rows without a label or a prediction are left out."""
    cells = counts.where("label IS NOT NULL AND prediction IS NOT NULL").groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_label = F.struct(F.col("label").alias("class"), F.col("n").alias("actual"),
                        F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits"))
    as_guess = F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                        F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits"))
    return (
        cells.select(F.inline(F.array(as_label, as_guess)))
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in ("actual", "predicted", "hits")))
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _of_each_class() -> dict[str, Column]:
    hits = F.col("hits")
    return {
        "precision": _ratio(hits, F.col("predicted")),
        "recall": _ratio(hits, F.col("actual")),
        "f1": _ratio(2 * hits, F.col("predicted") + F.col("actual")),
    }


def _accuracy() -> Column:
    return F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy")


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged by class size, from a tally."""
    averages = (
        F.try_divide(F.sum(value * F.col("actual")), F.sum("actual")).alias(name)
        for name, value in _of_each_class().items()
    )
    return _class_counts(counts).agg(_accuracy(), *averages)


def class_metrics(counts: DataFrame, positive: float = 1.0) -> DataFrame:
    """Accuracy, and precision, recall and F1 of one class, from a tally."""
    of_class = (
        F.coalesce(F.max(F.when(F.col("class") == positive, value)), F.lit(0.0)).alias(name)
        for name, value in _of_each_class().items()
    )
    return _class_counts(counts).agg(_accuracy(), *of_class)


def curve_areas(counts: DataFrame, score_ranges: int | None = None) -> DataFrame:
    """Exact areas under the ROC and precision-recall curves, ties included, from a tally.

    Null when only one class is present.  Rows whose score is null or not a
    number, and rows whose label is neither 0 nor 1, cannot be ranked and are
    left out.  The distinct scores are ranked inside score ranges, each starting
    from the totals of the ranges above; the number of ranges follows that of
    the scores unless it is given.
    """
    points = _points(counts)
    with kept(points):
        areas = _areas(points, score_ranges or points.count() // RANGE_SCORES)
        return counts.sparkSession.createDataFrame(areas.collect(), areas.schema)


def _points(counts: DataFrame) -> DataFrame:
    """Rows of either class per score that can be ranked."""
    usable = counts.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isin(0.0, 1.0))
    of_class = {name: F.sum(F.when(F.col("label") == value, F.col("n")).otherwise(0)) for name, value in (("pos", 1), ("neg", 0))}
    return usable.groupBy("score").agg(*(total.alias(name) for name, total in of_class.items()))


def _areas(points: DataFrame, score_ranges: int) -> DataFrame:
    ranked = _ranked_in_ranges(points, min(MOST_RANGES, max(2, score_ranges)))
    pos_before = F.col("pos_upto") - F.col("pos")
    all_before = pos_before + F.col("neg_upto") - F.col("neg")
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    precision_before = F.coalesce(F.try_divide(pos_before, all_before), precision)
    roc = F.sum(F.col("neg").cast("double") * (pos_before + F.col("pos") / 2))
    pr = F.sum(F.col("pos") * (precision_before + precision) / 2)
    total_pos, total_neg = (F.sum(c).cast("double") for c in ("pos", "neg"))
    both = (total_pos > 0) & (total_neg > 0)
    return ranked.agg(
        F.when(both, F.try_divide(roc, total_pos * total_neg)).alias("auc_roc"),
        F.when(both, F.try_divide(pr, total_pos)).alias("auc_pr"),
    )


def _running(points: DataFrame, window) -> DataFrame:
    return points.withColumns({f"{c}_upto": F.sum(c).over(window) for c in ("pos", "neg")})


def _ranked_in_ranges(points: DataFrame, score_ranges: int) -> DataFrame:
    ranges = QuantileDiscretizer(
        inputCol="score", outputCol="range", numBuckets=score_ranges, relativeError=0.5 / score_ranges
    ).fit(points)
    placed = ranges.transform(points)
    totals = placed.groupBy("range").agg(*(F.sum(c).alias(f"{c}_upto") for c in ("pos", "neg")))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    # At most ``score_ranges`` rows.
    offsets = totals.select(
        "range", *(F.coalesce(F.sum(f"{c}_upto").over(above), F.lit(0)).alias(f"{c}_above") for c in ("pos", "neg"))
    )
    within = _running(placed, Window.partitionBy("range").orderBy(F.desc("score")))
    return within.join(F.broadcast(offsets), "range").withColumns(
        {f"{c}_upto": F.col(f"{c}_upto") + F.col(f"{c}_above") for c in ("pos", "neg")}
    )


def evaluate(counts: DataFrame, positive: float | None = None, score_ranges: int | None = None) -> DataFrame:
    """One row: both areas and the four class metrics, of one class if ``positive`` is given.

    The tally is held while all of them read it, and let go; the row is computed at once.
    """
    with kept(counts):
        areas = curve_areas(counts, score_ranges).first().asDict()
        summary = classification_metrics(counts) if positive is None else class_metrics(counts, positive)
        values = {**areas, **summary.first().asDict()}
    return counts.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"{name} double" for name in values))


def preview(df: DataFrame, n: int, key: str, *columns: str) -> DataFrame:
    """The first ``n`` rows by key: a bounded top-k."""
    return df.orderBy(key).limit(n).select(key, *columns)
