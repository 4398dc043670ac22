import os
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cartsight.operators import metrics


def scored(spark, rows):
    df = spark.createDataFrame([(float(s), int(y)) for s, y in rows], "score DOUBLE, label INT")
    return df.withColumn("prediction", (F.col("score") > 0.5).cast("double"))


def areas(spark, rows, **options):
    row = metrics.curve_areas(metrics.tally(scored(spark, rows)), **options).first()
    return row["auc_roc"], row["auc_pr"]


def by_evaluator(spark, rows):
    df = scored(spark, rows).withColumn("label", F.col("label").cast("double"))
    return tuple(
        BinaryClassificationEvaluator(rawPredictionCol="score", metricName=name, numBins=0).evaluate(df)
        for name in ("areaUnderROC", "areaUnderPR")
    )


def sample(n, digits, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        label = rng.random() < 0.3
        rows.append((round(min(1, max(0, rng.gauss(0.55 if label else 0.45, 0.2))), digits), label))
    return rows


CASES = {
    "rounded": sample(400, 1, 1),
    "unrounded": sample(400, 12, 2),
    "ties across labels": [(0.5, 0), (0.5, 1), (0.2, 0), (0.2, 1), (0.9, 1)],
    "constant": [(0.4, i % 3 == 0) for i in range(30)],
    "perfect": [(0.9, 1), (0.8, 1), (0.1, 0)],
    "hot score": [(0.7, i % 2) for i in range(200)] + [(0.1, 0), (0.8, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_areas_equal_the_evaluator(spark, case):
    rows = CASES[case]
    expected = by_evaluator(spark, rows)
    assert areas(spark, rows) == pytest.approx(expected, abs=1e-12)
    for ranges in (1, 4, 64):
        assert areas(spark, rows, score_ranges=ranges) == pytest.approx(expected, abs=1e-12)


def test_roc_area_by_pairs(spark):
    rows = CASES["rounded"]
    pos, neg = ([s for s, y in rows if bool(y) is want] for want in (True, False))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert areas(spark, rows)[0] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_areas_ignore_a_monotone_transform(spark):
    rows = CASES["unrounded"]
    assert areas(spark, [(s**3 * 50 - 7, y) for s, y in rows]) == pytest.approx(areas(spark, rows), abs=1e-12)


@pytest.mark.parametrize("label", [0, 1])
def test_areas_need_two_classes(spark, label):
    assert areas(spark, [(0.3, label), (0.8, label)]) == (None, None)


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_rows_that_cannot_be_ranked_are_left_out(spark, ranges):
    rows = CASES["unrounded"]
    odd = [(float("nan"), 1), (float("nan"), 0), (None, 1), (None, 0), (0.5, None), (0.9, None)]
    df = spark.createDataFrame([(s if s is None else float(s), y if y is None else int(y)) for s, y in rows + odd], "score DOUBLE, label INT")
    df = df.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    counts = metrics.tally(df)
    got = metrics.curve_areas(counts, score_ranges=ranges).first()
    assert tuple(got) == pytest.approx(by_evaluator(spark, rows), abs=1e-12)
    known = metrics.tally(df.where("label IS NOT NULL AND score IS NOT NULL"))
    assert metrics.class_metrics(counts).first() == metrics.class_metrics(known).first()


def test_evaluation_leaves_no_folder(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    for _ in range(3):
        metrics.evaluate(metrics.tally(scored(spark, CASES["rounded"])))
    assert set(os.listdir(base)) == before


def test_class_metrics(spark):
    rows = CASES["unrounded"]
    df = scored(spark, rows).withColumn("label", F.col("label").cast("double"))
    counts = metrics.tally(df)
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    got = metrics.classification_metrics(counts).first()
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-12)
    got = metrics.class_metrics(counts).first()
    for ours, theirs in {"precision": "precisionByLabel", "recall": "recallByLabel", "f1": "fMeasureByLabel"}.items():
        evaluator = MulticlassClassificationEvaluator(metricName=theirs, metricLabel=1.0)
        assert got[ours] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_class_never_predicted_scores_zero(spark):
    counts = metrics.tally(scored(spark, [(0.1, 1), (0.2, 0), (0.3, 0)]))
    assert tuple(metrics.class_metrics(counts).first())[1:] == (0.0, 0.0, 0.0)


def test_confusion_matrix_and_preview(spark):
    df = scored(spark, [(0.1, 0), (0.9, 0), (0.8, 1), (0.7, 1)]).withColumn("id", F.col("score") * 10)
    found = [tuple(r) for r in metrics.confusion_matrix(df).collect()]
    assert found == [(0, 0.0, 1), (0, 1.0, 1), (1, 1.0, 2)]
    assert [r["score"] for r in metrics.preview(df, 2, "id", "score").collect()] == [0.1, 0.7]


def test_evaluate_joins_both(spark):
    row = metrics.evaluate(metrics.tally(scored(spark, CASES["rounded"])), positive=1.0).first()
    assert row["auc_roc"] == pytest.approx(areas(spark, CASES["rounded"])[0])
    assert set(row.asDict()) == {"auc_roc", "auc_pr", "accuracy", "precision", "recall", "f1"}
