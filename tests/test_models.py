import statistics

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cartsight.operators import encode, models, split
from cartsight.operators.features import model_features
from cartsight.schema import BATCH_NUMERIC, CATEGORICAL, KEY
from cartsight.sources import shop_sessions


@pytest.fixture(scope="module")
def features(spark):
    rows = model_features(shop_sessions(spark, "/root/testdata/sf0.001")).persist()
    yield rows
    rows.unpersist()


def test_unseen_category_has_no_slot(spark):
    schema = ", ".join(f"{c} STRING" for c in CATEGORICAL)
    train = spark.createDataFrame([("b",) * 4, ("b",) * 4, ("a",) * 4, ("c",) * 4], schema)
    test = spark.createDataFrame([("a",) * 4, ("new",) * 4], schema)
    indexed = encode.string_index(train, test).collect()
    assert [r["Region_index"] for r in indexed] == [1.0, 3.0]
    hot = encode.one_hot(train, test).collect()
    assert [(r["Region_b"], r["Region_a"], r["Region_c"]) for r in hot] == [(0, 1, 0), (0, 0, 0)]


def test_dirty_labels_are_refused(spark, features):
    dirty = features.withColumn("VisitorType", F.concat(F.lit("x"), (F.col(KEY) * 7).cast("string"), F.uuid()))
    many = dirty.unionByName(dirty).unionByName(dirty).unionByName(dirty)
    with pytest.raises(ValueError, match="VisitorType"):
        models.fit_tree(many)
    with pytest.raises(ValueError, match="VisitorType"):
        encode.one_hot(many, many)
    # Indexing alone takes any number of labels.
    dirty = features.withColumn("VisitorType", F.col(KEY).cast("string"))
    indexed = encode.string_index(dirty, dirty, ["VisitorType"])
    assert indexed.select("VisitorType_index").distinct().count() == dirty.count() > encode.LABEL_LIMIT


def test_standardize_uses_the_sample_deviation_of_training_rows(spark, features):
    train, test = split.split_train_test(features)
    column = BATCH_NUMERIC[3]
    values = [r[0] for r in train.select(column).collect()]
    mean, deviation = statistics.fmean(values), statistics.stdev(values)
    got = encode.standardize(train, test).select(KEY, column)
    raw = test.select(KEY, F.col(column).alias("raw"))
    for row in got.join(raw, KEY).collect():
        assert row[column] == pytest.approx((row["raw"] - mean) / deviation, abs=1e-9)


def test_tree_areas_rank_by_leaf_count_like_the_evaluator(features):
    train, test = split.split_train_test(features)
    scored = models.fit_tree(train).transform(test)
    ours = models.evaluate_tree(scored).first()
    for name, metric in {"auc_roc": "areaUnderROC", "auc_pr": "areaUnderPR"}.items():
        evaluator = BinaryClassificationEvaluator(labelCol="Revenue", metricName=metric, numBins=0)
        assert ours[name] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


def test_tree_settings_and_repeatability(features):
    model = models.fit_tree(features).stages[-1]
    assert (model.getMaxDepth(), model.getMinInstancesPerNode()) == (10, 20)
    nodes = lambda tree: tree.toDebugString.split("\n", 1)[1]  # the first line names the object
    assert nodes(models.fit_tree(features).stages[-1]) == nodes(model)
    stream = models.stream_tree().getStages()[-1]
    assert (stream.getMaxDepth(), stream.getMinInstancesPerNode()) == (4, 10)


def test_grid(features):
    train, _ = split.split_train_test(features)
    grid = {"maxDepth": (2, 3), "maxBins": (32,)}
    rows = models.grid_results(train, grid=grid, folds=2).collect()
    assert [(r["configuration"], r["maxDepth"], r["maxBins"]) for r in rows] == [(1, 2, 32), (2, 3, 32)]
    assert sum(r["best"] for r in rows) == 1
    assert max(rows, key=lambda r: r["avg_accuracy"])["best"]
    assert len(models.grid_points()) == 6


def test_one_fold_by_hand(spark, features):
    train, _ = split.split_train_test(features)
    folded = split.with_fold(train, 2)
    expected = []
    for fold in range(2):
        seen, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        pipeline = models.Pipeline(stages=[*encode.encoding_stages(BATCH_NUMERIC), models.tree(maxDepth=2)])
        scored = models.fit_tree(seen, pipeline).transform(held)
        expected.append(scored.agg(F.avg((F.col("prediction") == F.col("Revenue")).cast("int"))).first()[0])
    (_, accuracy), = models.cross_validate(train, {"maxDepth": (2,)}, folds=2)
    assert accuracy == pytest.approx(statistics.fmean(expected), abs=1e-12)


def test_slices_and_tuned_model(spark, features):
    halves = model_features(split.split_exact_halves(shop_sessions(spark, "/root/testdata/sf0.001")))
    rows = models.compare_slices(halves).collect()
    assert {r["scope"] for r in rows} == {"slice_1", "slice_2", "pooled"}
    assert all(0 <= r["accuracy"] <= 1 for r in rows)
    best = models.best_model_metrics(features, grid={"maxDepth": (3,), "maxBins": (32,)}, folds=2).first()
    assert (best["maxDepth"], best["maxBins"]) == (3, 32)
    assert not spark.sparkContext._jsc.getPersistentRDDs().size() > 1  # the fixture alone stays


def test_depths_of_a_grid_are_read_from_one_tree(features, monkeypatch):
    """Points that differ in their depth alone grow one tree a fold, and get what trees of their own would give."""
    train, _ = split.split_train_test(features)
    alone = [models.cross_validate(train, {"maxDepth": (depth,), "maxBins": (bins,)}, folds=2)[0][1] for depth in (1, 3, 8) for bins in (8, 32)]
    grown, tree = [], models.tree
    monkeypatch.setattr(models, "tree", lambda **settings: grown.append(settings) or tree(**settings))
    together = models.cross_validate(train, {"maxDepth": (1, 3, 8), "maxBins": (8, 32)}, folds=2)
    assert [accuracy for _, accuracy in together] == alone
    assert [point["maxDepth"] for point, _ in together] == [1, 1, 3, 3, 8, 8]
    assert sorted((s["maxDepth"], s["maxBins"]) for s in grown) == [(8, 8), (8, 8), (8, 32), (8, 32)]


def test_tuned_model_computes_its_features_once(spark, features):
    rows, seen = features.count(), spark.sparkContext.accumulator(0)

    def counted(label):
        seen.add(1)
        return label

    traced = features.withColumn("VisitorType", F.udf(counted, "string")("VisitorType"))
    models.best_model_metrics(traced, grid={"maxDepth": (2, 3), "maxBins": (32,)}, folds=2).first()
    assert rows <= seen.value < 2 * rows
