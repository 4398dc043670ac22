"""Node tables: scores by paths equal the learner's own."""

import pytest
from pyspark.sql import functions as F

from cartsight.operators import features, models, nodes
from cartsight.operators.split import split_train_test
from cartsight.schema import BATCH_NUMERIC, KEY, LABEL
from cartsight.sources import shop_sessions


@pytest.fixture(scope="module")
def rows(spark):
    return features.model_features(shop_sessions(spark, "/root/testdata/sf0.001")).cache()


def test_scores_equal_the_model(rows):
    train, test = split_train_test(rows)
    model = models.fit_tree(train)
    table = nodes.tree_nodes(model)
    scored = model.transform(test)
    expected = scored.select(KEY, "prediction", models.leaf_score().alias("score")).collect()
    got = nodes.score_by_nodes(table, scored.drop("prediction", "probability", "rawPrediction")).select(KEY, "prediction", "score").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected)) and len(got) == test.count()


def test_table_describes_the_tree(rows):
    train, _ = split_train_test(rows)
    model = models.fit_tree(train)
    learner = model.stages[-1]
    table = {r["path"]: r for r in nodes.tree_nodes(model).collect()}
    assert len(table) == learner.numNodes and max(map(len, table)) == learner.depth
    assert table[""]["n"] == train.count() and table[""]["n_positive"] == train.where(F.col(LABEL) == 1).count()
    for path, r in table.items():
        inner = r["left"] is not None
        assert inner == (r["feature"] is not None) == (r["gain"] is not None) == (path + "L" in table) == (path + "R" in table)
        if inner:
            left, right = table[path + "L"], table[path + "R"]
            assert r["n"] == left["n"] + right["n"] and r["n_positive"] == left["n_positive"] + right["n_positive"]
            assert (r["threshold"] is None) != (r["left_values"] is None)
        assert r["prediction"] == float(2 * r["n_positive"] > r["n"])
    assert {r["feature"] for r in table.values()} - {None} <= set(nodes.feature_names(model))


def test_root_alone(rows):
    model = nodes.fit_numeric_tree(rows, BATCH_NUMERIC, maxDepth=0)
    (only,) = nodes.tree_nodes(model).collect()
    assert only["path"] == "" and only["left"] is None and only["n"] == rows.count()


def test_too_deep_for_one_condition(rows, monkeypatch):
    monkeypatch.setattr(nodes, "DEEPEST", 1)
    table = nodes.tree_nodes(models.fit_tree(rows))
    with pytest.raises(ValueError, match="deep"):
        nodes.leaf_of(table)


def test_grid_without_categories(rows):
    small = nodes.few_valued(shop_sessions(rows.sparkSession, "/root/testdata/sf0.001"))
    results = models.cross_validate(small, {"maxDepth": (0, 2)}, folds=2, numeric=nodes.FEW_VALUED, categorical=())
    assert [point["maxDepth"] for point, _ in results] == [0, 2] and all(0.5 < accuracy <= 1 for _, accuracy in results)
