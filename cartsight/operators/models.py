"""Decision trees: training, scoring, tuning and comparison by slice."""

from collections.abc import Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.operators.encode import check_labels, encoding_stages, labelled, stream_encoding
from cartsight.operators.metrics import evaluate, tally
from cartsight.operators.split import split_train_test, with_fold
from cartsight.schema import BATCH_NUMERIC, CATEGORICAL, KEY, LABEL, STREAM_NUMERIC
from cartsight.sources.files import SLICE
from cartsight.storage import kept, shared_path

# Tree settings of the three uses.
BATCH_TREE = {"maxDepth": 10, "minInstancesPerNode": 20}
STREAM_TREE = {"maxDepth": 4, "minInstancesPerNode": 10}
GRID = {"maxDepth": (3, 5, 10), "maxBins": (32, 64)}
FOLDS = 5
SEED = 42
PARALLELISM = 4
# Each fold under way holds its encoded rows, and each growing tree its binned ones: one at a time is the choice for large data.
FOLDS_AT_ONCE = 1


def tree(seed: int = SEED, **settings: int) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, seed=seed, **settings)


def batch_tree() -> Pipeline:
    return tree_with(**BATCH_TREE)


def stream_tree() -> Pipeline:
    return Pipeline(stages=[*stream_encoding().getStages(), tree(**STREAM_TREE)])


def learned(df: DataFrame, numeric: Sequence[str] = BATCH_NUMERIC, *more: str) -> DataFrame:
    """What a tree learns from: the label, its numbers and categories, and ``more``."""
    return labelled(df).select(LABEL, *more, *numeric, *CATEGORICAL)


def fit_tree(
    train: DataFrame, estimator: Pipeline | None = None, numeric: Sequence[str] = BATCH_NUMERIC, hold: bool = True
) -> PipelineModel:
    """Fit on ``train``, which is read several times: it is held meanwhile, unless the caller holds it already."""
    train = learned(train, numeric)
    with kept(*[train] * hold):
        check_labels(train)
        return (estimator or batch_tree()).fit(train)


def leaf_score() -> Column:
    """The score that ranks tree predictions: rows of class 1 in the leaf, not their share."""
    return F.get(vector_to_array("rawPrediction"), F.lit(1))


def tree_tally(predictions: DataFrame) -> DataFrame:
    return tally(predictions, LABEL, leaf_score(), "prediction")


def evaluate_tree(predictions: DataFrame) -> DataFrame:
    return evaluate(tree_tally(predictions))


def tree_predictions(features: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Scores of the held-out rows by a tree trained on the others."""
    train, test = split_train_test(features)
    scored = fit_tree(train).transform(test)
    probability = vector_to_array("probability")
    return scored.select(
        *keys, LABEL, "prediction",
        F.get(probability, F.lit(1)).alias("probability"), leaf_score().alias("score"),
    )


def compare_slices(features: DataFrame) -> DataFrame:
    """Test metrics of a tree per slice and of one over all slices, one row per scope."""
    scopes = {"slice_1": F.col(SLICE) == 1, "slice_2": F.col(SLICE) == 2, "pooled": F.lit(True)}

    def measured(scope: str, chosen: Column) -> DataFrame:
        train, test = split_train_test(features.where(chosen).drop(SLICE))
        metrics = evaluate_tree(fit_tree(train, hold=False).transform(test))
        return metrics.select(F.lit(scope).alias("scope"), "*")

    features = features.select(KEY, SLICE, LABEL, *BATCH_NUMERIC, *CATEGORICAL)
    with kept(features), ThreadPool(len(scopes)) as pool:
        return reduce(DataFrame.unionByName, pool.starmap(measured, scopes.items()))


def grid_points(grid: dict[str, Sequence[int]] = GRID) -> list[dict[str, int]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _by_depth(points: list[dict[str, int]]) -> list[list[int]]:
    """The numbers of the points that differ in their depth alone, together."""
    alike: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        alike.setdefault(tuple(sorted((k, v) for k, v in point.items() if k != "maxDepth")), []).append(i)
    return list(alike.values())


def _cut_predictions(spark: SparkSession, model: DecisionTreeClassificationModel, depths: Sequence[int]) -> list[list[float]]:
    """For each of ``depths``, what the tree cut there predicts in each of its leaves, left to right.

    A tree is grown level by level, and a node's split does not depend on how
    deep the tree may become: the smaller tree is the top of the larger one.
    Read back from the saved form: as many rows as the tree has nodes.
    """
    path = shared_path(spark, "tree-cuts")
    model.write().save(path)
    saved = spark.read.schema("id INT, prediction DOUBLE, leftChild INT, rightChild INT").parquet(f"{path}/data")
    nodes = {r["id"]: r for r in saved.collect()}
    found: list[list[float]] = [[] for _ in depths]

    def down(node: int, above: list[float]) -> None:
        r = nodes[node]
        way = [*above, r["prediction"]]
        if r["leftChild"] < 0:
            for values, depth in zip(found, depths):
                values.append(way[min(depth, len(way) - 1)])
        else:
            down(r["leftChild"], way)
            down(r["rightChild"], way)

    down(0, [])
    return found


def _fold_accuracies(folded: DataFrame, fold: int, points: list[dict[str, int]], pool: ThreadPool, encoding: Pipeline) -> list[float]:
    """Accuracy on one fold of a tree per grid point, grown on the other folds.

    The encoders are fitted once for all points.  Of points that differ in
    their depth alone the deepest tree is grown, and the others are its tops.
    One pass scores every tree.
    """
    seen, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
    encoding = encoding.fit(seen)
    encoded, scored = (encoding.transform(part).select(LABEL, "features") for part in (seen, held))

    def grown(alike: list[int]) -> tuple[DecisionTreeClassificationModel, list[list[float]]]:
        depths = [points[i].get("maxDepth", 0) for i in alike]
        fitted = tree(**points[alike[depths.index(max(depths))]]).fit(encoded)
        return fitted, _cut_predictions(encoded.sparkSession, fitted, depths) if len(alike) > 1 else []

    groups = _by_depth(points)
    with kept(encoded):
        trees = pool.map(grown, groups, chunksize=1)
    hits: list[Column | None] = [None] * len(points)
    for g, (alike, (fitted, cuts)) in enumerate(zip(groups, trees)):
        scored = fitted.setPredictionCol(f"p{g}").setLeafCol(f"leaf{g}" if cuts else "").setRawPredictionCol("").setProbabilityCol("").transform(scored)
        for k, i in enumerate(alike):
            guess = F.get(F.expr(f"array({', '.join(f'{value}D' for value in cuts[k])})"), F.col(f"leaf{g}").cast("int")) if cuts else F.col(f"p{g}")
            hits[i] = F.avg((guess == F.col(LABEL)).cast("double")).alias(f"h{i}")
    return list(scored.agg(*hits).first())


def cross_validate(
    train: DataFrame, grid: dict[str, Sequence[int]] = GRID, folds: int = FOLDS,
    parallelism: int = PARALLELISM, folds_at_once: int = FOLDS_AT_ONCE, key: str = KEY,
    numeric: Sequence[str] = BATCH_NUMERIC, categorical: Sequence[str] = CATEGORICAL, hold: bool = True,
) -> list[tuple[dict[str, int], float]]:
    """Mean accuracy over the folds for each grid point.

    ``train`` is held meanwhile, unless the caller holds it already.
    ``parallelism`` trees grow at once.  With several ``folds_at_once``, one is
    encoded or scored while the trees of another grow; the encoded rows of each
    are held besides the features.
    """
    points = grid_points(grid)
    encoding = Pipeline(stages=encoding_stages(numeric, categorical, scale=True))
    folded = labelled(with_fold(train, folds, key)).select(LABEL, "fold", *numeric, *categorical)
    with kept(*[folded] * hold), ThreadPool(parallelism) as growing, ThreadPool(folds_at_once) as under_way:
        if categorical:
            check_labels(folded, categorical)
        by_fold = under_way.map(
            lambda fold: _fold_accuracies(folded, fold, points, growing, encoding), range(folds), chunksize=1
        )
    return [(point, sum(scores) / folds) for point, scores in zip(points, zip(*by_fold))]


def best_point(results: list[tuple[dict[str, int], float]]) -> dict[str, int]:
    """The grid point with the highest mean accuracy, the first one on a tie."""
    return max(results, key=lambda result: result[1])[0]


def results_table(spark: SparkSession, results: list[tuple[dict[str, int], float]]) -> DataFrame:
    """One row per grid point: settings, mean accuracy, and whether it is the best."""
    best = best_point(results)
    rows = [
        (i, *point.values(), float(accuracy), point == best)
        for i, (point, accuracy) in enumerate(results, 1)
    ]
    names = [*results[0][0], "avg_accuracy", "best"]
    return spark.createDataFrame(rows, ["configuration", *names])


def grid_results(train: DataFrame, **options) -> DataFrame:
    return results_table(train.sparkSession, cross_validate(train, **options))


def tree_with(**settings: int) -> Pipeline:
    return Pipeline(stages=[*encoding_stages(BATCH_NUMERIC, scale=True), tree(**settings)])


def tuned_tree(train: DataFrame, hold: bool = True, **options) -> tuple[dict[str, int], PipelineModel]:
    """The best settings by cross-validation, and a tree with them fitted on all of ``train``."""
    best = best_point(cross_validate(train, hold=hold, **options))
    return best, fit_tree(train, tree_with(**best), hold=hold)


def best_model_metrics(features: DataFrame, **options) -> DataFrame:
    """Settings of the tuned tree, its quality on the held-out rows, and the four cells of its confusion matrix."""
    asked = (options.get("key", KEY), *options.get("numeric", ()), *options.get("categorical", ()))
    features = features.select(*dict.fromkeys((KEY, LABEL, *BATCH_NUMERIC, *CATEGORICAL, *asked)))
    with kept(features):
        train, test = split_train_test(features)
        best, model = tuned_tree(train, hold=False, **options)
        settings = {**best, "minInstancesPerNode": model.stages[-1].getMinInstancesPerNode()}
        named = (F.lit(value).alias(name) for name, value in settings.items())
        counts = tree_tally(model.transform(test))
        with kept(counts):
            cells = {
                f"label_{label}_as_{guess}": F.coalesce(F.sum(F.when((F.col("label") == label) & (F.col("prediction") == guess), F.col("n"))), F.lit(0))
                for label in (0, 1) for guess in (0, 1)
            }
            found = counts.agg(*(cell.alias(name) for name, cell in cells.items())).first().asDict()
            return evaluate(counts).select(*named, "*", *(F.lit(n).cast("bigint").alias(name) for name, n in found.items()))
