"""A fitted tree as a table of nodes, and rows scored by the paths to its leaves."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.operators.encode import encoding_stages, labelled, slot_names
from cartsight.operators.features import model_features
from cartsight.operators.models import tree
from cartsight.schema import BATCH_NUMERIC, CATEGORICAL, KEY, LABEL, PAGE_GROUPS
from cartsight.storage import kept, shared_path

# A depth of nodes is at most 2 ** depth rows, and depth is bounded by the learner (30): trees of this depth stay one expression.
DEEPEST = 12
# Numbers with few values, so that every split of a small tree can be listed.
BANDS = {"PageValues_Band": ("PageValues", 5.0), "BounceRates_Band": ("BounceRates", 0.02), "ExitRates_Band": ("ExitRates", 0.02)}
PAGES = "Pages"
FEW_VALUED = (PAGES, *BANDS, "Month_Number", "Is_Special_Date", "Weekend")


def few_valued(sessions: DataFrame) -> DataFrame:
    """Key, label and the ``FEW_VALUED`` numbers: pages in all, how often a fixed width fits into a number, month and flags."""
    pages = sessions.withColumn(PAGES, sum(F.col(group) for group in PAGE_GROUPS))
    bands = {name: F.floor(F.round(F.col(c) / width, 9)).cast("int") for name, (c, width) in BANDS.items()}
    return model_features(pages, (KEY, PAGES)).withColumns(bands).select(KEY, LABEL, *FEW_VALUED)


def numeric_tree(columns: Sequence[str] = FEW_VALUED, **settings: int) -> Pipeline:
    """A tree over numbers alone."""
    return Pipeline(stages=[*encoding_stages(columns, (), scale=False), tree(**settings)])


def fit_numeric_tree(train: DataFrame, columns: Sequence[str] = FEW_VALUED, **settings: int) -> PipelineModel:
    train = labelled(train).select(LABEL, *columns)
    with kept(train):
        return numeric_tree(columns, **settings).fit(train)


def feature_names(model: PipelineModel, numeric: Sequence[str] = BATCH_NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> list[str]:
    """Names of the slots that the tree at the end of ``model`` splits on."""
    if isinstance(model.stages[0], StringIndexerModel):
        return slot_names(model, numeric, categorical)
    return list(model.stages[0].getInputCols())


def tree_nodes(model: PipelineModel, names: Sequence[str] | None = None) -> DataFrame:
    """One row per node of the tree at the end of ``model``, read back from its saved form.

    ``node`` counts from the root (0) down the left side first; ``path`` spells
    the way to it in L and R.  An inner node sends rows left whose ``feature``
    is at most ``threshold`` or, for a category, among ``left_values``.  ``n``
    and ``n_positive`` are the training rows of the node, ``gain`` the impurity
    that its split removes.
    """
    learner: DecisionTreeClassificationModel = model.stages[-1]
    spark = SparkSession.getActiveSession()
    names = list(names or feature_names(model))
    path = shared_path(spark, "tree-nodes")
    learner.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    inner = F.col("leftChild") >= 0
    categories = F.col("split.numCategories") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    nodes = saved.select(
        F.col("id").alias("node"),
        F.when(inner, F.get(F.array(*map(F.lit, names)), F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.col("split.featureIndex")).alias("slot"),
        F.when(inner & ~categories, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & categories, values).alias("left_values"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("gain")).alias("gain"), "prediction",
        F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b).cast("bigint").alias("n"),
        F.get("impurityStats", F.lit(1)).cast("bigint").alias("n_positive"),
    )
    return _with_paths(nodes, learner.depth)


def _with_paths(nodes: DataFrame, depth: int) -> DataFrame:
    """Add ``path``, level by level: as many joins as the tree is deep, of a table of nodes."""
    level = nodes.where("node = 0").select(F.col("node").alias("at"), F.lit("").alias("path"), "left", "right")
    found = level
    for _ in range(depth):
        steps = F.explode(F.array(*(F.struct(F.col(side).alias("at"), F.concat("path", F.lit(letter)).alias("path")) for side, letter in (("left", "L"), ("right", "R")))))
        children = level.where("left is not null").select(steps.alias("step")).select("step.*")
        level = children.join(nodes.select(F.col("node").alias("at"), "left", "right"), "at").select("at", "path", "left", "right")
        found = found.unionByName(level)
    return nodes.join(found.select(F.col("at").alias("node"), "path"), "node")


def leaf_of(nodes: DataFrame, vector: str = "features") -> Column:
    """The leaf that a row falls into, as one nested condition: no join, no Python."""
    rows = {r["node"]: r for r in nodes.collect()}
    deepest = max(len(r["path"]) for r in rows.values())
    if deepest > DEEPEST:
        raise ValueError(f"the tree is {deepest} deep; one condition holds {DEEPEST} levels")
    values = vector_to_array(vector)

    def place(node: int) -> Column:
        r = rows[node]
        if r["left"] is None:
            return F.lit(node)
        value = F.get(values, F.lit(r["slot"]))
        goes_left = value.isin(r["left_values"]) if r["threshold"] is None else value <= r["threshold"]
        return F.when(goes_left, place(r["left"])).otherwise(place(r["right"]))

    return place(0)


def score_by_nodes(nodes: DataFrame, encoded: DataFrame, vector: str = "features") -> DataFrame:
    """Add ``leaf``, ``prediction``, ``probability`` and ``score`` (rows of class 1 in the leaf) to rows that hold the feature vector."""
    leaves = nodes.where("left is null").select(
        F.col("node").alias("leaf"), "prediction", (F.col("n_positive") / F.col("n")).alias("probability"), F.col("n_positive").cast("double").alias("score")
    )
    return encoded.withColumn("leaf", leaf_of(nodes, vector)).join(F.broadcast(leaves), "leaf")  # at most 2 ** DEEPEST leaves
