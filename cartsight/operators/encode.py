"""Fitted feature transformers: indexing, one-hot, scaling, assembly."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.operators.dictionary import dictionaries, encode_labels, index_labels
from cartsight.schema import BATCH_NUMERIC, CATEGORICAL, LABEL, STREAM_NUMERIC
from cartsight.storage import kept


# Labels that a category may have where each becomes a column or a slot that a tree splits on: they are collected.
LABEL_LIMIT = 1000


def check_labels(train: DataFrame, columns: Sequence[str] = CATEGORICAL, limit: int = LABEL_LIMIT) -> None:
    """Raise, naming the column, where a category has more labels than ``limit``: dirty lines, not categories."""
    found = train.agg(*(F.approx_count_distinct(c, 0.02).alias(c) for c in columns)).first()
    for column in columns:
        if found[column] > limit:
            raise ValueError(f"{column} has about {found[column]} labels, more than {limit}; clean it before training")


def _index(column: str) -> str:
    return f"{column}_index"


def _encoded(column: str) -> str:
    return f"{column}_encoded"


def indexer(columns: Sequence[str] = CATEGORICAL) -> StringIndexer:
    """Most frequent label first; a label not seen in training gets the extra last index.

    One stage for all columns, so that fitting reads the data once.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=[_index(c) for c in columns], handleInvalid="keep"
    )


def encoder(columns: Sequence[str] = CATEGORICAL) -> OneHotEncoder:
    """One slot per known label; an unseen label is all zeros."""
    return OneHotEncoder(
        inputCols=[_index(c) for c in columns], outputCols=[_encoded(c) for c in columns]
    )


def encoding_stages(
    numeric: Sequence[str], categorical: Sequence[str] = CATEGORICAL, scale: bool = True
) -> list:
    """Index, encode, assemble, optionally standardize, and assemble into ``features``; without categories only the numbers."""
    numbers = "numeric_features"
    stages = [indexer(categorical), encoder(categorical)] if categorical else []
    stages.append(VectorAssembler(inputCols=list(numeric), outputCol=numbers))
    if scale:
        numbers = "scaled_numeric_features"
        stages.append(
            StandardScaler(inputCol="numeric_features", outputCol=numbers, withMean=True, withStd=True)
        )
    parts = [numbers, *(_encoded(c) for c in categorical)]
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def batch_encoding() -> Pipeline:
    return Pipeline(stages=encoding_stages(BATCH_NUMERIC, scale=True))


def stream_encoding() -> Pipeline:
    return Pipeline(stages=encoding_stages(STREAM_NUMERIC, scale=False))


def labelled(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Declare the label binary, so that no learner has to scan for the class count."""
    binary = {"ml_attr": {"type": "nominal", "name": label, "vals": ["0", "1"]}}
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=binary))


def string_index(train: DataFrame, df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Add ``<column>_index``, learned from ``train``, for any number of labels."""
    return index_labels(df, dictionaries(train.select(*columns), columns))


def one_hot_slots(train: DataFrame, df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Add ``<column>_encoded``, a sparse 0/1 vector learned from ``train``, for any number of labels."""
    return encode_labels(df, dictionaries(train.select(*columns), columns))


def one_hot(train: DataFrame, df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Add one 0/1 column ``<column>_<label>`` per label known from ``train``."""
    check_labels(train, columns)
    index = indexer(columns).fit(train)
    indexed = index.transform(df)
    # The encoder learns only the number of labels, which the indexer's output declares.
    slots = encoder(columns).fit(indexed.limit(0)).transform(indexed)
    arrays = {c: vector_to_array(_encoded(c)) for c in columns}
    flags = {
        f"{c}_{label}": F.get(arrays[c], F.lit(i)).cast("int")
        for c, labels in zip(columns, index.labelsArray)
        for i, label in enumerate(labels)
    }
    return slots.withColumns(flags).drop(*map(_index, columns), *map(_encoded, columns))


def standardize(train: DataFrame, df: DataFrame, columns: Sequence[str] = BATCH_NUMERIC) -> DataFrame:
    """Replace each column by its distance from the training mean in training standard deviations."""
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="numeric_features"),
        StandardScaler(
            inputCol="numeric_features", outputCol="scaled_numeric_features", withMean=True, withStd=True
        ),
    ]
    scaled = Pipeline(stages=stages).fit(train).transform(df)
    values = vector_to_array("scaled_numeric_features")
    return scaled.withColumns({c: F.get(values, F.lit(i)) for i, c in enumerate(columns)}).drop(
        "numeric_features", "scaled_numeric_features"
    )


def slot_names(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str] = CATEGORICAL):
    """Names of the slots of ``features``, in order."""
    labels: Transformer = model.stages[0]
    encoded = zip(categorical, labels.labelsArray)
    return [*numeric, *(f"{c}_{label}" for c, known in encoded for label in known)]


def assemble_features(train: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every slot of the batch feature vector as a column of its own."""
    train = train.select(*BATCH_NUMERIC, *CATEGORICAL)
    with kept(train):
        check_labels(train)
        model = batch_encoding().fit(train)
    values = vector_to_array("features")
    names = slot_names(model, BATCH_NUMERIC)
    return model.transform(df).select(
        *keys, *(F.get(values, F.lit(i)).alias(name) for i, name in enumerate(names))
    )
