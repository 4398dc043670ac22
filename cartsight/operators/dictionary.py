"""Label dictionaries as tables: any number of labels, none of them on the driver."""

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartsight.schema import CATEGORICAL
from cartsight.storage import cut_lineage


def dictionaries(train: DataFrame, columns: Sequence[str] = CATEGORICAL) -> dict[str, DataFrame]:
    """For each column ``label, n, index`` of its labels: the most frequent has index 0, equally frequent ones follow the alphabet.

    One pass counts the labels of all columns.  They are sorted in ranges; a
    label's index is its place in its range after the sizes of the column's
    ranges before, so that no task holds all labels.  Nulls have no entry.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns))).alias("pair")
    counts = train.select(pairs).select("pair.*").where("label is not null").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange("column", F.desc("n"), "label").withColumn("range", F.spark_partition_id())
    ranged = cut_lineage(ranged, "labels")
    sizes = ranged.groupBy("column", "range").agg(F.count(F.lit(1)).alias("size"))  # a row per column and range
    before = sizes.select("column", "range", (F.sum("size").over(Window.partitionBy("column").orderBy("range")) - F.col("size")).alias("before"))
    place = F.row_number().over(Window.partitionBy("column", "range").orderBy(F.desc("n"), "label")) - 1
    placed = ranged.withColumn("place", place).join(before, ["column", "range"])
    table = cut_lineage(placed.select("column", "label", "n", (F.col("before") + F.col("place")).alias("index")), "dictionary")
    return {c: table.where(F.col("column") == c).drop("column") for c in columns}


def label_dictionary(train: DataFrame, column: str) -> DataFrame:
    return dictionaries(train, [column])[column]


def sizes(known: dict[str, DataFrame]) -> dict[str, int]:
    return {c: table.count() for c, table in known.items()}


def index_labels(df: DataFrame, known: dict[str, DataFrame], suffix: str = "_index") -> DataFrame:
    """Add ``<column>_index`` as a double; a null, or a label that is not in the dictionary, gets the next index after the last."""
    for column, size in sizes(known).items():
        entries = known[column].select(F.col("label").alias("_label"), F.col("index").cast("double").alias("_index"))
        df = df.join(entries, F.col(column).cast("string") == F.col("_label"), "left")
        df = df.withColumn(f"{column}{suffix}", F.coalesce("_index", F.lit(float(size)))).drop("_label", "_index")
    return df


def encode_labels(df: DataFrame, known: dict[str, DataFrame], suffix: str = "_encoded") -> DataFrame:
    """Add ``<column>_encoded``: a sparse vector with one slot per label, all zeros for a null or unknown label.

    A slot's position is the label's index; the vector holds no more than that.
    """
    counts = sizes(known)
    df = index_labels(df, known, "_place")
    nominal = {f"{c}_place": F.col(f"{c}_place").alias(f"{c}_place", metadata={"ml_attr": {"type": "nominal", "num_vals": n + 1}}) for c, n in counts.items()}
    df = df.withColumns(nominal)
    encoder = OneHotEncoder(inputCols=[f"{c}_place" for c in known], outputCols=[f"{c}{suffix}" for c in known])
    return encoder.fit(df.limit(0)).transform(df).drop(*(f"{c}_place" for c in known))
