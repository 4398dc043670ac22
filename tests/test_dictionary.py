"""Label dictionaries against the built-in indexer and encoder, and with very many labels."""

import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartsight.operators.dictionary import dictionaries, encode_labels, index_labels, label_dictionary

ROWS = [(1, "b", 1), (2, "a", 1), (3, "b", 2), (4, "c", 2), (5, None, 3), (6, "a", 3), (7, "é", None), (8, "z", 1), (9, "B", 1)]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(ROWS, "id int, x string, y int")


def test_equal_to_the_library(spark, train):
    rows = train.unionByName(spark.createDataFrame([(10, "new", 9)], train.schema))
    indexer = StringIndexer(inputCols=["x", "y"], outputCols=["xi", "yi"], handleInvalid="keep").fit(train)
    expected = indexer.transform(rows)
    encoded = OneHotEncoder(inputCols=["xi", "yi"], outputCols=["xe", "ye"]).fit(expected).transform(expected)
    wanted = encoded.select("id", "xi", "yi", vector_to_array("xe"), vector_to_array("ye")).collect()
    known = dictionaries(train, ["x", "y"])
    got = encode_labels(index_labels(rows, known), known).select("id", "x_index", "y_index", vector_to_array("x_encoded"), vector_to_array("y_encoded")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_very_many_labels(spark):
    rows = spark.range(300_000).select(F.concat(F.lit("label "), F.pmod(F.col("id") * 7919, F.lit(100_003))).alias("x"), F.col("id"))
    table = label_dictionary(rows, "x").collect()
    assert len(table) == 100_003
    ordered = sorted(table, key=lambda r: (-r["n"], r["label"]))
    assert [r["index"] for r in ordered] == list(range(100_003))
    known = dictionaries(rows, ["x"])
    vectors = encode_labels(rows.where("id < 50"), known)
    assert vectors.schema["x_encoded"].dataType.simpleString() == "vector"
    assert {len(r["x_encoded"].indices) for r in vectors.collect()} == {1} and vectors.first()["x_encoded"].size == 100_003


def test_no_labels(spark, train):
    known = dictionaries(train.where("x is null"), ["x"])
    assert known["x"].count() == 0
    assert {r["x_index"] for r in index_labels(train, known).collect()} == {0.0}


def test_clashing_columns(spark, train):
    rows = train.withColumns({c: F.lit(7) for c in ("label", "n", "index", "range", "place")})
    assert index_labels(rows, dictionaries(rows, ["x"])).count() == len(ROWS)
