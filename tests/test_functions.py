import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartsight import functions as fn


def column(spark, values, expression, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_duration_per_visit(spark):
    rows = [(0, 5.0), (3, 10.0), (None, 1.0), (2, None)]
    df = spark.createDataFrame(rows, "v INT, d DOUBLE")
    strict = [r[0] for r in df.select(fn.duration_per_visit(F.col("v"), F.col("d"))).collect()]
    lenient = [r[0] for r in df.select(fn.lenient_duration_per_visit(F.col("v"), F.col("d"))).collect()]
    assert strict[0] is None and strict[2:] == [None, None]
    assert strict[1] == pytest.approx(10 / 3, rel=1e-6) and strict[1] != 10 / 3  # 32-bit
    assert lenient == [0.0, strict[1], 0.0, 0.0]


CODES = [1, 2, 3, 4, 0, -1, None]


def test_labels(spark):
    os_labels = column(spark, CODES, fn.operating_system_label, "INT")
    assert os_labels == ["OS_1", "OS_2", "OS_3"] + ["OS_Other"] * 4
    assert column(spark, CODES, fn.region_label, "INT") == ["Region_1"] + ["Region_Other"] * 6
    traffic = column(spark, CODES, fn.traffic_label, "INT")
    assert traffic == ["TrafficType_1_3"] * 3 + ["TrafficType_Other"] * 4


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)), min_size=1, max_size=30))
def test_labels_are_total(spark, codes):
    for label, known in [
        (fn.operating_system_label, {"OS_1", "OS_2", "OS_3", "OS_Other"}),
        (fn.region_label, {"Region_1", "Region_Other"}),
        (fn.traffic_label, {"TrafficType_1_3", "TrafficType_Other"}),
    ]:
        assert set(column(spark, codes, label, "INT")) <= known


def test_month_number(spark):
    names = ["Jan", "June", "Jun", "sep", None, "Dec"]
    assert column(spark, names, fn.month_number, "STRING") == [1, 6, None, None, None, 12]
    strict = lambda name: fn.month_number(name, strict=True)
    assert column(spark, ["May"], strict, "STRING") == [5]
    for unknown in ("Jun", None):
        with pytest.raises(PySparkException, match="unknown month"):
            column(spark, [unknown], strict, "STRING")


def test_flags(spark):
    texts = ["True", "true", "TRUE", "False", "", None]
    assert column(spark, texts, fn.text_flag, "STRING") == [1, 0, 0, 0, 0, 0]
    assert column(spark, [0.0, 0.2, None], fn.special_date, "DOUBLE") == [False, True, None]
    assert column(spark, [1, 2, None], lambda x: fn.indicator(x == 1), "INT") == [1.0, 0.0, 0.0]


TEXTS = ["1", " 7 ", "-3", "+4", "1.0", "2.75", "-2.9", "1e3", "x", "", " ", None, "1_000", "12_", "nan",
         "inf", "-Infinity", "0x1F", "99999999999", ".5", "5.", "1,5", "1.2.3"]


def test_lenient_parsing_is_the_cast_that_does_not_fail(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        doubles = column(spark, TEXTS, lambda x: x.cast("double"), "STRING")
        integers = column(spark, TEXTS, lambda x: x.cast("int"), "STRING")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert list(map(repr, column(spark, TEXTS, fn.lenient_double, "STRING"))) == list(map(repr, doubles))
    kept = [i for i, t in enumerate(TEXTS) if t != ".5"]
    parsed = column(spark, TEXTS, fn.lenient_int, "STRING")
    assert [parsed[i] for i in kept] == [integers[i] for i in kept]


def python_parse(kind, text):
    try:
        return kind(text)
    except (TypeError, ValueError):
        return kind(0)


def test_default_parsing_follows_python(spark):
    doubles = column(spark, TEXTS, fn.double_or_default, "STRING")
    for text, got in zip(TEXTS, doubles):
        expected = python_parse(float, text)
        assert got == expected or (math.isnan(got) and math.isnan(expected)), text
    assert column(spark, TEXTS, fn.int_or_default, "STRING") == [python_parse(int, t) for t in TEXTS]


KEYS = [0, 1, 2, 99, 2**31, 2**32 - 1, 2**32, 2**32 + 5, 2**40 + 17, 2**63 - 1, -1, -(2**63)]


@pytest.mark.parametrize("seed", [0, 1, 42])
def test_key_hash(spark, seed):
    expected = [(k % 2**32 + (k >> 32) * 1540483477 + seed) * 2654435761 % 2**32 for k in KEYS]
    assert column(spark, KEYS, lambda k: fn.key_hash(k, seed), "BIGINT") == expected
    folds = column(spark, KEYS, lambda k: fn.bucket(k, 5, seed, skip=100), "BIGINT")
    assert folds == [h // 100 % 5 for h in expected]


def test_logistic_is_finite_far_out(spark):
    df = spark.createDataFrame([(1e9,), (-1e9,), (0.0,)], "x DOUBLE")
    assert [r[0] for r in df.select(fn.logistic(["x"], [1.0])).collect()] == pytest.approx([1.0, 0.0, 0.5])
    with pytest.raises(ValueError):
        fn.logistic(["x"], [1.0, 2.0])
