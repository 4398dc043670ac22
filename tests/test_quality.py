from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartsight.operators import quality
from cartsight.operators.features import batch_features
from cartsight.schema import RATIOS
from cartsight.sources import shop_sessions

COLUMNS = list(quality.STREAM_REQUIRED)
TYPES = [
    "INT" if c in ("Revenue", "Weekend") else "STRING" if c in quality.CATEGORICAL else "DOUBLE" for c in COLUMNS
]
FULL = tuple({"INT": 1, "STRING": "a", "DOUBLE": 0.5}[t] for t in TYPES)


def test_nulls_by_column(spark):
    rows = [(1, None, "a"), (None, None, "b"), (3, 4.0, None), (4, 5.0, "d")]
    df = spark.createDataFrame(rows, "i INT, f DOUBLE, s STRING")
    assert tuple(quality.null_counts(df).first()) == (1, 2, 1)
    assert {tuple(r) for r in quality.null_columns(df).collect()} == {("i", 1), ("f", 2), ("s", 1)}
    assert {tuple(r) for r in quality.null_columns(df.select("i").where("i > 0")).collect()} == set()
    assert quality.rows_with_nulls(df).count() == 3


def test_drop_looks_at_the_listed_columns_only(spark):
    holes = [FULL[:i] + (None,) + FULL[i + 1:] + ("kept",) for i in range(len(FULL))]
    not_a_number = (*FULL[:1], float("nan"), *FULL[2:], "kept")
    schema = ", ".join(f"{c} {t}" for c, t in zip([*COLUMNS, "other"], [*TYPES, "STRING"]))
    df = spark.createDataFrame([*holes, not_a_number, (*FULL, None)], schema)
    assert [tuple(r) for r in quality.drop_null_rows(df).collect()] == [(*FULL, None)]
    assert df.dropna(subset=COLUMNS).count() == 1


def test_fill_changes_ratios_only(spark):
    features = batch_features(shop_sessions(spark, "/root/testdata/sf0.001"))
    filled = quality.fill_null_ratios(features)
    assert filled.schema[RATIOS[0]].dataType == features.schema[RATIOS[0]].dataType
    before, after = quality.null_counts(features).first(), quality.null_counts(filled).first()
    assert all(before[c] > 0 and after[c] == 0 for c in RATIOS)
    df = spark.createDataFrame([(None, None, None, None)], "a FLOAT, b FLOAT, c FLOAT, d FLOAT")
    renamed = df.toDF(*RATIOS, "BounceRates")
    assert tuple(quality.fill_null_ratios(renamed).first()) == (0.0, 0.0, 0.0, None)


def profile(spark, columns):
    names = list(columns)
    rows = [(i, *values) for i, values in enumerate(zip(*columns.values()))]
    df = spark.createDataFrame(rows, "session_id BIGINT, " + ", ".join(f"{n} STRING" for n in names))
    return {r["column_name"]: r for r in quality.profile_columns(df).collect()}


def test_profile_edges(spark):
    found = profile(spark, {
        "exactly_80": ["1"] * 8 + ["a"] * 2,
        "over_80": ["1"] * 9 + ["a"],
        "half": ["1"] * 5 + ["1.5"] * 5,
        "floats": ["1.5", "nan", "inf", "1e5", "-.5", "2.", "1_0.5", "+3.0", "1", "0.1"],
        "blank": [""] * 9 + [None],
        "spaces": [" "] * 10,
        "long": ["abcdefghijklmnop"] * 10,
    })
    kinds = {n: r["main_type"] for n, r in found.items()}
    assert kinds == {
        "exactly_80": "string", "over_80": "integer", "half": "string", "floats": "float",
        "blank": "string", "spaces": "string", "long": "string",
    }
    assert found["blank"]["n_empty"] == 10 and found["spaces"]["n_string"] == 10
    assert found["half"]["sample_values"] == "1, 1, 1"
    assert found["long"]["sample_values"] == ", ".join(["abcdefghijklmnop"] * 3)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["", "1", "-2", "1.5", "x", "nan", " 4 ", None]), min_size=1, max_size=20))
def test_profile_counts_add_up(spark, values):
    row = profile(spark, {"c": values})["c"]
    assert row["n_rows"] == len(values)
    assert row["n_rows"] == sum(row[f"n_{k}"] for k in quality.KINDS)
