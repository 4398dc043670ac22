"""Null reports, cleaning and the column profile."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.functions import FLOAT_TEXT, INTEGER_TEXT
from cartsight.schema import CATEGORICAL, KEY, LABEL, RATIOS, STREAM_NUMERIC

# Columns a micro-batch row must have, the type majority and the number of samples.
STREAM_REQUIRED = (LABEL, *STREAM_NUMERIC, *CATEGORICAL, "Weekend")
KINDS = ("integer", "float", "string", "empty")
MAJORITY = 0.8
SAMPLES = 3


def any_null(columns: list[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.where(any_null(df.columns))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the null count of every column, from one pass."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))


def null_columns(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for the columns that have nulls."""
    counted = null_counts(df).unpivot([], df.columns, "column_name", "null_count")
    return counted.where("null_count > 0")


def missing(df: DataFrame, columns: tuple[str, ...] = STREAM_REQUIRED) -> Column:
    """True where a listed column is null or not a number.

    Columns that cannot be either are left out, so that the condition stays small
    when it is pushed down through the expressions that make the columns.
    """
    tests = []
    for field in (df.schema[c] for c in columns):
        fractional = isinstance(field.dataType, (T.FloatType, T.DoubleType))
        if fractional:
            tests.append(F.isnan(field.name))
        if field.nullable:
            tests.append(F.col(field.name).isNull())
    return reduce(or_, tests, F.lit(False))


def drop_null_rows(df: DataFrame, columns: tuple[str, ...] = STREAM_REQUIRED) -> DataFrame:
    return df.where(~missing(df, columns))


def fill_null_ratios(df: DataFrame, columns: tuple[str, ...] = RATIOS) -> DataFrame:
    """0 for null in the ratio columns only; they stay 32-bit."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0).cast("float")) for c in columns})


def profile_columns(texts: DataFrame, key: str = KEY) -> DataFrame:
    """What the values of each text column look like, one row per column.

    All columns are counted in one aggregate, whose single row is then turned
    into a row per column.  The samples are the whole values of the first rows by
    ``key`` (a bounded top-k, not a sort).
    """
    columns = [c for c in texts.columns if c != key]
    kinds = {c: _kind(F.col(c)) for c in columns}
    tests = {f"{kind}_{i}": F.count_if(kinds[c] == kind) for i, c in enumerate(columns) for kind in KINDS}
    counted = texts.agg(F.count(F.lit(1)).alias("n_rows"), *(test.alias(name) for name, test in tests.items()))
    per_column = (
        F.struct(F.lit(c).alias("column_name"), "n_rows", *(F.col(f"{kind}_{i}").alias(f"n_{kind}") for kind in KINDS))
        for i, c in enumerate(columns)
    )
    counts = counted.select(F.inline(F.array(*per_column)))
    first = texts.orderBy(key).limit(SAMPLES)
    samples = (
        first.unpivot([key], columns, "column_name", "value")
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct(key, "value"))).alias("kept"))
        .select("column_name", F.concat_ws(", ", F.col("kept.value")).alias("sample_values"))
    )
    share = F.col("n_rows") * F.lit(MAJORITY)
    main_type = (
        F.when(F.col("n_integer") > share, "integer")
        .when(F.col("n_float") > share, "float")
        .otherwise("string")
    )
    return counts.join(samples, "column_name").select(
        "column_name", main_type.alias("main_type"), "n_rows",
        "n_integer", "n_float", "n_string", "n_empty", "sample_values",
    )


def _kind(text: Column) -> Column:
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(text.rlike(INTEGER_TEXT), "integer")
        .when(text.rlike(FLOAT_TEXT), "float")
        .otherwise("string")
    )
