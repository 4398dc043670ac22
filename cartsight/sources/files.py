"""Readers and writers for session files and line streams."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.functions import content_key
from cartsight.schema import KEY, SESSION_SCHEMA
from cartsight.sources.headers import read_csv_by_name
from cartsight.sources.records import text_of

SLICE = "slice"


def read_sessions(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | None = SESSION_SCHEMA,
    fmt: str = "csv",
    view: str | None = None,
    optional: Iterable[str] = (),
) -> DataFrame:
    """Read one or many paths (globs allowed) as one table.

    The columns of CSV files are found by the names in each file's header; those
    in ``optional`` may be missing.  With a schema nothing but the headers is
    read before the query runs; pass ``schema=None`` to have a CSV file's types
    inferred by an extra scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv" and schema is not None:
        sessions = read_csv_by_name(spark, paths, schema, optional)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("inferSchema", True)
        sessions = reader.format(fmt).load(paths)
    return register(sessions, view) if view else sessions


def read_texts(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Header CSV files with every column as text, for the column profile."""
    return spark.read.option("header", True).csv([paths] if isinstance(paths, str) else list(paths))


def with_key(sessions: DataFrame, key: str = KEY) -> DataFrame:
    """Add a key made from the record itself where the files carry none."""
    if key in sessions.columns:
        return sessions
    return sessions.withColumn(key, content_key(*(F.col(c) for c in sessions.columns)))


def register(df: DataFrame, view: str) -> DataFrame:
    """Make ``df`` available to SQL text under ``view``."""
    df.createOrReplaceTempView(view)
    return df


def repartitioned(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """The same rows in ``partitions`` parts; costs a full shuffle."""
    return df.repartition(partitions, *keys)


def union_slices(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several slices, columns matched by name."""
    for other in others:
        first = first.unionByName(other)
    return first


def write_slices(sliced: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write one folder per slice.  Each task writes its own files: no shuffle."""
    names = [c for c in sliced.columns if c != SLICE]
    writer = sliced
    if fmt == "csv":
        texts = [
            text_of(n) if n in SESSION_SCHEMA.names and isinstance(sliced.schema[n].dataType, T.BooleanType)
            else F.col(n)
            for n in names
        ]
        writer = sliced.select(*texts, SLICE)
    writer.write.format(fmt).option("header", True).partitionBy(SLICE).mode("errorifexists").save(path)


def line_stream(
    spark: SparkSession, path: str | None = None, fmt: str = "text", **options: object
) -> DataFrame:
    """A streaming DataFrame with one ``value`` per line.

    ``fmt="text"`` follows a folder; any other streaming format with a string
    ``value`` column works too, with its own options.
    """
    reader = spark.readStream.format(fmt).options(**{k: str(v) for k, v in options.items()})
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))
