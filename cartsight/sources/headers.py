"""CSV files read by the names in their headers, whatever the order of their columns."""

import csv
from collections.abc import Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

#: Headers read at once.
READERS = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, decompressed; None for an empty file.  No more than a buffer of it is read."""
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(hadoop).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop).getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def headers(spark: SparkSession, paths: Sequence[str]) -> tuple[dict[str, tuple[str, ...]], set[str]]:
    """The column names of every file that is not empty, and the names that the folders give (``name=value``).

    The driver reads the first line of each file, as it lists each file for the scan.
    """
    found = spark.read.schema("line string").csv(list(paths))
    files = sorted(found.inputFiles())
    with ThreadPool(READERS) as pool:
        lines = pool.map(lambda file: _first_line(spark, file), files, chunksize=1)
    named = {}
    for file, line in zip(files, lines):
        if line:
            named[file] = tuple(next(csv.reader([line.removeprefix("﻿")])))
    return named, {c for c in found.columns if c != "line"}


def reconciled(named: dict[str, tuple[str, ...]], fields: Sequence[str], optional: Iterable[str] = ()) -> list[str]:
    """The ``fields`` that the files hold, in the order of ``fields``; an error names the file and the names that do not fit.

    Fields in ``optional`` may be missing, but then from all files.
    """
    optional, present = set(optional), {}
    for file, names in named.items():
        repeated = sorted({n for n in names if names.count(n) > 1})
        missing = [f for f in fields if f not in names and f not in optional]
        foreign = [n for n in names if n not in fields]
        faults = [f"{what}: {', '.join(which)}" for what, which in (("missing", missing), ("unknown", foreign), ("repeated", repeated)) if which]
        if faults:
            raise ValueError(f"{file}: columns {'; '.join(faults)}")
        for f in optional & set(fields):
            present.setdefault(f, {}).setdefault(f in names, file)
    for f, files in present.items():
        if len(files) == 2:
            raise ValueError(f"{f} is in {files[True]} but not in {files[False]}")
    return [f for f in fields if f not in optional or True in present.get(f, {})]


def read_csv_by_name(
    spark: SparkSession, paths: str | Iterable[str], schema: T.StructType, optional: Iterable[str] = (), reader: DataFrameReader | None = None
) -> DataFrame:
    """Header CSV files as the columns of ``schema``, found by name in each file.

    Files with the same order of columns are one scan; each further order adds
    one.  A column that is missing or not in ``schema`` is an error before the
    scan, as are names that repeat.  Empty files hold no rows.  Columns that the
    folders give keep their type in ``schema``, or the inferred one.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    named, given = headers(spark, paths)
    fields = [f.name for f in schema.fields if f.name not in given]
    kept = reconciled(named, fields, optional) if named else [f for f in fields if f not in set(optional)]
    orders: dict[tuple[str, ...], list[str]] = {}
    for file, names in named.items():
        orders.setdefault(names, []).append(file)
    folders = [schema[n] for n in schema.names if n in given]
    result = [f.name for f in schema.fields if f.name in given or f.name in kept]

    def scan(names: Sequence[str], where: list[str]) -> DataFrame:
        source = (reader or spark.read).option("header", True).schema(T.StructType([*(schema[n] for n in names), *folders]))
        rows = source.csv(where)
        return rows.select(*result, *(c for c in rows.columns if c not in result))

    if len(orders) <= 1:
        return scan(next(iter(orders), kept), paths)
    if given and len(paths) > 1:
        return reduce(DataFrame.unionByName, (read_csv_by_name(spark, path, schema, optional, reader) for path in paths))
    if given:
        reader = (reader or spark.read).option("basePath", paths[0])
    return reduce(DataFrame.unionByName, (scan(names, files) for names, files in orders.items()))
