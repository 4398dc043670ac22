"""What the operators share: tables of the corpus, row keys, intermediate tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.storage import shared_path

#: A word is a run of anything but these; the same six characters in Java, DuckDB and ``bytes.split``.
WORD = r"[^\x20\x09-\x0D]+"
#: Equal rows from which they are joined in blocks of about so many.
HOT_KEY = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: list[list[str]] = [[]]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table, so that a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    _written[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, make: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """The stored result of ``make``; the tables that it stored on the way are deleted."""
    _written.append([])
    try:
        result = make()
        inner, _written[-1] = _written[-1], []
        result = stored(result, purpose)
        _written[-2].extend(_written[-1])
    finally:
        _written.pop()
    for path in inner:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return result


def held_out(doc_id: Column) -> Column:
    """Rows that no learner may read: crc32 of the id as text, modulo 4, is 2; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def text_key(text: Column) -> Column:
    """Identifies a text: two hashes with different seeds and the length; equal texts, null included, have equal keys."""
    return F.struct(
        F.xxhash64(text).alias("a"), F.xxhash64(F.lit("k"), text).alias("b"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("n")
    )


def without(docs: DataFrame, texts: DataFrame, column: str = "text_key") -> DataFrame:
    """The rows of ``docs`` whose text is not among the keys of ``texts``; columns and repeated rows stay as they are."""
    gone = texts.select(F.col(column).alias("gone")).distinct()
    return docs.join(gone, text_key(docs["text"]) == gone["gone"], "left_anti")


def fixed(column: str) -> Column:
    """A whole number of at least 0 as text of one width, in the same order."""
    return F.lpad(F.hex(column), 16, "0")


def row_key(docs: DataFrame) -> Column:
    """Identifies a row of ``docs`` by all its columns: two hashes with different seeds, as 32 characters; equal rows have equal keys."""
    parts = []
    for field in docs.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.FractionalType):
            column = column.cast("string")
        elif not isinstance(field.dataType, (T.AtomicType, T.NullType)):
            column = F.to_json(F.struct(column), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"})
        parts += [column.isNull(), column]
    return F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in ("a", "b")))


def handed_out(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """``row``, a row of ``docs``, and ``given`` of each row of ``manifest``.

    ``manifest`` has a row for every row of ``docs``, with its :func:`row_key` as
    ``key``.  Equal rows differ in nothing but what they are given, so one of them
    stands for all, and each row of the manifest meets one row.  The manifest rows
    of a key that occurs very often are dealt over blocks, its row to all of them.
    """
    manifest = stored(manifest, "manifest")
    rows = docs.select(row_key(docs).alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.groupBy("key").agg(F.first("row").alias("row"))
    blocks = (F.count(F.lit(1)) / HOT_KEY).cast("bigint")
    hot = stored(manifest.groupBy("key").agg(blocks.alias("blocks")).where("blocks > 0"), "hot-keys")
    if hot.isEmpty():
        return rows.join(manifest, "key").select("row", "given")
    blocks = F.coalesce("blocks", F.lit(0))
    rows = rows.join(hot, "key", "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)))
    manifest = manifest.withColumn("at", F.monotonically_increasing_id()).join(hot, "key", "left").withColumn("block", F.col("at") % (blocks + 1))
    return rows.drop("blocks").join(manifest.drop("blocks"), ["key", "block"]).select("row", "given")
