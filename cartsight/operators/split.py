"""Reproducible splits.  Each depends on the row key alone, never on partitions or order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartsight.functions import bucket, key_hash
from cartsight.schema import KEY
from cartsight.sources.files import SLICE

_PERCENT = 100
_FINE_BITS = 20


def is_train(key: str = KEY, train: float = 0.8, seed: int = 0) -> Column:
    return bucket(F.col(key), _PERCENT, seed) < round(train * _PERCENT)


def split_train_test(
    df: DataFrame, train: float = 0.8, key: str = KEY, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that make up ``df``; a filter each, no shuffle.  Rows with a null key go where key 0 goes."""
    chosen = is_train(key, train, seed)
    return df.where(chosen), df.where(~chosen)


def with_fold(df: DataFrame, folds: int = 5, key: str = KEY, seed: int = 0) -> DataFrame:
    """Add ``fold``, independent of the train/test bucket of the same key."""
    return df.withColumn("fold", bucket(F.col(key), folds, seed, skip=_PERCENT))


def shuffled(df: DataFrame, key: str = KEY, seed: int = 1) -> DataFrame:
    """All rows in an order that looks random and is the same each time."""
    return df.orderBy(key_hash(F.col(key), seed), key)


def cap_rows(df: DataFrame, n: int, key: str = KEY, seed: int = 0) -> DataFrame:
    """At most ``n`` rows, the same ones each time."""
    return shuffled(df, key, seed).limit(n)


def split_exact_halves(df: DataFrame, key: str = KEY, seed: int = 1) -> DataFrame:
    """Add ``slice``: 1 for the first ``count div 2`` rows in hash order, 2 for the rest.

    Ranking all rows would be one task's work, so the row at the boundary is
    found by counting: rows per hash prefix (4,096 at most), then per hash
    inside one prefix (2**20 at most), then per key inside one hash.  The passes
    read the key column only, and no row is moved.  A null key is below all
    others of its hash.  Where the key at the boundary occurs more than once, its
    rows are divided in the same way by a hash of their content; rows that are
    equal in every column are divided by their number.
    """
    hashed = df.select(F.col(key).alias("key"), key_hash(F.col(key), seed).alias("hash"))
    half = hashed.count() // 2
    if half == 0:
        return df.withColumn(SLICE, F.lit(2))
    hash_at, rest = _holding_hash(hashed, half)
    keys = hashed.where(F.col("hash") == hash_at).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    last = _holding(keys.withColumn("target", F.lit(rest)), "key").first()

    position = F.struct(key_hash(F.col(key), seed).alias("hash"), F.col(key).alias("key"))
    boundary = F.struct(F.lit(hash_at).cast("bigint").alias("hash"), F.lit(last["key"]).cast(df.schema[key].dataType).alias("key"))
    if last["rest"] == last["n"]:
        return df.withColumn(SLICE, F.when(position <= boundary, 1).otherwise(2))

    content = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}))
    alike = df.where(position == boundary).select(content.alias("content"), F.conv(F.left(content, F.lit(8)), 16, 10).cast("bigint").alias("hash"))
    hash_at, rest = _holding_hash(alike, last["rest"])
    contents = alike.where(F.col("hash") == hash_at).groupBy("content").agg(F.count(F.lit(1)).alias("n"))
    last = _holding(contents.withColumn("target", F.lit(rest)), "content").first()
    # The first 8 digits of the content are its hash, so the texts are in the order of the hashes.
    first = (position < boundary) | ((position == boundary) & (content <= last["content"]))
    sliced = df.withColumn(SLICE, F.when(first, 1).otherwise(2))
    if last["rest"] == last["n"]:
        return sliced
    at_boundary = (position == boundary) & (content == last["content"])
    copies = df.where(at_boundary).limit(1).withColumn(SLICE, F.explode(F.transform(F.sequence(F.lit(1), F.lit(last["n"])), lambda i: F.when(i <= last["rest"], 1).otherwise(2))))
    return sliced.where(~at_boundary).unionByName(copies)


def _holding_hash(hashed: DataFrame, target: int) -> tuple[int, int]:
    """The ``hash`` (below 2**32) at which the running count of rows reaches ``target``, and the count still missing before it."""
    prefix = F.shiftright("hash", _FINE_BITS)
    prefixes = hashed.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    chosen = _holding(prefixes.withColumn("target", F.lit(target)), "prefix").first()
    hashes = hashed.where(prefix == chosen["prefix"]).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    found = _holding(hashes.withColumn("target", F.lit(chosen["rest"])), "hash").first()
    return found["hash"], found["rest"]


def _holding(counts: DataFrame, value: str) -> DataFrame:
    """The one ``value`` whose running count reaches ``target``, the count still ``rest`` in it, and its own count ``n``."""
    before = F.sum("n").over(Window.orderBy(value)) - F.col("n")
    return (
        counts.withColumn("rest", F.col("target") - before)
        .where("rest between 1 and n")
        .select(value, "rest", "n")
    )


def join_features_target(features: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Put two tables that share a unique key side by side."""
    return features.join(target, key)
