"""Connected components of a link table, as joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (u, v): the smallest node that it is linked with, directly or not.

    Every round points the larger neighbours of a node, then the smaller ones,
    at the smallest (large star, small star), until no link changes.  Smallest
    neighbours are aggregates that are combined before the shuffle, so a node
    with very many links costs no more than its links.
    """
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
