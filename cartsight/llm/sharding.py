"""Shards of near-equal bytes by sampled splitters.

Rows are ordered by a hash of the text, then by id.  Size-weighted key samples
give quantile boundaries, records are partitioned by range, overfull ranges are
subdivided, and running sums inside the small ranges turn into exact positions.
The order spreads sources and sizes over all shards and keeps equal texts together.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import handed_out, row_key, stored
from cartsight.llm.ranges import positions

SHARDS = 24
#: Ranges per shard, at least; more when a range would hold more rows than this.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 500_000
#: Equal texts stay in one shard while together they are at most this part of a shard.
WHOLE_GROUP = 0.02


def place(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text", key: bool = False) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 8; a null text counts 0 bytes,
    and its checksum is that of no bytes.  A shard takes the rows whose middle
    byte falls into its share of all bytes, so shards differ by about one row;
    equal texts that are small against a shard go to one shard together.
    Null ids come first among equal texts.  Repeated rows are placed one by one.
    ``slot`` numbers the rows of a shard from 0.  With ``key`` there is a column
    ``key``, the row key, which orders what is still tied.  No rows give no rows.
    """
    text = F.col(text_column)
    own = [row_key(docs).alias("row_key")] if key else []
    order = F.concat(
        F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.when(F.col(id_column).isNull(), "0").otherwise("1"),
        F.coalesce(F.lpad(F.hex(F.col(id_column).cast("bigint")), 16, "0"), F.lit("")), F.lpad(F.hex(F.crc32(F.coalesce(text, F.lit("")))), 8, "0"),
    )
    rows = stored(docs.select(
        order.alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8).alias("weight"),
        F.col(id_column).alias("doc_id"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), *own,
    ), "sizes")
    total = rows.agg(F.sum("weight").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    everything = max(1, total["bytes"] or 0)
    placed = positions(rows, max(shards * RANGES_PER_SHARD, total["n"] // ROWS_PER_RANGE))
    group = "PARTITION BY part, substr(key, 1, 16)"
    placed = placed.withColumns({"g_low": F.expr(f"min(before) OVER ({group})"), "g_high": F.expr(f"max(before + weight) OVER ({group})")})
    whole = F.col("g_high") - F.col("g_low") <= WHOLE_GROUP * everything / shards
    middle = F.when(whole, F.col("g_low") + F.col("g_high")).otherwise(2 * F.col("before") + F.col("weight"))
    shard = F.least(F.lit(shards - 1), F.floor(middle / 2 / everything * shards).cast("int"))
    placed = stored(placed.select("doc_id", F.col("weight").alias("size"), "text_crc32", shard.alias("shard"), "rank", *(["row_key"] if key else [])), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *([F.col("row_key").alias("key")] if key else []),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with the columns of :func:`place`, which replace columns of the same names.

    Every row is placed once, rows with null or empty texts and each of some
    repeated rows as well.  No rows give no rows.
    """
    names = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    manifest = place(docs, shards, key=True).select("key", F.struct(*names).alias("given"))
    return handed_out(docs, manifest).select(
        *(F.col(f"row.`{c}`") for c in docs.columns if c not in names), *(F.col(f"given.{c}").alias(c) for c in names)
    )
