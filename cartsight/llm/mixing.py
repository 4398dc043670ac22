"""Mixing sources to target weights by systematic sampling.

Within a source the expected copies of the documents are summed up in order of
size, one random offset is added, and a document is emitted once per integer
boundary that its share crosses.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import WORD, fixed, handed_out, row_key, stored
from cartsight.llm.ranges import positions

WEIGHTS = (5, 2, 1)
#: A target is at most so many times the size of its source.
MOST = 3
#: Expected copies are counted in units of 2**-24, in whole numbers, so that no rounding adds a copy.
UNITS = 1 << 24
ROWS_PER_RANGE = 500_000
RANGES = 96


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, documents, source_rank, target`` per source of ``sizes`` (source, size).

    Sources are numbered by code point, null last, with weights 5, 2, 1 in turn.
    All sizes together are shared by weight; a target stops at three times its
    source's size and the excess is shared again, until none is above: one
    factor, raised until it no longer changes, gives ``factor * weight`` below
    the stop.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    named = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))
    ranked = positions(totals.select(named.alias("key"), F.lit(1).cast("bigint").alias("weight"), "source", "source_size", "documents"), RANGES)
    weights = F.lit([float(w) for w in WEIGHTS])
    ranked = stored(ranked.select(
        "source", "source_size", "documents", F.col("rank").alias("source_rank"), F.get(weights, (F.col("rank") % len(WEIGHTS)).cast("int")).alias("share")
    ), "sources")
    stop = F.col("source_size") * float(MOST)
    everything = float(ranked.agg(F.sum("source_size").alias("n")).first()["n"] or 0)
    factor, capped = 0.0, -1
    while True:
        above = stop < factor * F.col("share")
        left = ranked.agg(
            F.count(F.when(above, 1)).alias("capped"), F.sum(F.when(above, stop).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("share"))).alias("shares"),
        ).first()
        if left["capped"] == capped or not left["shares"]:
            break
        capped, factor = left["capped"], (everything - left["given"]) / left["shares"]
    return ranked.select("source", "source_size", "documents", "source_rank", F.least(stop, F.lit(factor) * F.col("share")).alias("target"))


def copies(docs: DataFrame, seed: str = "mix", key: bool = False) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    ``size`` counts words (null text: 0).  Expected copies are target over
    source size for all documents of a source, at most three; along growing
    sizes, so that the words taken stay within about one document of the target.
    Rows without words take part and give no words; a source without words has
    target 0 and no copies.  Ties are ordered by a hash of the id; repeated rows
    are counted one by one.  With ``key`` there is a column ``key``, the row key,
    which orders what is still tied.  The offset is a hash of ``seed`` and the source's
    number: reruns agree.  No rows give no rows.
    """
    own = [row_key(docs).alias("row_key")] if key else []
    rows = stored(docs.select("doc_id", "source", words(F.col("text")).alias("size"), *own), "words")
    sources = stored(source_targets(rows), "targets")
    rows = rows.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "d.source", "size", "source_rank", "source_size", "target", *(["row_key"] if key else [])
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    order = F.concat(fixed("source_rank"), fixed("size"), F.md5(name), name, *(["row_key"] if key else []))
    one = F.lit(1).cast("bigint")
    n = sources.agg(F.sum("documents").alias("n")).first()["n"] or 0
    placed = positions(rows.withColumns({"key": order, "weight": one}), max(RANGES, n // ROWS_PER_RANGE))
    starts = positions(sources.select(fixed("source_rank").alias("key"), F.col("documents").alias("weight"), "source_rank"), RANGES)
    rate = F.when(
        F.col("source_size") > 0, F.least(F.lit(MOST * UNITS), F.round(F.col("target") / F.col("source_size") * UNITS).cast("bigint"))
    ).otherwise(0)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("source_rank").cast("string"))), 1, 6), 16, 10).cast("bigint")
    steps = placed.join(starts.select("source_rank", F.col("before").alias("start")), "source_rank").withColumns({
        "rate": rate, "low": offset + (F.col("rank") - F.col("start")) * rate,
    })
    return steps.select(
        "doc_id", "source", "size", "source_size", "target", F.expr(f"(low + rate) div {UNITS} - low div {UNITS}").alias("copies"),
        *([F.col("row_key").alias("key")] if key else []),
    )


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes of each row, repeats counted."""
    return copies(docs, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`copies` says, its columns as they are.

    Null and empty texts have no words, so the mix takes none of them.  Each of
    some repeated rows is counted and drawn for itself.  No rows give no rows.
    """
    manifest = copies(docs, seed, key=True).where("copies > 0").select("key", F.struct("copies").alias("given"))
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("given.copies").cast("int"))).alias("copy")
    return handed_out(docs, manifest).select("row", repeated).select("row.*")
