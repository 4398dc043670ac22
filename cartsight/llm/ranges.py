"""Positions in a global order, without a global sort: sampled splitters, ranges, prefix sums.

All of it is DataFrame work.  The driver sees the splitters (a bounded sample)
and two sums per range.
"""

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored

#: Sampled keys per range, and how far a range may exceed its share before it is subdivided.
OVERSAMPLE = 24
OVERFULL = 3.0
ROUNDS = 8


def range_of(key: Column, splitters: list[str]) -> Column:
    """Number of splitters at or below ``key``: a binary search in a constant array, inside the expression."""
    if not splitters:
        return F.lit(0)
    bounds = F.lit(splitters)
    steps, step = [], 1
    while step <= len(splitters):
        steps.insert(0, step)
        step *= 2

    def halve(at: Column, by: Column) -> Column:
        return F.when((at + by <= len(splitters)) & (F.get(bounds, at + by - 1) <= key), at + by).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def _sample(rows: DataFrame, points: Column) -> list[tuple[str, int]]:
    """Keys with the number of sample points that fall on them, drawn in proportion to ``points`` by a hash of the key."""
    chance = F.pmod(F.xxhash64(F.lit("draw"), "key"), F.lit(1 << 20)) / (1 << 20)
    drawn = rows.select("key", F.floor(points + chance).alias("points")).where("points > 0")
    return sorted((r["key"], r["points"]) for r in drawn.collect())


def _quantiles(sample: list[tuple[str, int]], parts: int) -> list[str]:
    """Keys that cut the sample into ``parts`` of about equal weight."""
    total, seen, out = sum(points for _, points in sample), 0, set()
    for key, points in sample:
        if seen * parts // total != (seen + points) * parts // total and seen + points < total:
            out.add(key)
        seen += points
    return sorted(out)


def splitters(rows: DataFrame, parts: int) -> tuple[list[str], dict[int, tuple[int, int]]]:
    """Splitters that cut ``rows`` (key, weight, copies) into at least ``parts`` ranges, and weight and copies of each range.

    A range of more than ``OVERFULL`` times its share is sampled again on its
    own and cut further, until all fit or a range holds a single key.
    """
    total = rows.agg(F.sum(F.col("weight") * F.col("copies")).alias("w")).first()["w"] or 0
    share = max(1.0, total / parts)
    weight = F.col("weight") * F.col("copies")
    cuts = _quantiles(_sample(rows, weight * (OVERSAMPLE / share)), parts)
    for _ in range(ROUNDS):
        sums = {
            r["part"]: r
            for r in rows.groupBy(range_of(F.col("key"), cuts).alias("part"))
            .agg(F.sum(weight).alias("w"), F.sum("copies").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        }
        full = [p for p, r in sums.items() if r["w"] > OVERFULL * share and r["low"] < r["high"]]
        if not full:
            break
        more = rows.where(range_of(F.col("key"), cuts).isin(full))
        sample = _sample(more, weight * (OVERSAMPLE / share))
        fresh = set(cuts)
        for p in full:
            own = [x for x in sample if bisect_right(cuts, x[0]) == p]
            fresh.update(k for k in _quantiles(own, max(2, round(sums[p]["w"] / share))) if k > sums[p]["low"])
        if len(fresh) == len(cuts):
            break
        cuts = sorted(fresh)
    return cuts, {p: (r["w"], r["n"]) for p, r in sums.items()}


def positions(rows: DataFrame, parts: int) -> DataFrame:
    """Each row of ``rows`` (key, weight, and any others) with ``rank`` and ``before``: rows and weight ahead of it in key order.

    Equal rows are counted first and unfolded at the end, so that any number of
    them costs one entry; other rows need distinct keys.  Every range is ordered
    in a task of its own; the sums of the ranges ahead come from the driver.
    """
    rows = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "order")
    cuts, sums = splitters(rows, parts)
    ahead, weight, count = [], 0, 0
    for part in range(len(cuts) + 1):
        ahead.append((weight, count))
        w, n = sums.get(part, (0, 0))
        weight, count = weight + w, count + n
    placed = rows.withColumn("part", range_of(F.col("key"), cuts))
    inside = "PARTITION BY part ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    placed = placed.withColumns({
        "w": F.expr(f"coalesce(sum(weight * copies) OVER ({inside}), 0L)") + F.get(F.lit([x[0] for x in ahead]).cast("array<bigint>"), F.col("part")),
        "n": F.expr(f"coalesce(sum(copies) OVER ({inside}), 0L)") + F.get(F.lit([x[1] for x in ahead]).cast("array<bigint>"), F.col("part")),
    })
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    kept = [c for c in rows.columns if c != "copies"]
    return placed.select(*kept, "part", "w", "n", copy).select(
        *kept, "part", (F.col("w") + F.col("copy") * F.col("weight")).alias("before"), (F.col("n") + F.col("copy")).alias("rank")
    )
