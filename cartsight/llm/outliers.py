"""Quality rules by robust multivariate outliers.

Per language and source, the location and scatter of transformed text statistics
are estimated on the three quarters of documents that lie closest together
(minimum covariance determinant, by repeated concentration), and documents far
away by Mahalanobis distance are rejected.
"""

import itertools
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored
from cartsight.llm.stats import COUNTS, statistics

#: Part of a group's documents that the estimate rests on, and the concentration steps from the start.
CORE = 0.75
STEPS = 3
#: A group with fewer documents is pooled with its language, then with all.
LEAST_GROUP = 200
#: Part of a normal population that lies beyond the threshold.
TAIL = 1e-6
#: Scatter of a statistic that counts as none: transformed values are logarithms.
FLOOR = 0.5
DIMENSIONS = ("x_words", "x_length", "x_symbols", "x_lines", "x_repeats")


def chi2_quantile(p: float, k: int) -> float:
    """Wilson and Hilferty's approximation."""
    return k * (1 - 2 / (9 * k) + NormalDist().inv_cdf(p) * (2 / (9 * k)) ** 0.5) ** 3


def consistency(core: float, k: int) -> float:
    """Factor by which the scatter of the core falls short of that of a normal population."""
    x = np.linspace(1e-9, chi2_quantile(core, k), 20_001)
    low, high = (np.trapezoid(x ** (d / 2 - 1) * np.exp(-x / 2)) for d in (k, k + 2))
    return float(k * low / high)


def transformed() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x_words": F.log1p("n_words"), "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words) * 2,
        "x_symbols": F.log1p(F.col("n_symbols") * 100 / words), "x_lines": F.log1p(F.col("n_dup_lines") * 100 / words),
        "x_repeats": F.log1p(F.col("n_repeat_words") * 20 / words),
    }


def _distance(location: str = "location", inverse: str = "inverse") -> Column:
    k = len(DIMENSIONS)
    off = [F.col(d) - F.get(location, F.lit(i)) for i, d in enumerate(DIMENSIONS)]
    return sum((off[i] * off[j] * F.get(inverse, F.lit(i * k + j)) for i, j in itertools.product(range(k), repeat=2)), F.lit(0.0))


def _invert(frames: Iterator[pd.DataFrame], factor: float) -> Iterator[pd.DataFrame]:
    """Location and inverse scatter of each group from its moments; scatter below the floor is raised to it."""
    k = len(DIMENSIONS)
    for frame in frames:
        out = []
        for group, n, sums, products in zip(frame["group_id"], frame["n"], frame["sums"], frame["products"]):
            location = np.asarray(sums, float) / n
            scatter = np.asarray(products, float).reshape(k, k) / n - np.outer(location, location)
            values, axes = np.linalg.eigh((scatter + scatter.T) / 2 * factor)
            out.append((group, location.tolist(), ((axes / np.maximum(values, FLOOR**2)) @ axes.T).ravel().tolist()))
        yield pd.DataFrame(out, columns=["group_id", "location", "inverse"])


def _estimates(core: DataFrame, factor: float) -> DataFrame:
    k = len(DIMENSIONS)
    products = [F.sum(F.col(DIMENSIONS[i]) * F.col(DIMENSIONS[j])) for i, j in itertools.product(range(k), repeat=2)]
    moments = core.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n"), F.array(*(F.sum(d) for d in DIMENSIONS)).alias("sums"), F.array(*products).alias("products")
    )
    schema = "group_id string, location array<double>, inverse array<double>"
    return moments.mapInPandas(lambda frames: _invert(frames, factor), schema)


def _started(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges: where concentration starts."""
    quartiles = rows.groupBy("group_id").agg(*(F.percentile_approx(d, [0.25, 0.5, 0.75], 2000).alias(d) for d in DIMENSIONS))
    location = F.array(*(F.get(d, F.lit(1)) for d in DIMENSIONS))
    spread = [F.greatest((F.get(d, F.lit(2)) - F.get(d, F.lit(0))) / 1.349, F.lit(FLOOR)) for d in DIMENSIONS]
    k = len(DIMENSIONS)
    inverse = F.array(*(1 / (spread[i] * spread[i]) if i == j else F.lit(0.0) for i, j in itertools.product(range(k), repeat=2)))
    return quartiles.select("group_id", location.alias("location"), inverse.alias("inverse"))


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with ``group_id``: language and source, else the language, else all, by the first that has enough documents.

    Counts are of documents that pass the base rules.
    """
    fine, coarse = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    rows = rows.withColumns({"fine": fine, "coarse": coarse})
    counted = rows.where(~F.col("base_failed"))
    fines = counted.groupBy("fine").count().where(F.col("count") >= LEAST_GROUP).select("fine", F.lit(True).alias("own"))
    coarses = counted.groupBy("coarse").count().where(F.col("count") >= LEAST_GROUP).select("coarse", F.lit(True).alias("shared"))
    joined = rows.join(fines, "fine", "left").join(coarses, "coarse", "left")
    return joined.withColumn("group_id", F.when(F.col("own"), F.col("fine")).when(F.col("shared"), F.col("coarse")).otherwise("all")).drop(
        "fine", "coarse", "own", "shared"
    )


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed``, ``kept`` and ``distance`` for every row of ``docs``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in
    repeated windows; null and empty texts fail it.  The others are kept unless
    their squared distance exceeds the threshold; it is null where nothing could
    be estimated, and such rows are kept.  A null language or source is a value
    of its own.  Repeated rows are judged alike.  No rows give no rows.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = stored(statistics(docs, "doc_id", "lang", "source"), "statistics")
    rows = stored(_grouped(measured.withColumn("base_failed", failed).withColumns(transformed())), "grouped")
    passed = rows.where(~F.col("base_failed"))
    estimates = stored(_started(passed), "estimates")
    factor = consistency(CORE, len(DIMENSIONS))
    for _ in range(STEPS):
        near = passed.join(estimates, "group_id").select("group_id", *DIMENSIONS, _distance().alias("distance"))
        limits = near.groupBy("group_id").agg(F.percentile_approx("distance", CORE, 2000).alias("limit"))
        core = near.join(limits, "group_id").where(F.col("distance") <= F.col("limit"))
        estimates = stored(_estimates(core, factor), "estimates")
    judged = rows.join(estimates, "group_id", "left").withColumn("distance", _distance())
    threshold = chi2_quantile(1 - TAIL, len(DIMENSIONS))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= threshold)
    return judged.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "distance")
