"""Logistic score of a weighted sum."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# exp() stays finite inside this range and the score is 0 or 1 to double precision outside it.
_MARGIN_LIMIT = 700.0


def logistic(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Score of the named feature columns.

    One SQL text instead of a tree of column objects, because descent builds a
    new expression for every step.
    """
    if len(features) != len(weights):
        raise ValueError(f"{len(features)} features but {len(weights)} weights")
    margin = " + ".join(f"`{x}` * {float(w)!r}D" for x, w in zip(features, weights))
    bounded = f"greatest(least({margin}, {_MARGIN_LIMIT}D), -{_MARGIN_LIMIT}D)"
    return F.expr(f"1D / (1D + exp(-{bounded}))")
