"""Logistic regression by gradient descent whose weights can be carried from batch to batch."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.functions import bucket, logistic
from cartsight.schema import KEY, ONLINE_FEATURES

# Training settings and the decision threshold.
STEP_SIZE = 0.1
STEPS = 50
TOLERANCE = 0.001
THRESHOLD = 0.5
ZERO_WEIGHTS = (0.0,) * len(ONLINE_FEATURES)
#: Parts that a mini-batch is counted in.
_PARTS = 10_000


def score(online: DataFrame, weights: Sequence[float], digits: int | None = None) -> DataFrame:
    """Add ``score`` and the 0/1 ``prediction`` to rows that keep their label: no join needed."""
    value = logistic(ONLINE_FEATURES, weights)
    scored = online.withColumn("score", value if digits is None else F.round(value, digits))
    return scored.withColumn("prediction", (F.col("score") > THRESHOLD).cast("double"))


def mini_batch(online: DataFrame, fraction: float, step: int, key: str = KEY) -> DataFrame:
    """The rows that a step reads: about ``fraction`` of them, by a hash of their key, others for another step.

    A filter, so that a lost executor or another layout changes nothing.  Rows of
    equal keys go together; rows with a null key go where key 0 goes.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be above 0 and at most 1, not {fraction!r}")
    return online if fraction == 1 else online.where(bucket(F.col(key), _PARTS, seed=step) < round(fraction * _PARTS))


def mean_gradient(online: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row: the mean gradient of the log loss at ``weights``, a column per feature."""
    missed = online.withColumn("miss", logistic(ONLINE_FEATURES, weights) - F.col("label"))
    return missed.selectExpr(*(f"avg(miss * {c}) AS {c}" for c in ONLINE_FEATURES))


def gradient_step(
    online: DataFrame, weights: Sequence[float] = ZERO_WEIGHTS, step_size: float = STEP_SIZE
) -> DataFrame:
    """One row: the weights after one step from ``weights``."""
    return mean_gradient(online, weights).selectExpr(
        *(f"{float(w)!r}D - {step_size!r}D * {c} AS {c}" for w, c in zip(weights, ONLINE_FEATURES))
    )


def descend(
    online: DataFrame, weights: Sequence[float] = ZERO_WEIGHTS,
    step_size: float = STEP_SIZE, steps: int = STEPS, tolerance: float = TOLERANCE,
    fraction: float = 1.0, key: str = KEY,
) -> tuple[float, ...]:
    """Weights after up to ``steps`` steps of shrinking size, each one aggregate over a ``fraction`` of ``online``.

    Stops early when a step after the first moves less than ``tolerance`` of the
    weights' length (of 1 if they are shorter).  ``online`` should be persisted;
    a batch without rows leaves the weights as they are, and so does a step whose
    part holds none.
    """
    current = np.asarray(weights, dtype=float)
    for i in range(1, steps + 1):
        gradient = mean_gradient(mini_batch(online, fraction, i, key), current.tolist()).first()
        if gradient[0] is None:
            if fraction == 1:
                break
            continue
        after = current - step_size / np.sqrt(i) * np.array(gradient)
        moved = np.linalg.norm(after - current)
        current = after
        if i > 1 and moved < tolerance * max(np.linalg.norm(current), 1.0):
            break
    return tuple(current.tolist())
