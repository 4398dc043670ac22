"""Embedding whitening: components and deviations by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors are stored once, as blocks of rows.  Each step sends one
direction to the blocks, which return the product ``X v`` folded back through
``X'u``; only vectors of the embedding's width reach the driver, so memory there
does not depend on the number of rows.  A left vector is never stored: it is
``X c`` for a coefficient vector ``c`` of that width, and its products with other
left vectors follow from ``X'u``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.blocks import summed
from cartsight.llm.common import stored

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Bytes of a block of rows.
BLOCK = 2 << 20
#: Entries beyond this are held at it, so that they stay whole numbers of a double.
LARGEST = float(1 << 53)
#: A direction whose deviation is this part of the largest one, or less, is rounding.
ROUNDING = 1e-9
_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """Number and sums of the fitted vectors, their components (a row each) and variances, and the variance of all dimensions."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``x`` on the components, each with variance 1 over the fitted vectors."""
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sums) ** 2, exact; None where it exceeds a long."""
        whole, rest = _parts(self.n, self.sums)
        off = x - whole
        reach = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if reach * reach * max(1, x.shape[1]) <= _LONG:
            return ((self.n * off - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v <= _LONG else None for v in exact]


def _parts(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and remainder of sums / n."""
    pairs = [divmod(int(s), n) for s in sums]
    return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    whole, rest = _parts(n, sums)
    return (x - whole).astype(np.float64) - rest / n


def is_whole(vector: Column) -> Column:
    """True for a vector that is not null and holds no null, NaN or infinite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def in_whole_numbers(vectors: DataFrame, column: str, *keys: str) -> tuple[DataFrame, int]:
    """``keys`` and ``x`` of the rows with a whole vector, and the width; shorter vectors are filled up with entries of 0."""
    vector = F.col(f"`{column}`").cast("array<double>")
    rows = vectors.select(*(F.col(f"`{k}`") for k in keys), vector.alias("_vector")).where(is_whole(F.col("_vector")))
    least, most = rows.agg(F.min(F.size("_vector")), F.max(F.size("_vector"))).first()
    held = F.transform("_vector", lambda c: F.greatest(F.least(F.floor(F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))), F.lit(1 << 53)), F.lit(-(1 << 53))) + SHIFT)
    if least != most:
        held = F.concat(held, F.array_repeat(F.lit(SHIFT).cast("bigint"), F.lit(most) - F.size("_vector")))
    return rows.select(*(F.col(f"`{k}`") for k in keys), held.alias("x")), most or 0


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def blocks_of(rows: DataFrame, width: int) -> DataFrame:
    """The distinct ``x`` of ``rows`` as a stored table: ``n`` rows and their entries, a row of the table per block."""
    size = max(1, BLOCK // (8 * width))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_matrix(batch.column("x"), width))
            n += len(held[-1])
            if n >= size:
                yield _packed(held)
                held, n = [], 0
        if n:
            yield _packed(held)

    def _packed(held: list[np.ndarray]) -> pa.RecordBatch:
        block = np.concatenate(held)
        return pa.RecordBatch.from_arrays([pa.array([len(block)], pa.int64()), pa.array([block.tobytes()], pa.binary())], ["n", "entries"])

    return stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("_times")).select("x").mapInArrow(pack, "n long, entries binary"), "whitening-blocks")


def bidiagonalised(product: Callable[[np.ndarray], np.ndarray], width: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Right vectors (a column each), diagonal and upper diagonal of a matrix ``X``.

    ``product(c)`` returns ``X'(X c)`` followed by the squared length of ``X c``.
    All ``width`` steps are made, so that clusters of nearly equal variances are
    resolved; where a step ends in rounding, the next starts in a fresh direction,
    so that repeated variances and lost dimensions are found as well.
    """
    rng = np.random.default_rng(seed)
    right, left, folded = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    alpha, beta = np.zeros(width), np.zeros(max(width - 1, 0))
    largest = 0.0

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    v = rng.standard_normal(width)
    v /= np.linalg.norm(v)
    for k in range(width):
        right = np.column_stack([right, v])
        c = v - beta[k - 1] * left[:, k - 1] if k and beta[k - 1] else v
        answer = product(c)
        w, square = answer[:-1], answer[-1]
        if k:  # what the recurrence left of earlier left vectors
            h = left.T @ w
            c, w, square = c - left @ h, w - folded @ h, square - h @ h
        length = np.sqrt(max(square, 0.0))
        largest = max(largest, length)
        if length > ROUNDING * largest:
            alpha[k], c, w = length, c / length, w / length
        else:
            c, w = np.zeros(width), np.zeros(width)
        left, folded = np.column_stack([left, c]), np.column_stack([folded, w])
        if k + 1 == width:
            break
        v = orthogonal(w - alpha[k] * v)
        length = np.linalg.norm(v)
        if length > ROUNDING * largest:
            beta[k] = length
        else:
            v = orthogonal(rng.standard_normal(width))
            length = np.linalg.norm(v)
        v = orthogonal(v / length)
        v /= np.linalg.norm(v)
    return right, alpha, beta


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Components and deviations of the vectors of ``blocks``; None without vectors or variance."""
    n = blocks.agg(F.sum("n")).first()[0]
    if not n or not width:
        return None

    def over_rows(part: Callable[[np.ndarray], np.ndarray], size: int, whole: bool = False) -> np.ndarray:
        return summed(blocks, "entries", size, lambda block: part(np.frombuffer(block, np.int64).reshape(-1, width)), whole)

    sums = over_rows(lambda x: x.sum(axis=0), width, whole=True)
    whole, rest = _parts(n, sums)
    mean = rest / n

    def product(c: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            rows = (x - whole).astype(np.float64) - mean
            u = rows @ c
            return np.append(u @ rows, u @ u)

        return over_rows(part, width + 1) / n

    right, alpha, beta = bidiagonalised(product, width)
    _, deviations, turned = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
    keep = np.flatnonzero(deviations > ROUNDING * max(deviations[0], 1e-300))[:components]
    if not len(keep):
        return None
    found = turned[keep] @ right.T
    found /= np.linalg.norm(found, axis=1)[:, None]
    found *= np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])[:, None]
    model = Whitening(n, sums, found, deviations[keep] ** 2, float((deviations**2).sum()))
    size = len(keep)

    def moments(x: np.ndarray) -> np.ndarray:
        z = model.apply(x)
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    found = over_rows(moments, size * size + size) / n
    spread = found[: size * size].reshape(size, size) - np.outer(found[size * size :], found[size * size :])
    model.identity_error = float(np.abs(spread - np.eye(size)).max())
    return model


def whitened(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    The fit takes each distinct vector of whole numbers once, whatever the number
    of its copies; every row, copies included, is projected.  Vectors that are
    null, or hold a null, NaN or infinite entry, give no rows; entries beyond
    2**53 / 64 are held there; vectors shorter than the longest are filled up
    with entries of 0.  Null and repeated keys are kept as they are.  Components without
    variance (constant or dependent dimensions) are left out, so one distinct
    vector, or an empty table, gives no rows.  Among equal variances the choice
    of directions is fixed by the data and a seed; a sign makes the largest entry
    positive.  ``deviation`` is null where it exceeds a long.  Other columns of
    ``vectors``, whatever their names, are not read.
    """
    rows, width = in_whole_numbers(vectors, column, key)
    schema = f"`{key}` {rows.schema[0].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(blocks_of(rows, width), width, components) if width else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size = len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            times = np.repeat(np.arange(len(x)), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(times)),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(times), model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(times)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.variances / model.total, len(x))),
                    pa.array(np.full(len(times), model.identity_error)),
                ],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
