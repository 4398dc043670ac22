"""Quality scores learned from preferences: Bradley-Terry over pairs of a good and a bad document.

The chance that one document is preferred to another is the logistic function of
the difference of their scores.  Scores are sums of step features over text
statistics; the threshold is a quantile of the training scores.  All labelled
documents, and all pairs of a good and a bad one, count: how a document fares
against all of the other label depends on its score alone, so two passes over
the documents, each summed by Spark, give the loss of all pairs and its slope.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.llm.blocks import summed
from cartsight.llm.common import held_out, stored
from cartsight.llm.stats import COUNTS, SHARES, statistics

#: Pairs that a fit on few rows at hand draws (:func:`fit_pairs`).
PAIRS = 40_000
#: Documents in a block and in a task of the fit.
BLOCK = 20_000
TASK_ROWS = 100_000
#: Points between which the chances of scores are interpolated, and cells that divide the scores at the end.
POINTS = 1_024
#: Points at which the curvature takes the scores, and most steps of the fit.
COARSE = 64
NEWTON = 20
CELLS = 1 << 16
#: Bits of a value that one pass settles where quantiles are counted.
DIGIT = 13
STEPS = 8
RIDGE = 1e-3
#: A document counts as good from this score on.
GOOD = 0.7
FEATURES = ("log_words", *SHARES)


@dataclass
class Preference:
    """Step edges per feature, a weight per step, and the score that divides good from bad."""

    edges: np.ndarray
    weights: np.ndarray
    middle: float
    scale: float

    def steps(self, values: np.ndarray) -> np.ndarray:
        return (values[:, :, None] > self.edges[None]).reshape(len(values), -1).astype(np.float64)

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.steps(values) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.raw(values) - self.middle) * self.scale + np.log(GOOD / (1 - GOOD)), -30, 30)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Preference:
    """Maximum likelihood of drawn preferences ``good over bad`` by Newton steps with a small ridge: the fit of few rows at hand."""
    both = np.vstack([good, bad])
    edges = np.quantile(both, np.arange(1, STEPS + 1) / (STEPS + 1), axis=0).T
    model = Preference(edges, np.zeros(edges.size), 0.0, 1.0)
    rng = np.random.default_rng(seed)
    left, right = model.steps(good), model.steps(bad)
    x = left[rng.integers(0, len(good), pairs)] - right[rng.integers(0, len(bad), pairs)]
    w = model.weights
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (1 - p) / pairs - RIDGE * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def _packed(rows: DataFrame, n: int) -> DataFrame:
    """The label and the values of all ``n`` rows (quality, values) as a stored table, up to ``BLOCK`` documents in a row.

    A task of the fit sends as many sums whatever its rows, so there are as many tasks as the rows need, not as the shuffle has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                label = part.column("quality").to_numpy(zero_copy_only=False).astype(np.float64)
                values = part.column("values").flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([label, values]).tobytes()], pa.binary())], ["block"])

    rows = rows.select("quality", "values").coalesce(max(1, -(-n // TASK_ROWS)))
    return stored(rows.mapInArrow(run, "block binary"), "quality-values")


def _unpacked(block: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(block, np.float64)
    n = len(numbers) // (1 + len(FEATURES))
    return numbers[:n], numbers[n:].reshape(n, len(FEATURES))


def quantiles(packed: DataFrame, n: int, parts: int) -> np.ndarray:
    """For each feature (not negative) the values at ``1 / parts``, ``2 / parts`` … of all ``n`` rows in order.

    The bits of such doubles are in the order of the values.  Rows are counted by
    ``DIGIT`` bits after another, the highest first, each time only those that
    agree with a wanted value so far.
    """
    rank = np.repeat([np.arange(1, parts) * (n - 1) // parts], len(FEATURES), axis=0)
    prefix = np.zeros(rank.shape, np.int64)
    for shift in range(64 // DIGIT * DIGIT, -1, -DIGIT):
        wanted = [np.unique(p) for p in prefix]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0):
                    bits = (_unpacked(block.as_buffer())[1] + 0.0).view(np.int64) >> shift
                    for i, own in enumerate(wanted):
                        found, counts = np.unique(bits[:, i], return_counts=True)
                        near = np.isin(found >> DIGIT, own)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(near.sum(), i, np.int32)), pa.array(found[near]), pa.array(counts[near])], ["i", "bits", "n"])

        found = packed.mapInArrow(run, "i int, bits long, n long").groupBy("i", "bits").agg(F.sum("n").alias("n")).toPandas().sort_values(["i", "bits"])
        for i in range(len(FEATURES)):
            own = found[found["i"] == i]
            bits, n_bits = own["bits"].to_numpy(np.int64), own["n"].to_numpy(np.int64)
            for k in range(parts - 1):
                inside = np.flatnonzero(bits >> DIGIT == prefix[i, k])
                ahead = np.cumsum(n_bits[inside])
                at = int(np.searchsorted(ahead, rank[i, k], side="right"))
                rank[i, k] -= ahead[at] - n_bits[inside[at]]
                prefix[i, k] = bits[inside[at]]
    return prefix.view(np.float64)


def _stepped(packed: DataFrame, edges: np.ndarray) -> DataFrame:
    """A stored table of the label and the number of edges below each value, a byte each, of all documents of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0):
                label, values = _unpacked(block.as_buffer())
                steps = [np.searchsorted(own, values[:, i]) for i, own in enumerate(edges)]
                yield pa.RecordBatch.from_arrays([pa.array([np.array([label, *steps]).astype(np.uint8).tobytes()], pa.binary())], ["block"])

    return stored(packed.mapInArrow(run, "block binary"), "quality-steps")


def _scored(block: pa.Buffer, height: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, steps and score of the documents of a block; ``height`` has the sum of a feature's weights up to each step."""
    numbers = np.frombuffer(block, np.uint8).reshape(1 + len(height), -1)
    return numbers[0], numbers[1:], sum(own[steps] for own, steps in zip(height, numbers[1:]))


def _wrong(ahead: np.ndarray) -> np.ndarray:
    """The chance that the document that is so far ahead is not preferred."""
    return 1 / (1 + np.exp(np.clip(ahead, -500, 500)))


@dataclass
class Pairs:
    """All pairs of a good and a bad document; ``n`` bad and good documents."""

    blocks: DataFrame
    n: tuple[int, int]

    def height(self, weights: np.ndarray) -> np.ndarray:
        return np.pad(np.cumsum(weights.reshape(len(FEATURES), STEPS), axis=1), ((0, 0), (1, 0)))

    def value(self, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean of ``-log`` of the chance of a pair, with the ridge, its gradient, and its curvature at rounded scores.

        Between ``POINTS`` points chances are interpolated: the error is below a hundredth of the squared distance of two points.
        """
        height = self.height(weights)
        low, high = height.min(axis=1).sum(), height.max(axis=1).sum()
        apart = max((high - low) / (POINTS - 1), 1e-9)

        def place(score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.clip((score - low) / apart, 0, POINTS - 1)
            point = np.minimum(at.astype(np.int64), POINTS - 2)
            return point, at - point, (at * ((COARSE - 1) / (POINTS - 1)) + 0.5).astype(np.int64)

        def spread(block: pa.Buffer) -> np.ndarray:
            label, _, score = _scored(block, height)
            point, part, coarse = place(score)
            point = point + label * np.int64(POINTS)
            fine = np.bincount(point, 1 - part, 2 * POINTS) + np.bincount(point + 1, part, 2 * POINTS)
            return np.concatenate([fine, np.bincount(coarse + label * np.int64(COARSE), minlength=2 * COARSE)])

        found = summed(self.blocks, "block", 2 * POINTS + 2 * COARSE, spread)
        of = np.array(self.n)[:, None]
        (bad, good), (bad_at, good_at) = found[: 2 * POINTS].reshape(2, POINTS) / of, found[2 * POINTS :].reshape(2, COARSE) / of
        ahead = np.subtract.outer(np.arange(POINTS), np.arange(POINTS)) * apart
        loss = good @ np.logaddexp(0, -ahead) @ bad
        wrong = _wrong(ahead)
        # How much a good document should rise, and a bad one fall, by its score; and how fast that changes.
        pull = np.stack([-(good @ wrong) / self.n[0], (wrong @ bad) / self.n[1]])
        doubt = _wrong(np.subtract.outer(np.arange(COARSE), np.arange(COARSE)) * ((high - low) / (COARSE - 1)))
        doubt = doubt * (1 - doubt)
        bend = np.stack([(good_at @ doubt) / self.n[0], (doubt @ bad_at) / self.n[1]])
        kinds, size = STEPS + 1, len(FEATURES) * (STEPS + 1)
        both = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]

        def slope(block: pa.Buffer) -> np.ndarray:
            label, steps, score = _scored(block, height)
            point, part, coarse = place(score)
            steps, label = steps.astype(np.int64), label.astype(np.int64)
            own, turn = pull[label, point] * (1 - part) + pull[label, point + 1] * part, bend[label, coarse]
            cell = (label * COARSE + coarse) * kinds
            return np.concatenate(
                [np.bincount(x, own, kinds) for x in steps]
                + [np.bincount(steps[i] * kinds + steps[j], turn, kinds * kinds) for i, j in both]
                + [np.bincount(cell + x, minlength=2 * COARSE * kinds) for x in steps]
            )

        found = summed(self.blocks, "block", size + len(both) * kinds**2 + 2 * COARSE * size, slope)
        rise, joint, cells = np.split(found, np.cumsum([size, len(both) * kinds**2]))
        square = np.zeros((len(FEATURES), kinds, len(FEATURES), kinds))
        for (i, j), part in zip(both, joint.reshape(-1, kinds, kinds)):
            square[i, :, j], square[j, :, i] = part, part.T
        bad_sums, good_sums = cells.reshape(len(FEATURES), 2, COARSE, kinds).transpose(1, 2, 0, 3).reshape(2, COARSE, size) / of[:, None]
        across = good_sums.T @ doubt @ bad_sums
        # From "holds so many edges" to "is above this edge".
        above = np.kron(np.eye(len(FEATURES)), np.arange(kinds) > np.arange(STEPS)[:, None])
        curve = above @ (square.reshape(size, size) - across - across.T) @ above.T
        return float(loss + RIDGE / 2 * (weights @ weights)), RIDGE * weights - above @ rise, curve + RIDGE * np.eye(len(weights))

    def fitted(self) -> np.ndarray:
        """The weights that make the preferences likeliest: Newton steps, halved until the loss falls."""
        weights = np.zeros(len(FEATURES) * STEPS)
        loss, slope, curve = self.value(weights)
        for _ in range(NEWTON):
            step, length = np.linalg.solve(curve, slope), 1.0
            if slope @ step < 1e-7:
                break
            for _ in range(8):
                there = self.value(weights - length * step)
                if there[0] <= loss - 1e-4 * length * (slope @ step):
                    break
                length /= 2
            else:
                break
            weights, (loss, slope, curve) = weights - length * step, there
        return weights

    def divided(self, model: Preference, share_bad: float) -> Preference:
        """Puts the threshold at the quantile of the training scores below which the bad share lies, in ``CELLS`` cells."""
        height = self.height(model.weights)
        low, high = height.min(axis=1).sum(), height.max(axis=1).sum()
        wide = max((high - low) / (CELLS - 1), 1e-12)

        def count(block: pa.Buffer) -> np.ndarray:
            label, _, score = _scored(block, height)
            return np.bincount(np.clip((score - low) / wide + 0.5, 0, CELLS - 1).astype(np.int64) + label * np.int64(CELLS), minlength=2 * CELLS)

        down, up = summed(self.blocks, "block", 2 * CELLS, count).reshape(2, CELLS)
        seen = np.cumsum(up / self.n[1] * (1 - share_bad) + down / self.n[0] * share_bad)
        some = np.flatnonzero(up + down)
        at = min(int(np.searchsorted(seen[some], share_bad - 1e-12)), len(some) - 1)
        model.middle = float(low + wide * (some[at] + some[min(at + 1, len(some) - 1)]) / 2)
        median_up, median_down = (np.searchsorted(np.cumsum(part), part.sum() / 2) for part in (up, down))
        model.scale = float(4 / max(wide * (median_up - median_down), 1e-6))
        return model


def _learn(features: DataFrame, labels: DataFrame) -> Preference | float:
    """The model fitted on all labelled ids, or the share of good labels where one label is missing."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = stored(known, "labels")
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return float(counts.get(1, 0)) / sum(counts.values()) if counts else 0.5
    # One row per id, however often it is repeated.
    rows = features.join(known, "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("values").alias("values"))
    rows = stored(rows.select("quality", "values"), "labelled")
    found = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(found) < 2:
        return counts[1] / (counts[0] + counts[1])
    n = found[0] + found[1]
    packed = _packed(rows, n)
    edges = quantiles(packed, n, STEPS + 1)
    pairs = Pairs(_stepped(packed, edges), (found[0], found[1]))
    return pairs.divided(Preference(edges, pairs.fitted(), 0.0, 1.0), counts[0] / (counts[0] + counts[1]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; labels of held-out ids are never read.

    Null and empty texts have the statistics of a text without words and get its
    score.  Contradicting labels of one id count as bad; labels other than 0 and
    1, and labels without a document, are ignored.  Where one of the two labels
    is missing, every score is the share of good labels (0.5 without labels).
    Repeated rows are scored one by one.  No rows give no rows.
    """
    measured = statistics(docs, "doc_id", shares=True)
    values = F.array(F.log1p("n_words").alias("log_words"), *SHARES)
    features = stored(measured.select("doc_id", values.alias("values"), *COUNTS), "features")
    model = _learn(features, labels)

    @F.pandas_udf("double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            if isinstance(model, float):
                yield pd.Series(np.full(len(part), model))
            else:
                yield pd.Series(model.score(np.array(part.tolist(), np.float64).reshape(len(part), len(FEATURES))))

    scored = features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("values").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
