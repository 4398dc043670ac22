"""Toxicity by multiple-instance learning: a document is as toxic as its sentences make it.

Only documents carry labels.  A sentence is toxic with the logistic chance of the
sum of its features' weights; a document is not toxic if none of its sentences
is, and no stray label hits it (leaky noisy-or).  The weights are learned from
the document labels alone, and the sentence chances then tell which sentences
made a document toxic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.llm.blocks import summed
from cartsight.llm.common import held_out, stored
from cartsight.llm.vectors import _LOWER, mix, pieces, powers

#: The model is fitted on a hash sample of about so many labelled documents of each label.
LABELLED = 10_000
#: Features of the model: those whose presence speaks most for the label 1, with a likelihood ratio that chance hardly gives.
FEATURES, LEAST_RATIO = 4_096, 15.0
#: Bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Sampled documents in a block of the fit.
BLOCK = 500
RIDGE = 1.0
STEPS = 60
#: A document counts as toxic, and a sentence as offending, from this chance on.
TOXIC = 0.3
#: What a sentence without features, and a document without sentences, start from; and each feature, which was chosen for the label 1:
#: from weights of 0 the descent can end where strays explain every label and no feature has a weight.
START, FEATURE_START = (-7.0, -3.0), 1.0

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), 39]] = True
_STOP, _SPACE = np.isin(np.arange(256), list(b".!?")), np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class Sentences:
    """Words of a text column and the sentence of each.

    Words are runs of ASCII letters, digits, apostrophes and all other characters beyond ASCII, A-Z as a-z.
    A sentence ends at a line end, and at ``.``, ``!`` or ``?`` before white space or the end of the text.
    """

    def __init__(self, column: pa.Array):
        column = pa.compute.fill_null(column, "").cast(pa.large_binary())
        self.n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + self.n + 1]
        data = column.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        size = len(self.bytes)
        cut = np.zeros(size + 1, bool)
        cut[self.offsets] = True
        inside = _IN_WORD[self.bytes]
        before, after = np.ones(size, bool), np.ones(size, bool)
        before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
        self.start = np.flatnonzero(inside & (before | cut[:-1]))
        self.end = np.flatnonzero(inside & (after | cut[1:])) + 1
        up, down = powers(size)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_LOWER[self.bytes] * up, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self._sums, self._down = total, down
        doc = np.searchsorted(self.offsets, self.start, "right") - 1
        following = np.ones(size, bool)
        following[:-1] = _SPACE[self.bytes[1:]]
        stops = np.concatenate([[0], np.cumsum((self.bytes == 10) | (_STOP[self.bytes] & (following | cut[1:])))])
        new = np.ones(len(self.start), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (stops[self.start[1:]] != stops[self.start[:-1]])
        self.sentence = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.doc = doc[self.first]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words, and of the beginnings of longer words; the sentence of each."""
        hashes, sentences = [self.hash], [self.sentence]
        for size in BEGINNINGS:
            longer = np.flatnonzero(self.end - self.start > size)
            start = self.start[longer]
            hashes.append(mix(mix((self._sums[start + size] - self._sums[start]) * self._down[start]) + np.uint64(size)))
            sentences.append(self.sentence[longer])
        return np.concatenate(hashes), np.concatenate(sentences)

    def known(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sentence and number of every feature of ``vocabulary`` (sorted) in a sentence, each once."""
        if not len(vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes, sentence = self.features()
        at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        found = vocabulary[at] == hashes
        keys = np.unique(sentence[found] * len(vocabulary) + at[found])
        return keys // len(vocabulary), keys % len(vocabulary)

    def spans(self, sentences: np.ndarray) -> list[str | None]:
        """``start:end`` of the sentences given, first word to last, in code points, joined by commas for each text; None for none."""
        out: list[str | None] = [None] * self.n
        if len(sentences):
            last = np.append(self.first[1:], len(self.start)) - 1
            points = np.concatenate([[0], np.cumsum((self.bytes & 0xC0) != 0x80)])
            base = points[self.offsets[self.doc[sentences]]]
            starts, ends = points[self.start[self.first[sentences]]] - base, points[self.end[last[sentences]]] - base
            for doc, start, end in zip(self.doc[sentences], starts, ends):
                out[doc] = f"{out[doc]},{start}:{end}" if out[doc] else f"{start}:{end}"
        return out


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class NoisyOr:
    """Sorted feature hashes, the weight of each, the weight of every sentence and that of a stray label."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float
    stray: float

    def sentence_scores(self, texts: Sentences) -> np.ndarray:
        sentence, feature = texts.known(self.vocabulary)
        return self.bias + np.bincount(sentence, weights=self.weights[feature], minlength=len(texts.first))

    def score(self, texts: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """The chance of every text, and of every sentence."""
        z = self.sentence_scores(texts)
        none = np.bincount(texts.doc, weights=_softplus(z), minlength=texts.n) + _softplus(self.stray)
        return -np.expm1(-none), _logistic(z)


def loss_and_gradient(weights: np.ndarray, label: np.ndarray, share: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Negative log-likelihood of the labels and its gradient.

    ``weights`` ends with the weight of every sentence and that of a stray label; ``share`` is what a
    document counts, ``doc`` the document of each sentence, ``sentence`` and ``feature`` the pairs present.
    """
    w, bias, stray = weights[:-2], weights[-2], weights[-1]
    z = bias + np.bincount(sentence, weights=w[feature], minlength=len(doc))
    none = np.bincount(doc, weights=_softplus(z), minlength=len(label)) + _softplus(stray)
    some = np.maximum(-np.expm1(-none), 1e-300)
    loss = share @ np.where(label == 1, -np.log(some), none)
    slope = share * np.where(label == 1, -np.exp(-none) / some, 1.0)
    per_sentence = slope[doc] * _logistic(z)
    return np.concatenate([[loss], np.bincount(feature, weights=per_sentence[sentence], minlength=len(w)), [per_sentence.sum(), slope.sum() * _logistic(stray)]])


def minimised(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = STEPS, memory: int = 10) -> np.ndarray:
    """Quasi-Newton descent with limited memory; a step is halved until it lowers the value."""
    x, (f, g) = start, value(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, used = g.copy(), []
        for s, y in reversed(moves):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        q *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.linalg.norm(g))
        for (s, y), a in zip(moves, reversed(used)):
            q += (a - (y @ q) / (s @ y)) * s
        length, slope = 1.0, -(g @ q)
        if slope > -1e-9 * max(1.0, abs(f)):
            break
        for _ in range(20):
            there = x - length * q
            f_there, g_there = value(there)
            if f_there <= f + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        s, y = there - x, g_there - g
        if s @ y > 1e-12 * (y @ y):
            moves = [*moves, (s, y)][-memory:]
        done = f - f_there < 1e-7 * max(1.0, abs(f))
        x, f, g = there, f_there, g_there
        if done:
            break
    return x


def _features_with_labels(rows: DataFrame) -> DataFrame:
    """``feature`` and the numbers of documents of either label that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = Sentences(piece.column("text"))
                label = piece.column("toxic").to_numpy(zero_copy_only=False)
                hashes, sentence = texts.features()
                doc = texts.doc[sentence]
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                hashes, doc = hashes[new], doc[new]
                first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
                toxic = np.add.reduceat(label[doc] == 1, first, dtype=np.int64) if len(first) else first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[first].view(np.int64)), pa.array(toxic), pa.array(np.diff(np.append(first, len(hashes))) - toxic)], ["feature", "toxic", "clean"]
                )

    found = rows.select("text", "toxic").mapInArrow(run, "feature long, toxic long, clean long")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def vocabulary(rows: DataFrame, docs: dict[int, int], size: int = FEATURES, least: float = LEAST_RATIO) -> np.ndarray:
    """The sorted hashes of the ``size`` features whose presence speaks most for the label 1 (likelihood ratio of ``least`` on; ties by hash)."""
    n1, n0 = F.lit(float(docs[1])), F.lit(float(docs[0]))
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")

    def part(seen, of):
        return F.when(seen > 0, seen * F.log(seen / of)).otherwise(0.0)

    share = (t + c) / (n1 + n0)
    ratio = 2 * F.round(part(t, n1 * share) + part(c, n0 * share) + part(n1 - t, n1 * (1 - share)) + part(n0 - c, n0 * (1 - share)), 6)
    found = _features_with_labels(rows).where(t / n1 > c / n0).withColumn("ratio", ratio).where(F.col("ratio") >= least)
    chosen = found.orderBy(F.desc("ratio"), "feature").limit(size)
    return np.sort(np.array([r["feature"] for r in chosen.select("feature").collect()], np.int64).view(np.uint64))


def _blocks(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """The features of the sampled documents as a stored table, ``BLOCK`` documents in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                for piece in pieces(batch.slice(at, BLOCK), "text"):
                    texts = Sentences(piece.column("text"))
                    label = piece.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
                    sentence, feature = texts.known(words)
                    arrays = (label, texts.doc, sentence, feature)
                    head = np.array([len(a) for a in arrays], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([head, *arrays]).astype(np.int64).tobytes()], pa.binary())], ["block"])

    return stored(rows.select("text", "toxic").mapInArrow(run, "block binary"), "toxicity-blocks")


def sampled(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic`` of a hash sample of the labelled ids that are not held out, and how many ids have either label.

    An id gives one row: of repeated rows that with the least text.  Contradicting labels of one id count as toxic.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxicity-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chance = F.when(F.col("toxic") == 1, min(1.0, sample / max(counts.get(1, 0), 1))).otherwise(min(1.0, sample / max(counts.get(0, 0), 1)))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) < chance * (1 << 20))
    # One row per drawn id and about ``sample`` ids of each label: small enough to send, so that no text is shuffled but the drawn ones.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return stored(rows, "toxicity-sample"), counts


def learn(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> NoisyOr:
    """The model of the labels that are not held out; without one of the two labels it only holds the share of toxic ids (0.5 without labels)."""
    rows, counts = sampled(docs, labels, sample)
    drawn = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not drawn.get(0) or not drawn.get(1):
        share = min(max(counts.get(1, 0) / sum(counts.values()), 1e-6), 1 - 1e-6) if counts else 0.5
        return NoisyOr(np.zeros(0, np.uint64), np.zeros(0), -500.0, float(np.log(share / (1 - share))))
    # Both labels count as often as they occur among all labelled ids.
    share = {y: (counts[y] / sum(counts.values())) / (drawn[y] / sum(drawn.values())) for y in (0, 1)}
    words = vocabulary(rows, drawn)
    blocks, size = _blocks(rows, words), len(words)

    def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def part(block: pa.Buffer) -> np.ndarray:
            numbers = np.frombuffer(block, np.int64)
            label, doc, sentence, feature = np.split(numbers[4:], np.cumsum(numbers[:3]))
            return loss_and_gradient(weights, label, np.where(label == 1, share[1], share[0]), doc, sentence, feature)

        found = summed(blocks, "block", size + 3, part)
        found[0] += RIDGE / 2 * (weights[:-2] @ weights[:-2])
        found[1:-2] += RIDGE * weights[:-2]
        return found[0], found[1:]

    weights = minimised(value, np.concatenate([np.full(size, FEATURE_START), START]))
    return NoisyOr(words, weights[:-2], float(weights[-2]), float(weights[-1]))


def judged(docs: DataFrame, model: NoisyOr, *keys: str) -> DataFrame:
    """``keys``, ``score``, ``n_sentences``, ``n_offending``, ``worst`` (the highest chance of a sentence, null without one) and
    ``offending`` (code point spans of the sentences from ``TOXIC`` on, empty for none) of every row of ``docs``."""
    names = [*keys, "score", "n_sentences", "n_offending", "worst", "offending"]
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = Sentences(piece.column("text"))
                score, chance = model.score(texts)
                bad = np.flatnonzero(chance >= TOXIC)
                worst = np.full(texts.n, -1.0)
                np.maximum.at(worst, texts.doc, chance)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(k) for k in keys]
                    + [
                        pa.array(score),
                        pa.array(np.bincount(texts.doc, minlength=texts.n).astype(np.int64)),
                        pa.array(np.bincount(texts.doc[bad], minlength=texts.n).astype(np.int64)),
                        pa.array(worst, mask=worst < 0),
                        pa.array([s or "" for s in texts.spans(bad)]),
                    ],
                    names,
                )

    return docs.select(*keys, "text").mapInArrow(run, f"{kinds}, score double, n_sentences long, n_offending long, worst double, offending string")


def score(docs: DataFrame, labels: DataFrame, sample: int = LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and what :func:`judged` finds, for every row of ``docs``; labels of held-out ids are never read.

    Null and empty texts, and texts without a word, have no sentences and the
    chance of a stray label.  Labels other than 0 and 1, and labels without a
    document, are ignored.  Where one of the two labels is missing, every score
    is the share of toxic labels (0.5 without labels).  Repeated rows are
    scored one by one, equal texts alike; null ids are held out.  No rows give
    no rows.  Other columns, whatever their names, are not read.
    """
    found = judged(docs, learn(docs, labels, sample), "doc_id")
    first = [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("score"), (F.col("score") >= TOXIC).cast("int").alias("predicted")]
    return found.select(*first, "n_sentences", "n_offending", "worst", "offending")
