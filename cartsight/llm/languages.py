"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the characters of its words, padded at both ends.
Counts come from all training rows, as Spark aggregates over distinct words; the
models are tables, and sorted arrays of n-gram hashes where those may be broadcast.  A text gets the language with the
lowest cross-entropy per character; texts that even the best model explains much
worse than it explains its own training texts are rejected.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.common import held_out, stored, text_key, without
from cartsight.llm.grams import END, ORDER, START, Tables, measured_by_joins, model_tables
from cartsight.llm.vectors import mix, pieces, powers

#: Cells (n-grams and contexts times languages) up to which the models are broadcast as arrays; beyond, texts are joined with
#: the tables.  Both ways use every n-gram and give the same scores.
PACKED_CELLS = 40_000_000
#: A text is rejected when its cross-entropy exceeds the median of its language by so many times the training spread.
SLACK = 5.0
#: Characters of a text that count as evidence in the score.
EVIDENCE = 50
#: Word scores that a task remembers.
REMEMBERED = 400_000
UNDETERMINED = "und"


def _roll(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` codes that end at each position from ``width - 1`` on."""
    n = len(codes) - width + 1
    out = np.full(max(n, 0), width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64))
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in the sorted array; the last index for those that are missing."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, len(keys))


@dataclass
class Models:
    """For each order: sorted hashes of n-grams with their discounted probabilities, and of contexts with their back-off weights, a column per language.

    The last row of every table serves what is missing: probability 0 and weight 1.
    """

    languages: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    chances: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def log_chances(self, codes: np.ndarray) -> np.ndarray:
        """Logarithms of the probability of each code from ``ORDER - 1`` on, a column per language."""
        n = len(codes) - ORDER + 1
        out = np.repeat(self.floor[None], n, axis=0)
        for k in range(1, ORDER + 1):
            tail = codes[ORDER - k :]
            found = self.chances[k - 1][_find(self.grams[k - 1], _roll(tail, k))]
            if k == 1:
                out = found + out
            else:
                out = found + self.weights[k - 1][_find(self.contexts[k - 1], _roll(tail[:-1], k - 1))] * out
        return np.log(out)


def _rows_hash(codes: np.ndarray) -> np.ndarray:
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for k in range(codes.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[:, k].astype(np.uint64))
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([p[0] for p in parts]))
    table = np.full((len(keys) + 1, len(parts)), missing, np.float32)
    for i, (hashes, values) in enumerate(parts):
        table[np.searchsorted(keys, hashes), i] = values
    return keys, table


def pack(tables: Tables) -> Models:
    """The tables as sorted arrays, every n-gram of them; for tables of a size that may be broadcast."""
    floors = {r["lang"]: r["value"] for r in tables.floors.collect()}
    models = Models(sorted(floors), floor=np.array([floors[lang] for lang in sorted(floors)], np.float32))
    number = {lang: i for i, lang in enumerate(models.languages)}
    for k in range(1, ORDER + 1):
        for rows, width, keys, columns, missing in (
            (tables.chances, k, models.grams, models.chances, 0.0), (tables.weights, k - 1, models.contexts, models.weights, 1.0)
        ):
            arrow = rows.where(F.col("k") == k).select("lang", "gram", "value").toArrow()
            texts = arrow.column("gram").to_pylist()
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").reshape(len(texts), width)
            owner = np.array([number[lang] for lang in arrow.column("lang").to_pylist()], np.int64)
            hashes, values = _rows_hash(codes), arrow.column("value").to_numpy()
            merged, table = _merged([(hashes[owner == i], values[owner == i]) for i in range(len(number))], missing)
            keys.append(merged)
            columns.append(table)
    return models


def cells_of(tables: Tables) -> int:
    """Cells of the packed models, at most: rows of the tables times languages."""
    return (tables.chances.count() + tables.weights.count()) * tables.floors.count()


_letters: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0][codes]


class _Scorer:
    """Sums of log chances per text; the scores of words are remembered between batches."""

    def __init__(self, models: Models):
        self.models = models
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros((0, len(models.languages)), np.float32)

    def _new_words(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = ends - starts + ORDER
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        padded = np.full(offsets[-1], START, np.uint32)
        inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
        where = inside >= ORDER - 1
        padded[where] = codes[np.minimum((np.repeat(starts, lengths) + inside - ORDER + 1)[where], len(codes) - 1)]
        padded[offsets[1:] - 1] = END
        chances = self.models.log_chances(padded)
        valid = where[ORDER - 1 :]
        return np.add.reduceat(np.where(valid[:, None], chances, 0), offsets[:-1], axis=0).astype(np.float32)

    def sums(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: letters, predicted characters, and the sum of log chances under each language."""
        texts = [(t or "").lower() for t in column.to_pylist()]
        n = len(texts)
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        letter = np.zeros(len(codes) + 2, bool)
        letter[1:-1] = _is_letter(codes)
        starts = np.flatnonzero(letter[1:-1] & ~letter[:-2])
        ends = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1
        up, down = powers(len(codes))
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(7)) * up, out=total[1:])
        words = mix((total[ends] - total[starts]) * down[starts])
        owner = np.searchsorted(offsets, starts, "right") - 1
        kinds, first, inverse = np.unique(words, return_index=True, return_inverse=True)
        fresh = ~np.isin(kinds, self.keys, assume_unique=True)
        if fresh.any():
            scored = self._new_words(codes, starts[first[fresh]], ends[first[fresh]])
            if len(self.keys) + len(scored) > REMEMBERED:
                known = np.isin(self.keys, kinds, assume_unique=True)
                self.keys, self.values = self.keys[known], self.values[known]
            keys = np.concatenate([self.keys, kinds[fresh]])
            order = np.argsort(keys)
            self.keys, self.values = keys[order], np.vstack([self.values, scored])[order]
        values = self.values[np.searchsorted(self.keys, kinds)]
        lengths = (ends - starts).astype(np.float64)
        letters = np.bincount(owner, weights=lengths, minlength=n).astype(np.int64)
        characters = letters + np.bincount(owner, minlength=n)
        sums = np.stack([np.bincount(owner, weights=values[inverse, i], minlength=n) for i in range(values.shape[1])], axis=1)
        return letters, characters, sums


def _measured(docs: DataFrame, models: Models, keys: list[str]) -> DataFrame:
    """``keys``, the best language, its cross-entropy per character, the score, and the counts of letters and characters."""
    schema = T.StructType([docs.schema[k] for k in keys] + [
        T.StructField("best", T.StringType()), T.StructField("entropy", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("letters", T.LongType()), T.StructField("characters", T.LongType()),
    ])
    carried = docs.sparkSession.sparkContext.broadcast(vars(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(Models(**carried.value))
        names = np.array(scorer.models.languages, object)
        for batch in batches:
            for piece in pieces(batch, "text"):
                letters, characters, sums = scorer.sums(piece.column("text"))
                entropy = -sums / np.maximum(characters, 1)[:, None]
                best = entropy.argmin(axis=1)
                lowest = entropy[np.arange(len(best)), best]
                chance = 1 / np.exp((lowest[:, None] - entropy) * np.minimum(characters, EVIDENCE)[:, None]).sum(axis=1)
                some = letters > 0
                yield pa.RecordBatch.from_arrays([
                    *(piece.column(k) for k in keys), pa.array(np.where(some, names[best], None), pa.string()),
                    pa.array(np.where(some, lowest, 0.0)), pa.array(np.where(some, chance, 0.0)), pa.array(letters), pa.array(characters),
                ], schema.names)

    return docs.select(*keys, "text").mapInArrow(run, schema)


def identify(docs: DataFrame, key: bool = False, packed_cells: int = PACKED_CELLS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected, entropy`` for every row of ``docs``; with ``key``, also ``text_key``.

    Models learn from the rows with a language and an id outside the held-out
    quarter; language, source and id are no inputs of a prediction.  A null
    text, or one without a letter, is ``und`` with score 0 and rejected; so is
    every text when no row can be learned from.  A text is rejected too when its
    cross-entropy lies further above the median of its language than ``SLACK``
    times the 99 % quantile of the training texts' own deviations, which are
    allowed to be larger for shorter texts.  Equal scores give the first
    language by name.  Repeated rows are predicted alike.  No rows give no rows.
    """
    keyed = docs.select("doc_id", "lang", "text", text_key(F.col("text")).alias("text_key"))
    training = keyed.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    tables = model_tables(training.select("lang", "text"))
    columns = ["doc_id", *(["text_key"] if key else [])]
    held = held_out(F.col("doc_id")).alias("held_out")
    if tables.floors.isEmpty():
        return keyed.select(
            *columns, held, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("entropy")
        )
    kept = ["doc_id", "lang", "text_key"]
    if cells_of(tables) <= packed_cells:
        measured = stored(_measured(keyed, pack(tables), kept), "entropies")
    else:
        measured = stored(measured_by_joins(keyed, tables, kept, EVIDENCE), "entropies")
    own = measured.where((F.col("best") == F.col("lang")) & ~held_out(F.col("doc_id")))
    middle = stored(own.groupBy("best").agg(F.percentile_approx("entropy", 0.5).alias("middle")), "middles")
    off = own.join(middle, "best").select("best", F.abs(F.col("entropy") - F.col("middle")).alias("off"), "characters")
    spread = off.groupBy("best").agg(
        F.percentile_approx("off", 0.99).alias("wide"), F.percentile_approx(F.col("off") * F.sqrt("characters"), 0.99).alias("short")
    )
    limits = stored(middle.join(spread, "best"), "limits")
    far = F.col("entropy") - F.col("middle") > SLACK * F.greatest("wide", F.col("short") / F.sqrt(F.greatest(F.col("characters"), F.lit(1))))
    return measured.join(limits, "best", "left").select(
        *columns, held, F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"), "score",
        (F.col("best").isNull() | F.coalesce(far, F.lit(False))).alias("rejected"), F.when(F.col("best").isNotNull(), F.col("entropy")).alias("entropy"),
    )


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`identify` does not reject, with their columns as they are.

    Null texts and texts without a letter are rejected.  Equal texts are judged
    alike, and repeated rows stay as often as they are.  No rows give no rows.
    """
    rejected = identify(docs, key=True).where("rejected").select("text_key")
    return without(docs, stored(rejected, "rejected"))
