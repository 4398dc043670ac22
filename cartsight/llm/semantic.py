"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed words.  A randomised singular value
decomposition, whose products with the passage matrix are Spark jobs, gives a
latent space; the windows of all documents that lie near a benchmark item in it
are candidates.  Items of few words, which the space cannot tell apart, find
theirs by an index of their rarest words.  Candidates are checked by the words in
common, then by the longest common subsequence, and by the item's answer where
that is not decisive.
"""

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.common import stored, text_key, without
from cartsight.llm.vectors import Texts, mix, pieces

#: Columns that words are hashed to, dimensions of the latent space, and the extra ones of the random projection.
COLUMNS = 1 << 15
DIMENSIONS = 64
EXTRA = 16
#: Words of the passages that the decomposition is fitted on.
PASSAGE = 64
#: Distinct passages that a task writes for the products, and those that a task holds while it reads texts.
TASK_PASSAGES = 100_000
HELD_PASSAGES = 50_000
#: Passages multiplied at once, and their words that one small product adds.
TOGETHER_PASSAGES = 20_000
UNIT = 16
#: Words whose vectors are gathered at once: they stay in the cache.
GATHER = 4096
#: Windows start every so many words; an item is compared with windows of the first size that holds it and half a step more.
BLOCK = 12
SIZES = (1, 2, 3, 4, 5, 6, 8, 9)
#: Items with more words are cut into passages, each searched on its own.
LONG_ITEM = 96
#: Items searched in one pass over the documents: bounds what is broadcast.
ITEMS = 10_000
#: Items whose cosines with some windows are computed at once: bounds what a task holds.
TOGETHER = 2048
#: Least cosine of a candidate that fills its window; in a longer window the other words lengthen its vector, and the least cosine falls.
COSINE = 0.3
#: Items with fewer words are found by their rarest words, not in the space.
FEW_WORDS = 16
#: Parts of an item's words that prove a copy, and that need the answer besides; part of the answer's words that counts.
COPY, PARAPHRASE, ANSWER = 0.7, 0.5, 0.8
#: Shorter items must be found whole.
SHORT_ITEM = 8


def _columns(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (COLUMNS - 1)


def _distinct_rows(owner: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, column and count of every distinct pair, by owner."""
    pairs, counts = np.unique(owner * COLUMNS + columns, return_counts=True)
    return pairs // COLUMNS, pairs % COLUMNS, counts


def _passages(texts: Texts) -> np.ndarray:
    """Number of the passage of each word, over the whole batch."""
    inside = np.arange(len(texts.hash)) - texts.first[texts.doc]
    starts = (inside % PASSAGE == 0).cumsum() - 1
    return starts


def _counted(texts: DataFrame) -> DataFrame:
    """Counts of passages over all texts, and every passage, equal ones that a task holds together once.

    ``column, n``: passages that hold a word of the column (column null: all
    passages), a row per task.  ``key, words``: a passage, its columns as 16-bit
    numbers, and what its content is known by.
    """
    schema = T.StructType([
        T.StructField("column", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("key", T.LongType()), T.StructField("words", T.BinaryType()),
    ])

    def written(held: dict[int, bytes]) -> pa.RecordBatch:
        none = pa.nulls(len(held), pa.int32()), pa.nulls(len(held), pa.int64())
        return pa.RecordBatch.from_arrays([*none, pa.array([*held], pa.int64()), pa.array([*held.values()], pa.binary())], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total, held = np.zeros(COLUMNS, np.int64), 0, {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Texts(piece.column("text"), lower=True)
                if not len(words.hash):
                    continue
                owner, columns = _passages(words), _columns(words.hash)
                counts += np.bincount(_distinct_rows(owner, columns)[1], minlength=COLUMNS)
                total += int(owner[-1]) + 1
                bounds = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
                inside = np.arange(len(owner)) - bounds[owner]
                keys = mix(np.add.reduceat(mix(words.hash + inside.astype(np.uint64)), bounds[:-1])).view(np.int64)
                kinds, at = np.unique(keys, return_index=True)
                small = columns.astype(np.uint16)
                for key, i in zip(kinds.tolist(), at.tolist()):
                    if key not in held:
                        held[key] = small[bounds[i] : bounds[i + 1]].tobytes()
                if len(held) >= HELD_PASSAGES:
                    yield written(held)
                    held = {}
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array([*some, None], pa.int32()), pa.array([*counts[some], total], pa.int64()), pa.nulls(len(some) + 1, pa.int64()), pa.nulls(len(some) + 1, pa.binary()),
        ], schema.names)
        if held:
            yield written(held)

    return texts.select("text").mapInArrow(run, schema)


def _sums(values: np.ndarray, index: np.ndarray, first: np.ndarray, unit: int = 4) -> np.ndarray:
    """Sums of the rows of ``values`` at ``index``, by runs that start at ``first``: of ``unit`` rows each by small products, then of these."""
    if not len(first):
        return np.zeros((0, values.shape[1]), np.float32)
    ends = np.append(first[1:], len(index))
    units = -(-(ends - first) // unit)
    start = np.cumsum(units) - units
    inside = (np.repeat(first - start * unit, units) + np.arange(units.sum()) * unit)[:, None] + np.arange(unit)
    counted = (inside < np.repeat(ends, units)[:, None]).astype(values.dtype)[:, None, :]
    rows = index[np.minimum(inside, len(index) - 1)]
    parts = np.empty((len(rows), 1, values.shape[1]), values.dtype)
    step = max(1, GATHER // unit)
    room = np.empty((step * unit, values.shape[1]), values.dtype)
    for at in range(0, len(rows), step):
        own = rows[at : at + step]
        gathered = np.take(values, own.ravel(), axis=0, out=room[: own.size], mode="clip")
        np.matmul(counted[at : at + step], gathered.reshape(len(own), unit, -1), out=parts[at : at + step])
    sums = parts[:, 0] if len(rows) == len(first) else np.add.reduceat(parts[:, 0], start, axis=0)
    return sums.astype(np.float32, copy=False)


def _add_product(total: np.ndarray, owner: np.ndarray, columns: np.ndarray, idf: np.ndarray, vectors: np.ndarray) -> None:
    """Adds ``A'(A basis)`` to ``total``, but for the weights of its rows, for the unit TF-IDF rows A of some passages; ``vectors`` are the basis times ``idf``."""
    order = np.argsort(columns.astype(np.uint16), kind="stable")
    kinds, rows = columns[order], owner[order]
    new = np.ones(len(kinds), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(kinds)))
    norms = np.bincount(rows[first], weights=(counts * idf[kinds[first]]) ** 2)
    latent = _sums(vectors, columns, np.flatnonzero(np.diff(owner, prepend=-1)), UNIT) / np.maximum(norms, 1e-24)[:, None].astype(np.float32)
    first = np.flatnonzero(np.diff(kinds, prepend=-1))
    total[kinds[first]] += _sums(latent, rows, first, UNIT)


def _product(passages: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A'(A basis)`` over the passages A (``words``: columns as 16-bit numbers); tasks send their sums, Spark adds them up."""
    width = basis.shape[1]
    carried = passages.sparkSession.sparkContext.broadcast((idf, (idf[:, None] * basis).astype(np.float32)))
    schema = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("values", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vectors = carried.value
        total = np.zeros((COLUMNS, width))
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER_PASSAGES):
                rows = batch.column(0).slice(at, TOGETHER_PASSAGES)
                ends = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1].astype(np.int64) // 2
                words = np.frombuffer(rows.buffers()[2], np.uint16)[ends[0] : ends[-1]]
                _add_product(total, np.repeat(np.arange(len(rows)), np.diff(ends)), words.astype(np.int64), weights, vectors)
        total *= weights[:, None]
        some = np.flatnonzero(np.abs(total).sum(axis=1))
        for at in range(0, len(some), 4096):
            part = some[at : at + 4096]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * width), pa.array(total[part].astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), lists], schema.names)

    sums = passages.select("words").mapInArrow(run, schema).groupBy("row").agg(F.array(*(F.sum(F.get("values", F.lit(i))).cast("float") for i in range(width))).alias("values"))
    out = np.zeros((COLUMNS, width))
    for row in sums.toLocalIterator():
        out[row["row"]] = row["values"]
    carried.destroy()
    return out


@dataclass
class Space:
    """Weight of every word column, and weight times latent vector."""

    weights: np.ndarray
    vectors: np.ndarray


def _distinct(counted: DataFrame) -> DataFrame:
    """``key, words`` of every distinct passage, about ``TASK_PASSAGES`` in a file, in one order."""
    written = counted.where("words IS NOT NULL").select("key", "words")
    tasks = max(1, -(-written.count() // TASK_PASSAGES))
    return stored(written.repartition(tasks, "key").dropDuplicates(["key"]), "distinct")


def fit(docs: DataFrame, items: DataFrame) -> Space:
    """The latent space of ``docs`` and ``items`` (text).

    Words are weighted by the passages of all texts that hold them.  The
    directions are fitted on all distinct passages: randomised range finding that
    starts in the range of all passages of the items (of all, where the items have
    none), since these are what the space is to tell apart; the product with all
    passages is the power step and gives the decomposition (Nystroem).
    Directions are scaled to equal spread over the passages: else the few that
    tell languages apart would make all passages of a language alike.  The
    matrices on the driver have ``COLUMNS`` rows and ``DIMENSIONS + EXTRA``
    columns, whatever the input.
    """
    sought = stored(_counted(items), "passages")
    gathered = stored(_counted(docs), "passages").unionByName(sought)
    frequencies = gathered.where("n IS NOT NULL").groupBy("column").agg(F.sum("n").alias("n")).toPandas()
    everything = frequencies.loc[frequencies["column"].isna(), "n"].sum()
    known = frequencies.dropna(subset="column")
    idf = np.full(COLUMNS, np.log(1.0 + everything))
    idf[known["column"].to_numpy(np.int64)] = np.log((1.0 + everything) / (1.0 + known["n"].to_numpy(np.float64))) + 1e-3
    passages, sought = (_distinct(part) for part in (gathered, sought))
    basis = np.random.default_rng(11).standard_normal((COLUMNS, DIMENSIONS + EXTRA))
    found = _product(passages if sought.isEmpty() else sought, idf, basis)
    basis *= 1e-9  # in place, here and below: the driver holds few matrices at a time
    found += basis
    del basis
    basis = np.linalg.qr(found)[0]
    del found
    product = _product(passages, idf, basis)
    inner = basis.T @ product
    del basis
    values, axes = np.linalg.eigh((inner + inner.T) / 2)
    kept = values > 1e-6 * max(values[-1], 1e-9)
    product = product @ (axes[:, kept] / np.sqrt(values[kept]))
    axes, strength, _ = np.linalg.svd(product, full_matrices=False)
    del product
    scale = 1 / np.maximum(strength[:DIMENSIONS], 1e-5)
    return Space(idf.astype(np.float32), (idf[:, None] * axes[:, :DIMENSIONS] * scale).astype(np.float32))


@dataclass
class Queries:
    """Benchmark passages: ids, words and answer words as hashes, words of the item before and after the passage, latent unit vectors, and indexes by window size."""

    ids: list
    words: list[list[int]]
    answers: list[list[int]]
    around: list[tuple[int, int]]
    vectors: np.ndarray
    by_size: dict[int, np.ndarray]

    def least(self, query: int) -> float:
        """Words in common below which no verdict is a leak."""
        n = len(self.words[query])
        return float(n) if n < SHORT_ITEM else (PARAPHRASE if self.answers[query] else COPY) * n


def answer_of(text: str) -> str:
    """What follows the last question mark or colon, else the last sentence."""
    body = text.strip()
    for mark in ("?", ":"):
        head, found, tail = body.rpartition(mark)
        if found and tail.strip():
            return tail
    return body.rstrip(".!? \n\t").rpartition(". ")[2]


def prepare(items: list[tuple[object, str | None]], space: Space) -> Queries:
    texts = Texts(pa.array([t or "" for _, t in items], pa.string()), lower=True)
    answers = Texts(pa.array([answer_of(t or "") for _, t in items], pa.string()), lower=True)
    out = Queries([], [], [], [], np.zeros((0, space.vectors.shape[1]), np.float32), {})
    vectors, by_size = [], {}
    for i, (item, _) in enumerate(items):
        words = texts.hash[texts.first[i] : texts.first[i + 1]]
        answer = answers.hash[answers.first[i] : answers.first[i + 1]].tolist()
        starts = [0] if len(words) <= LONG_ITEM else [*range(0, len(words) - PASSAGE, PASSAGE), len(words) - PASSAGE]
        for at in starts:
            part = words if len(starts) == 1 else words[at : at + PASSAGE]
            if len(part):
                vector = space.vectors[_columns(part)].sum(axis=0)
                size = next((s for s in SIZES if s * BLOCK >= len(part) + BLOCK // 2), SIZES[-1])
                by_size.setdefault(size, []).append(len(out.ids))
                vectors.append(vector / max(np.linalg.norm(vector), 1e-12))
                out.ids.append(item)
                out.words.append(part.tolist())
                out.answers.append(answer)
                out.around.append((at, len(words) - at - len(part)))
    out.vectors = np.array(vectors, np.float32).reshape(-1, space.vectors.shape[1])
    out.by_size = {size: np.array(found) for size, found in by_size.items()}
    return out


def common_subsequence(needle: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of the needle."""
    masks: dict[int, int] = {}
    for i, w in enumerate(needle):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(needle)) - 1
    free = full
    for w in words:
        hit = free & masks.get(w, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(needle) - free.bit_count()


def verdict(needle: list[int], answer: list[int], words: list[int], around: list[int] | None = None) -> tuple[int, bool]:
    """Words in common, in order, and whether they prove a leak; the answer is looked for in ``around``, by default in ``words``."""
    shared = common_subsequence(needle, words)
    if len(needle) < SHORT_ITEM:
        return shared, any(words[i : i + len(needle)] == needle for i in range(len(words) - len(needle) + 1))
    if shared >= COPY * len(needle):
        return shared, True
    if shared < PARAPHRASE * len(needle) or not answer:
        return shared, False
    return shared, common_subsequence(answer, words if around is None else around) >= ANSWER * len(answer)


@dataclass
class RareWords:
    """Index of the rarest words of the items with few words: columns in order, with the item of each."""

    columns: np.ndarray
    queries: np.ndarray


def rare_words(queries: Queries, space: Space) -> RareWords:
    """As many of the rarest words of each item as a window may lack and one more: a window that has none of them is no leak."""
    rows = []
    for index in queries.by_size.values():
        for query in index:
            columns = _columns(np.array(queries.words[query], np.uint64))
            if len(columns) < FEW_WORDS:
                lacking = len(columns) - int(np.ceil(queries.least(query) - 1e-9))
                rarest = columns[np.lexsort((columns, -space.weights[columns]))][: lacking + 1]
                rows += [(int(c), int(query)) for c in np.unique(rarest)]
    found = np.array(sorted(rows), np.int64).reshape(-1, 2)
    return RareWords(found[:, 0], found[:, 1])


def _in_common(needle: list[int], columns: np.ndarray) -> np.ndarray:
    """Words that each row of ``columns`` (``COLUMNS``: none) has in common with the needle, repeats counted on both sides; never below the common subsequence."""
    kinds, wanted = np.unique(_columns(np.array(needle, np.uint64)), return_counts=True)
    slot = np.full(COLUMNS + 1, len(kinds), np.int64)
    slot[kinds] = np.arange(len(kinds))
    cells = slot[columns] + np.arange(len(columns))[:, None] * (len(kinds) + 1)
    counts = np.bincount(cells.ravel(), minlength=len(columns) * (len(kinds) + 1)).reshape(len(columns), -1)
    return np.minimum(counts[:, :-1], wanted).sum(axis=1)


def _by_words(columns: np.ndarray, block: np.ndarray, low: np.ndarray, high: np.ndarray, queries: Queries, rare: RareWords) -> Iterator[tuple[int, int, np.ndarray]]:
    """(query, window size, windows that hold one of its rarest words), windows as their first block."""
    if not len(rare.columns):
        return
    bounds = np.searchsorted(rare.columns, np.arange(COLUMNS + 1))
    left, right = bounds[columns], bounds[columns + 1]
    hits = np.flatnonzero(right > left)
    many = (right - left)[hits]
    entries = np.repeat(left[hits] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
    pairs = np.unique(rare.queries[entries] * (len(low) + 1) + block[np.repeat(hits, many)])
    query, at = pairs // (len(low) + 1), pairs % (len(low) + 1)
    sizes = {int(q): size for size, index in queries.by_size.items() for q in index}
    for q in np.unique(query):
        size, blocks = sizes[int(q)], at[query == q]
        windows = blocks[:, None] + np.arange(-size, 2)
        inside = (windows >= low[blocks][:, None]) & (windows < high[blocks][:, None])
        yield int(q), size, np.unique(windows[inside])


def _by_cosine(latent: np.ndarray, high: np.ndarray, queries: Queries, cosine: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(query, window size, windows near it in the space), windows as their first block; ``latent`` has a vector of each block."""
    total = np.zeros((len(latent) + 1, latent.shape[1]))
    np.cumsum(latent, axis=0, out=total[1:])
    blocks = np.arange(len(latent))
    for size, index in queries.by_size.items():
        index = np.array([q for q in index if len(queries.words[q]) >= FEW_WORDS], np.int64)
        if not len(index):
            continue
        least = cosine * np.sqrt(np.minimum(1.0, np.array([len(queries.words[q]) for q in index]) / (size * BLOCK)))
        for start, at in itertools.product(range(0, len(index), TOGETHER), range(0, len(blocks), 16 * TOGETHER)):
            some, pairs = index[start : start + TOGETHER], []
            for low in range(at, min(at + 16 * TOGETHER, len(blocks)), TOGETHER):
                part = blocks[low : low + TOGETHER]
                windows = (total[np.minimum(part + size, high[part])] - total[part]).astype(np.float32)
                windows /= np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-12)
                row, column = np.divmod(np.flatnonzero(windows @ queries.vectors[some].T >= least[start : start + TOGETHER]), len(some))
                pairs.append(column * len(blocks) + row + low)
            column, row = np.divmod(np.sort(np.concatenate(pairs)), len(blocks))
            bounds = np.flatnonzero(np.diff(column, prepend=-1, append=-1))
            for first, stop in zip(bounds[:-1], bounds[1:]):
                yield int(some[column[first]]), size, row[first:stop]


def candidates(texts: Texts, space: Space, queries: Queries, rare: RareWords, cosine: float) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, query, first word, end word, first and end word without the reach) of the windows that the search finds and that can reach a verdict.

    Windows of the query's size start at each block and end with their text.
    Those whose cosine with the query is at least ``cosine``, or that hold one of
    its rarest words where it has few, are compared by words in common, which
    bound the common subsequence.  Their words reach half a step further at either
    end, within the text.
    """
    if not len(texts.hash):
        return
    columns = _columns(texts.hash)
    starts = (np.arange(len(columns)) - texts.first[texts.doc]) % BLOCK == 0
    first, block = np.flatnonzero(starts), np.cumsum(starts) - 1
    owner = texts.doc[first]
    low_block, high_block = np.searchsorted(owner, owner), np.searchsorted(owner, owner, side="right")
    latent = _sums(space.vectors, columns, first, BLOCK)
    none = np.full((SIZES[-1] + 1) * BLOCK, COLUMNS, np.uint16)
    padded, margin = np.concatenate([none, columns.astype(np.uint16), none]), len(none) - BLOCK // 2
    views = {size: np.lib.stride_tricks.sliding_window_view(padded, size * BLOCK + BLOCK // 2 * 2) for size in queries.by_size}
    found = itertools.chain(_by_cosine(latent, high_block, queries, cosine), _by_words(columns, block, low_block, high_block, queries, rare))
    for query, size, near_rows in found:
        needle, answer = queries.words[query], queries.answers[query]
        least, reach = queries.least(query), np.arange(-(BLOCK // 2), size * BLOCK + BLOCK // 2)
        member = np.zeros(COLUMNS + 1, np.uint8)
        member[_columns(np.array(needle, np.uint64))] = 1
        spans = views[size]
        for at in range(0, len(near_rows), 4096):
            rows = near_rows[at : at + 4096]
            own = spans[first[rows] + margin]
            some = member[own].sum(axis=1) >= least
            rows, own = rows[some], own[some].astype(np.int64)
            if not len(rows):
                continue
            words = first[rows][:, None] + reach
            own[(words < texts.first[owner[rows]][:, None]) | (words >= texts.first[owner[rows] + 1][:, None])] = COLUMNS
            common = _in_common(needle, own)
            able = common >= least
            doubtful = np.flatnonzero(able & (common < COPY * len(needle)))
            if len(needle) >= SHORT_ITEM and len(doubtful) and queries.around[query] == (0, 0):
                able[doubtful] = _in_common(answer, own[doubtful]) >= ANSWER * len(answer)
            for row in rows[able]:
                low, high = texts.first[owner[row]], texts.first[owner[row] + 1]
                yield (
                    owner[row], query, max(low, first[row] + reach[0]), min(high, first[row] + reach[-1] + 1),
                    first[row], min(high, first[row] + size * BLOCK),
                )


def leaked_items(texts: Texts, space: Space, queries: Queries, rare: RareWords, cosine: float) -> dict[tuple[int, int], tuple[float, int]]:
    """Cosine and common words of the window with most common words, for each text and query with a leak."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for text, query, low, high, first, end in candidates(texts, space, queries, rare, cosine):
        before, after = queries.around[query]
        around = None
        if before or after:
            around = texts.hash[max(texts.first[text], low - before) : min(texts.first[text + 1], high + after)].tolist()
        shared, leaked = verdict(queries.words[query], queries.answers[query], texts.hash[low:high].tolist(), around)
        if leaked and shared > best.get((text, query), (0.0, 0))[1]:
            window = space.vectors[_columns(texts.hash[first:end])].sum(axis=0)
            best[text, query] = (float(window @ queries.vectors[query] / max(np.linalg.norm(window), 1e-12)), shared)
    return best


def _search(keyed: DataFrame, space: Space, queries: Queries, items: DataFrame, cosine: float) -> DataFrame:
    schema = T.StructType([
        keyed.schema["doc_id"], keyed.schema["text_key"], items.schema["item_id"], T.StructField("cosine", T.DoubleType()),
        T.StructField("shared_words", T.LongType()), T.StructField("item_words", T.LongType()),
    ])
    carried = keyed.sparkSession.sparkContext.broadcast((vars(space), vars(queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_space, own = Space(**carried.value[0]), Queries(**carried.value[1])
        rare = rare_words(own, own_space)
        for batch in batches:
            for piece in pieces(batch, "text"):
                best = leaked_items(Texts(piece.column("text"), lower=True), own_space, own, rare, cosine)
                if best:
                    at = pa.array([text for text, _ in best], pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        piece.column("doc_id").take(at), piece.column("text_key").take(at), pa.array([own.ids[q] for _, q in best], pa.int64()),
                        pa.array([v[0] for v in best.values()]), pa.array([v[1] for v in best.values()], pa.int64()),
                        pa.array([len(own.words[q]) for _, q in best], pa.int64()),
                    ], schema.names)

    return keyed.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def leaks(docs: DataFrame, items: DataFrame, cosine: float = COSINE, key: bool = False) -> DataFrame:
    """``doc_id, item_id, cosine, shared_words, item_words``: the items that a document holds, once per row of ``docs``.

    A copy shares 70 % of the item's words in order within one window, a
    paraphrase 50 % and 80 % of the item's answer.  Items of fewer than 8 words
    must occur as they are; items without words occur nowhere.  Items of more
    than 96 words are searched by passages of 64, the last of which ends with the
    item, and their answer also in the words around a passage.  Windows are found by
    ``cosine`` (-3 compares all of them), for items of fewer than 16 words by their
    rarest words, which leaves none out.  Null and empty texts hold
    nothing.  Repeated rows are reported one by one, repeated items once.  No
    documents or no items give no rows.
    """
    keyed = docs.select("doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    space = fit(docs, items)
    blocks = max(1, -(-items.count() // ITEMS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for i in range(blocks):
        rows = items.where(block == i).collect()
        part = _search(keyed, space, prepare(sorted(((r["item_id"], r["text"]) for r in rows), key=repr), space), items, cosine)
        found = part if found is None else found.unionByName(part)
    best = stored(found, "leaks")
    order = F.struct("shared_words", "cosine", "item_words")
    names = ["doc_id", "text_key", "item_id"]
    best = best.groupBy(*names).agg(F.max(order).alias("best"))
    return best.select("doc_id", *(["text_key"] if key else []), "item_id", "best.cosine", "best.shared_words", "best.item_words")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns as they are.

    See :func:`leaks`.  Null and empty texts are kept, equal texts fare alike, and
    repeated rows stay repeated.  No documents give no rows; no items keep all.
    """
    return without(docs, stored(leaks(docs, items, key=True).select("text_key"), "leaked"))
