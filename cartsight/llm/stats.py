"""Statistics of whole texts, from one vectorised pass over the words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartsight.llm.vectors import Texts, mix, pieces, powers

WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares of words or characters that describe the make-up of a text.
SHARES = ("upper", "pipes", "shouts", "digits", "stops", "wide", "distinct", "same_again", "lines", "word_length", "symbols", "dup_lines", "repeats")
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    out = np.zeros(len(keys), bool)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts and shares per text; a null text is an empty one."""
    texts = Texts(column)
    data, n = texts.bytes, texts.n
    first_byte = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int8)
    inside[texts.start] += 1
    inside[texts.end] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    words = texts.counts
    chars = texts.byte_sums(first_byte & in_word)
    symbols = texts.byte_sums(_SYMBOL[data])

    hashes, at = texts.runs(WINDOW)
    twice = at[_repeated(mix(hashes + mix(texts.doc[at].astype(np.uint64))))]
    size = len(texts.hash) + 1
    cover = np.bincount(twice, minlength=size) - np.bincount(twice + WINDOW, minlength=size)
    repeats = texts.per_doc(np.cumsum(cover[:-1]) > 0)

    cuts = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([texts.offsets[:-1][np.diff(texts.offsets) > 0], cuts + 1]))
    line_start = line_start[line_start < len(data)]
    owner = np.searchsorted(texts.offsets, line_start, "right") - 1
    line_end = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    ends_in_cut = np.zeros(len(line_start), bool)
    if len(line_start):
        ends_in_cut = data[np.maximum(line_end - 1, 0)] == 10
    word_total = np.searchsorted(texts.start, np.append(line_start, len(data)))
    has_word = np.diff(word_total) > 0 if len(line_start) else np.zeros(0, bool)
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    stop = line_end - ends_in_cut
    line_hash = mix((total[stop] - total[line_start]) * down[line_start]) + mix((stop - line_start).astype(np.uint64))
    line_key = mix(line_hash + mix(owner.astype(np.uint64)))[has_word]
    line_owner = owner[has_word]
    distinct = np.unique(line_key, return_index=True)[1]
    lines = np.bincount(line_owner, minlength=n)
    dup_lines = lines - np.bincount(line_owner[distinct], minlength=n)

    kinds = np.bincount(texts.doc[np.unique(mix(texts.hash + mix(texts.doc.astype(np.uint64))), return_index=True)[1]], minlength=n)
    again = np.zeros(len(texts.hash), bool)
    again[1:] = (texts.hash[1:] == texts.hash[:-1]) & (texts.doc[1:] == texts.doc[:-1])

    some, letters = np.maximum(words, 1), np.maximum(chars, 1)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        return texts.byte_sums(mask) / of

    return {
        "n_words": words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeats.astype(np.int64),
        "upper": share((data >= 65) & (data <= 90), letters), "pipes": share(data == 124, some), "shouts": share(data == 33, some),
        "digits": share((data >= 48) & (data <= 57), letters), "stops": share((data == 46) | (data == 44), some), "wide": share(data >= 0xC0, letters),
        "distinct": kinds / some, "same_again": texts.per_doc(again) / some, "lines": lines / some, "word_length": chars / some,
        "symbols": symbols / some, "dup_lines": dup_lines / np.maximum(lines, 1), "repeats": repeats / some,
    }


def statistics(docs: DataFrame, *keys: str, shares: bool = False) -> DataFrame:
    """``keys``, the five counts, and with ``shares`` also the make-up, of every row of ``docs``."""
    names = COUNTS + (SHARES if shares else ())
    schema = T.StructType([docs.schema[k] for k in keys] + [T.StructField(c, T.LongType() if c in COUNTS else T.DoubleType()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = measure(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(k) for k in keys] + [pa.array(found[c].astype(np.int64 if c in COUNTS else np.float64)) for c in names],
                    [*keys, *names],
                )

    return docs.select(*keys, "text").mapInArrow(run, schema)
