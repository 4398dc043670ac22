"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

Two tokenizers cut the same bytes.  Where both end a token, the text falls into
groups; tokens of a group are linked, and a pair of ids counts the documents
that hold it linked.  The counts come from an external merge:

1. a task tokenizes documents until their links fill a chunk, sorts the
   (pair, document) records, and writes them, dealt over radix buckets of the
   first id, as zstd runs;
2. for each bucket the heads of all runs (pair, documents of the chunk) are
   merged by a heap.  Pairs come out ordered by the first id, so its highest
   count is known when its last pair has passed, and each run gets its answers;
3. for each chunk, records and answers meet and add up per document.

A run names a pair once, however many documents hold it, so a pair that all
documents hold costs one head for each chunk.  Nothing but a chunk, and the heads
of a bucket, is ever in one task.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored
from cartsight.llm.vectors import pieces

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links from which a chunk is closed, and bytes of text tokenized at once.
CHUNK_LINKS, PIECE = 3_000_000, 1 << 19
#: Links of a group from which its pairs are counted by distinct ids.
WIDE = 1 << 16
#: Pairs in a frame of a run, and pairs that wait in a merge before complete ones leave it.
FRAME, WAITING = 1 << 14, 1 << 20
#: Bytes of text for one bucket, and the bits of the first id that choose it, at least and at most.
BUCKET_BYTES, LEAST_BITS, MOST_BITS = 128 << 20, 8, 16
#: Bits of an id and of a document of a chunk in a record.
ID, DOC = 20, 24

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, the others for 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        return self.data[np.repeat(self.start[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class ByteLevel:
    """A byte-level BPE file; special tokens in a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        byte = _byte_level()
        special = {i for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        tokens = [b""] * (max(self._tokenizer.get_vocab().values()) + 1)
        for token, i in self._tokenizer.get_vocab().items():
            tokens[i] = token.encode() if i in special else bytes(byte[c] for c in token)
        self.vocabulary = Vocabulary(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A piece model; it sets the space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            tokens.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode())
        self.vocabulary = Vocabulary(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(sizes.sum())), sizes


def _same_bytes(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which texts the bytes of their tokens give again."""
    ends = np.concatenate([[0], np.cumsum(vocabulary.length[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
    data = vocabulary.joined(ids)
    wanted = np.array([len(t) for t in texts], np.int64)
    if (np.diff(ends) == wanted).all() and np.array_equal(data, np.frombuffer(b"".join(texts), np.uint8)):
        return np.ones(len(texts), bool)
    return np.array([data[ends[i] : ends[i + 1]].tobytes() == text for i, text in enumerate(texts)], bool)


class Alignment:
    """The groups and links of some texts; texts that are null, empty, or not given again by either tokenizer have no tokens."""

    def __init__(self, texts: list[str | None], first: ByteLevel, second: Pieces):
        self.n = len(texts)
        docs = np.array([i for i, t in enumerate(texts) if t], np.int64)
        given = [texts[i] for i in docs]
        wanted = [b" " + t.encode() for t in given]
        (a, a_sizes), (b, b_sizes) = _flat(first.encode(given)), _flat(second.encode(given))
        good = _same_bytes(first.vocabulary, a, a_sizes, wanted) & _same_bytes(second.vocabulary, b, b_sizes, wanted)
        if not good.all():
            a, b = a[np.repeat(good, a_sizes)], b[np.repeat(good, b_sizes)]
            docs, a_sizes, b_sizes = docs[good], a_sizes[good], b_sizes[good]
        self.a, self.b = a, b
        # All texts lie end to end; both tokenizers end a token where a text ends, so no group leaves its text.
        a_end, b_end = np.cumsum(first.vocabulary.length[a]), np.cumsum(second.vocabulary.length[b])
        total = int(a_end[-1]) + 1 if len(a_end) else 1
        marks_a, marks_b = np.zeros(total, bool), np.zeros(total, bool)
        marks_a[a_end], marks_b[b_end] = True, True
        self.a_last, self.b_last = marks_b[a_end], marks_a[b_end]
        groups = int(self.a_last.sum())
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        self.a_count, self.b_count = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        self.a_start, self.b_start = np.cumsum(self.a_count) - self.a_count, np.cumsum(self.b_count) - self.b_count
        self.group_doc = np.repeat(docs, a_sizes)[self.a_last]
        links = self.a_count * self.b_count
        found = {"n_groups": np.bincount(self.group_doc, minlength=self.n), "n_a": np.zeros(self.n, np.int64), "n_b": np.zeros(self.n, np.int64), "n_links": np.zeros(self.n, np.int64)}
        found["n_a"][docs], found["n_b"][docs] = a_sizes, b_sizes
        np.add.at(found["n_links"], self.group_doc, links)
        self.counts = {name: found[name].astype(np.int64) for name in COUNTS}
        self._links = links

    def written(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text: the ids of its groups in order; empty without tokens."""
        sizes = self.counts["n_a"] + self.counts["n_b"]
        total = len(self.a) + len(self.b)
        ids, mark = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8)
        at_a = np.arange(len(self.a)) + self.b_start[self.a_group]
        at_b = np.arange(len(self.b)) + (self.a_start + self.a_count)[self.b_group]
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[self.a_last]], mark[at_b[self.b_last]] = ord("|"), ord(";")
        width = len(str(int(ids.max(initial=0))))
        digits = np.ones(total, np.int64)
        for power in range(1, width):
            digits += ids >= 10**power
        shown = np.empty((total, width + 1), np.uint8)
        rest = ids * 10 ** (width - digits)  # digits from the left
        for k in range(width):
            shown[:, k] = 48 + rest // 10 ** (width - 1 - k) % 10
        shown[np.arange(total), digits] = mark
        data = shown[np.arange(width + 1) <= digits[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(digits + 1)])[np.concatenate([[0], np.cumsum(sizes)])]
        return [data[ends[i] : max(ends[i], ends[i + 1] - 1)] for i in range(self.n)]

    def links(self, bits: int, base: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Records (:func:`_record`) of all links, and (records, times) of wide groups; documents are numbered from ``base``."""
        usual = np.flatnonzero(self._links < WIDE)
        n = self._links[usual]
        group = np.repeat(usual, n)
        at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        b_count = self.b_count[group]
        a = self.a[self.a_start[group] + at // b_count]
        b = self.b[self.b_start[group] + at % b_count]
        wide = []
        for g in np.flatnonzero(self._links >= WIDE):
            a_ids, a_times = np.unique(self.a[self.a_start[g] : self.a_start[g] + self.a_count[g]], return_counts=True)
            b_ids, b_times = np.unique(self.b[self.b_start[g] : self.b_start[g] + self.b_count[g]], return_counts=True)
            for i, times in zip(a_ids, a_times):
                wide.append((_record(np.full(len(b_ids), i), b_ids, np.full(len(b_ids), self.group_doc[g] + base), bits), times * b_times))
        return _record(a, b, self.group_doc[group] + base, bits), wide


def _record(a: np.ndarray, b: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    """Bucket (low bits of the first id), first id, second id and document as one number, in this order."""
    turned = ((a & ((1 << bits) - 1)) << (ID - bits)) | (a >> bits)
    return ((turned << ID | b) << DOC | doc).astype(np.uint64)


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 0 or more, in as few bytes each as the largest needs, compressed."""
    import zstandard

    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(values.astype(f"<u{width}").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


_RUNS = "chunk long, bucket int, frame int, first long, pairs binary, held binary, docs binary, times binary, about binary"


class _Chunk:
    """Documents and records of a task until they fill a chunk."""

    def __init__(self, number: int, bits: int):
        self.number, self.bits = number, bits
        self.about: list[pa.RecordBatch] = []
        self.records: list[np.ndarray] = []
        self.wide: list[tuple[np.ndarray, np.ndarray]] = []
        self.docs = self.links = 0

    def add(self, keys: pa.RecordBatch, found: Alignment) -> None:
        records, wide = found.links(self.bits, self.docs)
        self.records.append(records)
        self.wide += wide
        digest = [hashlib.sha256(t).hexdigest() if t else "" for t in found.written()]
        columns = [*keys.columns, *(pa.array(found.counts[c]) for c in COUNTS), pa.array(digest)]
        self.about.append(pa.RecordBatch.from_arrays(columns, [*keys.schema.names, *COUNTS, "groups_sha256"]))
        self.docs += found.n
        self.links += len(records) + sum(len(r) for r, _ in wide)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The frames of the runs, and the documents (bucket -1)."""
        records = np.sort(np.concatenate(self.records))
        self.records = []
        new = np.flatnonzero(np.append(True, records[1:] != records[:-1])) if len(records) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(records)))
        records = records[new]
        if self.wide:
            records = np.concatenate([records, *(r for r, _ in self.wide)])
            times = np.concatenate([times, *(t for _, t in self.wide)])
            order = np.argsort(records, kind="stable")
            records, times = records[order], times[order]
            new = np.flatnonzero(np.append(True, records[1:] != records[:-1]))
            records, times = records[new], np.add.reduceat(times, new)
        pairs, docs = (records >> np.uint64(DOC)).astype(np.int64), (records & np.uint64((1 << DOC) - 1)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
        bounds = np.append(heads, len(pairs))
        names = pairs[heads]
        edges = np.searchsorted(names >> (2 * ID - self.bits), np.arange((1 << self.bits) + 1))
        out: list[tuple] = []
        size = 0
        for bucket in np.flatnonzero(np.diff(edges)):
            for frame, at in enumerate(range(edges[bucket], edges[bucket + 1], FRAME)):
                end = min(at + FRAME, edges[bucket + 1])
                part = slice(bounds[at], bounds[end])
                out.append((self.number, int(bucket), frame, int(names[at]), _packed(np.diff(names[at:end], prepend=names[at])), _packed(np.diff(bounds[at : end + 1])), _packed(docs[part]), _packed(times[part]), None))
                size += len(out[-1][6]) + len(out[-1][7])
                if size > 4 << 20:
                    yield _frames(out)
                    out, size = [], 0
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.about[0].schema) as writer:
            for batch in self.about:
                writer.write_batch(batch)
        out.append((self.number, -1, 0, 0, b"", b"", b"", b"", sink.getvalue().to_pybytes()))
        yield _frames(out)


def _frames(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in _RUNS.split(", ")])


def runs(docs: DataFrame, *keys: str, folder: str = TOKENIZERS, bits: int | None = None) -> tuple[DataFrame, int]:
    """The stored runs of all documents, and the bits of the first id that choose a bucket."""
    if bits is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = min(max(int(size // BUCKET_BYTES).bit_length(), LEAST_BITS), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = None
        chunk, number = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                tokenizers = tokenizers or (ByteLevel(f"{folder}/{FIRST}"), Pieces(f"{folder}/{SECOND}"))
                chunk = chunk or _Chunk(number, bits)
                chunk.add(piece.select(list(keys)), Alignment(piece.column("text").to_pylist(), *tokenizers))
                if chunk.links >= CHUNK_LINKS or chunk.docs >= (1 << DOC) - (1 << 20):
                    yield from chunk.rows()
                    chunk, number = None, number + 1
        if chunk:
            yield from chunk.rows()

    return stored(docs.select(*keys, "text").mapInArrow(run, _RUNS), "alignment-runs"), bits


class _Merge:
    """The frames of one bucket, merged by a heap over their first pairs."""

    def __init__(self, first: np.ndarray, pairs: list[bytes], held: list[bytes]):
        self._first, self._pairs, self._held = first, pairs, held

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
        """Pairs, their counts and whether they are the highest of their first id, by rising pairs; and for each frame the places of its next pairs."""
        heap = [(int(f), i) for i, f in enumerate(self._first)]
        heapq.heapify(heap)
        open_frames: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0
        while heap:
            first, i = heapq.heappop(heap)
            pairs = np.cumsum(_unpacked(self._pairs[i])) + first
            open_frames[i] = (pairs, _unpacked(self._held[i]))
            waiting += len(pairs)
            if heap and waiting < WAITING:
                continue
            # No later frame holds a pair before the first id of the next one, so those before it are complete.
            bound = heap[0][0] >> ID << ID if heap else None
            taken = [(j, len(p) if bound is None else int(np.searchsorted(p, bound))) for j, (p, _) in open_frames.items()]
            taken = [(j, k) for j, k in taken if k]
            if not taken:
                continue
            names, place = np.unique(np.concatenate([open_frames[j][0][:k] for j, k in taken]), return_inverse=True)
            counts = np.zeros(len(names), np.int64)
            np.add.at(counts, place, np.concatenate([open_frames[j][1][:k] for j, k in taken]))
            new = np.append(True, names[1:] >> ID != names[:-1] >> ID)
            best = counts == np.maximum.reduceat(counts, np.flatnonzero(new))[np.cumsum(new) - 1]
            yield names, counts, best, list(zip([j for j, _ in taken], np.split(place, np.cumsum([k for _, k in taken])[:-1])))
            for j, k in taken:
                pairs, held = open_frames[j]
                open_frames[j] = (pairs[k:], held[k:])
                if k == len(pairs):
                    del open_frames[j]
            waiting = sum(len(p) for p, _ in open_frames.values())


def _merge(table: pa.Table) -> _Merge:
    return _Merge(table.column("first").to_numpy(), table.column("pairs").to_pylist(), table.column("held").to_pylist())


def _heads(written: DataFrame) -> DataFrame:
    return written.where("bucket >= 0").select("chunk", "bucket", "frame", "first", "pairs", "held")


def answers(written: DataFrame) -> DataFrame:
    """For each frame of the runs, twice the count of each of its pairs, and one more where that is the highest of the first id."""

    def run(table: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[] for _ in range(table.num_rows)]
        for _, counts, best, places in _merge(table).parts():
            both = 2 * counts + best
            for i, place in places:
                parts[i].append(both[place])
        return table.select(["chunk", "bucket", "frame"]).append_column("answers", pa.array([_packed(np.concatenate(p)) for p in parts], pa.binary()))

    return _heads(written).groupBy("bucket").applyInArrow(run, "chunk long, bucket int, frame int, answers binary")


def linked_pairs(docs: DataFrame, folder: str = TOKENIZERS, bits: int | None = None) -> DataFrame:
    """``a, b, documents, highest``: every linked pair of ids, how many documents hold it, and whether no other pair of ``a`` is in more."""
    written, bits = runs(docs, folder=folder, bits=bits)

    def run(table: pa.Table) -> pa.Table:
        found = []
        for names, counts, best, _ in _merge(table).parts():
            turned = names >> ID
            a = (turned & ((1 << (ID - bits)) - 1)) << bits | turned >> (ID - bits)
            found.append(pa.table([pa.array(a), pa.array(names & ((1 << ID) - 1)), pa.array(counts), pa.array(best)], ["a", "b", "documents", "highest"]))
        return pa.concat_tables(found)

    return _heads(written).groupBy("bucket").applyInArrow(run, "a long, b long, documents long, highest boolean")


def align(docs: DataFrame, key: str = "doc_id", folder: str = TOKENIZERS, bits: int | None = None) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    Texts that are null or empty, and texts that the tokens of either vocabulary
    do not give again byte by byte, have no tokens: zeros and an empty digest;
    they count for no pair.  Repeated rows are documents of their own: they are
    counted and returned as often as they occur.  Ties for the highest count of
    a first id all count as highest.  No rows give no rows.  A text of any length
    is tokenized whole, in one task.  Other columns, whatever their names, are
    not read.  Ids must be below 2**20.
    """
    written, _ = runs(docs, key, folder=folder, bits=bits)
    found = stored(answers(written), "alignment-answers")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def run(records: pa.Table, counted: pa.Table) -> pa.Table:
        by_frame = {(r["bucket"], r["frame"]): r["answers"] for r in counted.select(["bucket", "frame", "answers"]).to_pylist()}
        whole = [x for x in records.column("about").to_pylist() if x is not None]
        about = pa.ipc.open_stream(whole[0]).read_all()
        best, total = np.zeros(about.num_rows, np.int64), np.zeros(about.num_rows, np.int64)
        for batch in records.to_batches(max_chunksize=64):
            for bucket, frame, held, docs_, times in zip(*(batch.column(c).to_pylist() for c in ("bucket", "frame", "held", "docs", "times"))):
                if bucket < 0:
                    continue
                each = np.repeat(_unpacked(by_frame[bucket, frame]), _unpacked(held))
                doc, n = _unpacked(docs_), _unpacked(times)
                np.add.at(best, doc, n * (each & 1))
                np.add.at(total, doc, n * (each >> 1))
        digest = about.column("groups_sha256")
        columns = [*about.drop_columns(["groups_sha256"]).columns, pa.chunked_array([best]), pa.chunked_array([total]), digest]
        return pa.table(columns, [key, *COUNTS, "n_best", "count_sum", "groups_sha256"])

    bodies = written.select("chunk", "bucket", "frame", "held", "docs", "times", "about")
    return bodies.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, schema)
