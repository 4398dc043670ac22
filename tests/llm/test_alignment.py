"""Token alignment against a plain loop over all documents."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from cartsight.llm import alignment

ODD = [
    "", None, "a", "a", "x▁y", "<|endoftext|> hi <unk> <s>", " lead  two\n\n tabs\t\x00 nul", "日本語テキスト😀😀 é̂", "a" * 5000,
    "​﻿", "１２３ ﬁ", "<0x41>", "1234567890" * 300, "the cat sat on the mat", "the cat sat on the mat",
]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.ByteLevel(f"{alignment.TOKENIZERS}/{alignment.FIRST}"), alignment.Pieces(f"{alignment.TOKENIZERS}/{alignment.SECOND}")


def tokens_of(tokenizer, text):
    ids = tokenizer.encode([text])[0]
    return [(i, tokenizer.vocabulary.joined(np.array([i])).tobytes()) for i in ids]


def plain_groups(text, first, second):
    a, b = (tokens_of(t, text) if text else [] for t in (first, second))
    wanted = b" " + (text or "").encode()
    if b"".join(x for _, x in a) != wanted or b"".join(x for _, x in b) != wanted:
        return []
    groups, left, right = [], list(a), list(b)
    while left:
        one, two = [left.pop(0)], [right.pop(0)]
        while (m := sum(len(x) for _, x in one)) != (n := sum(len(x) for _, x in two)):
            (one if m < n else two).append((left if m < n else right).pop(0))
        groups.append(([i for i, _ in one], [i for i, _ in two]))
    return groups


def plain(texts, first, second):
    groups = [plain_groups(t, first, second) for t in texts]
    links = [[(a, b) for one, two in g for a in one for b in two] for g in groups]
    count = Counter(pair for found in links for pair in set(found))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for g, found in zip(groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found), sum(count[p] == best[p[0]] for p in found), sum(count[p] for p in found), digest))
    return rows, count, best


def agrees(docs, tokenizers):
    texts = docs.select("doc_id", "text").collect()
    rows, count, best = plain([r["text"] for r in texts], *tokenizers)
    got = Counter(tuple(r) for r in alignment.align(docs).collect())
    assert got == Counter((r["doc_id"], *row) for r, row in zip(texts, rows))
    pairs = {(r["a"], r["b"]): (r["documents"], r["highest"]) for r in alignment.linked_pairs(docs).collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in count.items()}


def test_edges(spark, edge, tokenizers):
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").repartition(3)
    agrees(odd, tokenizers)
    rows = {r["doc_id"]: r for r in alignment.align(odd).collect()}
    assert rows[4]["n_a"] == 0 and rows[4]["groups_sha256"] == ""  # the piece model's own space sign is not given again
    agrees(edge.where("length(text) < 1000 or text is null"), tokenizers)


def test_empty(empty):
    assert alignment.align(empty).count() == 0


def test_whole_table(sample, tokenizers):
    agrees(sample, tokenizers)


@pytest.mark.parametrize("chunk, frame, waiting, wide", [(500, 3, 10, 1 << 16), (2_000, 64, 50, 4), (100, 1, 1, 2)])
def test_many_runs(spark, monkeypatch, sample, tokenizers, chunk, frame, waiting, wide):
    """Small chunks, frames and merges, and groups counted by distinct ids, change nothing."""
    for name, value in {"CHUNK_LINKS": chunk, "FRAME": frame, "WAITING": waiting, "WIDE": wide, "PIECE": 2_000, "LEAST_BITS": 2}.items():
        monkeypatch.setattr(alignment, name, value)
    short = sample.where("length(text) < 600").unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string"), allowMissingColumns=True)
    agrees(short, tokenizers)


def test_packing():
    for top in (0, 200, 70_000, 1 << 40):
        values = np.array([0, top, 5, top // 2])
        assert (alignment._unpacked(alignment._packed(values)) == values).all()
    assert not len(alignment._unpacked(alignment._packed(np.zeros(0, np.int64))))
