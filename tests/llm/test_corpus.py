"""Operators on the whole corpus, and the pipeline, against brute force on small tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartsight.llm import common, jaccard, mixing, ranges, semantic, sharding
from cartsight.llm.common import stored
from cartsight.llm.components import components
from cartsight.llm.vectors import Texts


def as_set(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(rows, size, percent):
    """Component of every row by comparing all pairs."""
    sets = [as_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        known = [x for x in (least[find(i)], d) if x is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_copies():
    """Groups of near copies around the threshold, a chain, docs that share a frequent passage, and texts that differ in it only."""
    draw = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = list(draw.choice(vocabulary, 150))
    rows = []
    for _ in range(60):
        words = list(base)
        for at in draw.integers(0, len(words), draw.integers(0, 4)):
            words[at] = f"x{draw.integers(0, 10**6)}"
        rows.append(" ".join(words))
    chain = list(draw.choice(vocabulary, 100))
    for step in range(0, 60, 2):
        rows.append(" ".join([*(f"c{i}" for i in range(step)), *chain[step:]]))
    passage = " ".join(draw.choice(vocabulary, 60))
    for i in range(50):
        rows.append(f"{passage} {' '.join(draw.choice(vocabulary, int(draw.integers(1, 9))))}")
    rows += [" ".join(base + base[:k]) for k in range(3, 12)]
    rows += ["", "one", "one", "One two", None]
    return [(int(i), t) for i, t in zip(draw.permutation(len(rows)), rows, strict=True)]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_near_copies(spark, size, percent):
    rows = near_copies()
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), size, percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, size, percent)


def test_jaccard_edges(edge, empty):
    assert jaccard.link_documents(empty).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted((tuple(r) for r in jaccard.link_documents(edge).collect()), key=repr) == brute_components(rows, 3, 90)


def test_representatives(edge):
    kept = jaccard.representatives(edge)
    assert kept.columns == edge.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[11] == 1 and ids[12] == 0 and ids[3] == ids[4] == 1 and ids[None] == 2


def test_grouped_prefixes(spark, monkeypatch):
    """Sets with one prefix and size are one group; its members are compared with each other and with those of other groups."""
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 2)
    monkeypatch.setattr(jaccard, "LOCAL", 1)
    rare = [f"r{i}" for i in range(30)]
    lines = [" ".join(f"{a}{i}" for i in range(8)) for a in "abcdefgh"]
    rows = [(i, " ".join(rare) + " " + " ".join(lines[j] for j in range(8) if (i >> j) & 1 or j == i % 8)) for i in range(60)]
    rows += [(100 + i, t + " " + lines[0]) for i, t in rows[:20]]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 80)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, 3, 80)


def counted(monkeypatch, name):
    """Counts of the rows that a step of the join gives, in the order of its calls."""
    step, made = getattr(jaccard, name), []

    def run(*given):
        out = step(*given)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, name, run)
    return made


def test_runs_of_the_same_texts_are_one_bucket(spark, monkeypatch):
    made = counted(monkeypatch, "_buckets")
    words = [f"w{i}" for i in range(600)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, " ".join([*words[:300], *(f"y{i}" for i in range(300))])), (4, "z")]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, 3, 90)
    assert made[0] <= 7  # the runs of 1 and 2, of 1, 2 and 3, and the two other pairs at most


def test_long_texts_that_share_a_passage_are_ruled_out_early(spark, monkeypatch):
    made = counted(monkeypatch, "_pairs")
    passage = [f"p{i}" for i in range(400)]
    rows = [(d, " ".join([*(f"d{d}w{i}" for i in range(2600)), *passage])) for d in range(6)]
    rows += [(10, rows[0][1] + " x"), (11, rows[1][1] + " y")]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, 3, 90)
    assert sum(made) <= 4


def test_parity_sketch_bounds_the_difference():
    draw = np.random.default_rng(1)
    for n, m in ((100, 110), (1000, 1200), (129, 127), (1, 1)):
        both = draw.integers(0, 2**63, n + m, dtype=np.uint64)
        a, b = both[:n], both[n // 2 : n // 2 + m]
        x, y = jaccard.parity_sketch(a), jaccard.parity_sketch(b)
        while len(x) != len(y):
            x, y = (x, y[: len(y) // 2] ^ y[len(y) // 2 :]) if len(y) > len(x) else (x[: len(x) // 2] ^ x[len(x) // 2 :], y)
        assert sum(bin(int(v) & (2**64 - 1)).count("1") for v in x ^ y) <= len(set(a) ^ set(b))


def test_components(spark):
    draw = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_word_hashes():
    texts = ["The the  THE\tcat\n", "", None, "cat the", "a\x0bb\x0cc\rd e"]
    found = Texts(pa.array(texts), lower=True)
    assert found.counts.tolist() == [4, 0, 0, 2, 4]
    h = found.hash.tolist()
    assert h[0] == h[1] == h[2] == h[5] and h[3] == h[4] and len(set(h)) == 6
    assert Texts(pa.array(["x", "The the"]).slice(1)).counts.tolist() == [2]


def check_shards(docs, placed, shards):
    rows = placed.collect()
    sizes = [(r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(sizes, key=repr)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    slack = max((s for _, s, _ in sizes), default=0) + sharding.WHOLE_GROUP * sum(s for _, s, _ in sizes) / shards
    assert all(abs(held[i] - sum(s for _, s, _ in sizes) / shards) <= slack for i in range(shards)) or not rows


@pytest.mark.parametrize("table", ["edge", "sample", "empty"])
def test_shards(request, table):
    docs = request.getfixturevalue(table)
    check_shards(docs, sharding.place(docs), sharding.SHARDS)


def test_hot_group_is_split(spark):
    rows = [(i, "same text " * 20) for i in range(900)] + [(1000 + i, f"text number {i} " * 10) for i in range(900)] + [(7, "repeat " * 30)] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_shards(docs, sharding.place(docs, 8), 8)
    again = {tuple(r) for r in sharding.place(docs.repartition(5), 8).collect()}
    assert again == {tuple(r) for r in sharding.place(docs, 8).collect()}


def test_sharded_documents(edge):
    out = sharding.shard_documents(edge)
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in edge.collect())
    assert set(edge.columns) <= set(out.columns)


def test_splitters_subdivide(spark):
    """A range that the sample missed is cut again; the positions are exact."""
    rows = spark.createDataFrame([(f"a{i:05d}", 1) for i in range(500)] + [(f"b{i:05d}", 1000) for i in range(50)], "key string, weight bigint")
    order = sorted((r["key"], r["weight"]) for r in rows.collect())
    got = {r["key"]: (r["rank"], r["before"]) for r in ranges.positions(rows, 16).collect()}
    before = 0
    for i, (key, weight) in enumerate(order):
        assert got[key] == (i, before)
        before += weight


def brute_mix(rows):
    words = [(d, s, len((t or "").encode().split())) for d, s, t in rows]
    sources = sorted({s for _, s, _ in words}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, x, n in words if x == s) for s in sources}
    share = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sources)}
    capped, total = set(), float(sum(size.values()))
    while True:
        rest = sum(share[s] for s in sources if s not in capped)
        factor = (total - sum(3.0 * size[s] for s in capped)) / rest if rest else 0.0
        more = {s for s in sources if s not in capped and 3.0 * size[s] < factor * share[s]}
        if not more:
            return words, size, {s: min(3.0 * size[s], factor * share[s]) for s in sources}
        capped |= more


@pytest.mark.parametrize("table", ["edge", "sample", "empty"])
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    words, size, target = brute_mix([(r["doc_id"], r["source"], r["text"]) for r in docs.select("doc_id", "source", "text").collect()])
    rows = mixing.copies(docs).collect()
    assert sorted(((r["doc_id"], r["source"], r["size"], r["source_size"]) for r in rows), key=repr) == sorted(((d, s, n, size[s]) for d, s, n in words), key=repr)
    taken = Counter()
    for r in rows:
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9) and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for s in size:
        assert abs(taken[s] - target[s]) <= 3 * max(n for _, x, n in words if x == s)


def test_mix_takes_one_row_per_boundary(spark):
    """Copies differ by at most one within a source, and their number is the expected one."""
    rows = spark.createDataFrame([(i, "a b c", "abc"[i % 3]) for i in range(300)] + [(i, "x", "d") for i in range(300, 310)], "doc_id bigint, text string, source string")
    copies = defaultdict(list)
    for r in mixing.copies(rows).collect():
        copies[r["source"]].append((r["copies"], r["target"] / r["source_size"]))
    for found in copies.values():
        assert max(c for c, _ in found) - min(c for c, _ in found) <= 1
        assert abs(sum(c for c, _ in found) - len(found) * found[0][1]) <= 1


def test_mixed_documents(edge):
    out = mixing.mix_documents(edge)
    assert out.columns == edge.columns
    want = Counter()
    for r in mixing.copies(edge).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in out.collect()) == +want


def test_rows_without_ids(spark, monkeypatch):
    """Null ids of one source and word count: entries by the row, copies that stay with their texts; equal rows in blocks."""
    monkeypatch.setattr(common, "HOT_KEY", 50)
    rows = [(None, f"one two{i}", "en", "web", 0) for i in range(300)] + [(None, "same text", "en", "web", 0)] * 200 + [(7, None, None, None, None), (8, "x y", None, "other", 1)]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, names)
    out = mixing.mix_documents(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "row_number" not in plan
    first = Counter(map(tuple, out.collect()))
    want = sum(r["copies"] for r in mixing.copies(docs).collect())
    assert first.total() == want and set(first) <= set(rows)
    assert Counter(map(tuple, mixing.mix_documents(docs.repartition(7).orderBy(F.desc("text"))).collect())) == first
    shards = sharding.shard_documents(docs, 4).collect()
    assert Counter(tuple(r[c] for c in docs.columns) for r in shards) == Counter(rows)
    assert len({(r["shard"], r["slot"]) for r in shards}) == len(rows)
    assert all(r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in shards)


def test_row_keys(spark):
    """Rows that differ only in where a null stands, in a sign of zero, or inside a map have keys of their own."""
    docs = spark.sql(
        "SELECT * FROM VALUES ('a', null, 0.0D, map('k', array(1, null))), (null, 'a', 0.0D, map('k', array(1, null))), ('a', null, -0.0D, map('k', array(1, null))),"
        " ('a', null, 0.0D, map('k', array(null, 1))), ('a', null, 0.0D, map('k', array(1, null))) AS t(x, y, z, m)"
    )
    assert len({r[0] for r in docs.select(common.row_key(docs)).collect()}) == 4


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


def test_common_subsequence():
    draw = np.random.default_rng(4)
    for _ in range(50):
        a, b = (draw.integers(0, 6, draw.integers(0, 40)).tolist() for _ in range(2))
        assert semantic.common_subsequence(a, b) == plain_subsequence(a, b)


def test_leaks(spark, sample):
    """All planted passages, exact, with words replaced, and inside other text, against a scan of every window."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    around = [r["text"] for r in sample.orderBy("doc_id").limit(8).collect()]
    planted = []
    for n, (item, text) in enumerate(sorted(texts.items())[:8]):
        words = text.split()
        if len(words) < 20:
            continue
        near = [f"other{i}" if i % 7 == 3 else w for i, w in enumerate(words)]
        planted += [(9000 + 10 * n, item, f"{around[n]} {text} {around[n]}"), (9001 + 10 * n, item, f"{around[n]}\n{' '.join(near)}")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, _, t in planted], sample.schema).unionByName(sample)
    found = {(r["doc_id"], r["item_id"]) for r in semantic.leaks(docs, items).collect()}
    brute = set()
    for r in docs.select("doc_id", "text").collect():
        text = " ".join(r["text"].lower().split())
        brute |= {(r["doc_id"], i) for i, t in texts.items() if " ".join(t.lower().split()) in text}
    assert {(d, i) for d, i, _ in planted} <= found
    assert len(brute & found) >= 0.95 * len(brute)
    clean = {d for d, _ in found} - {d for d, _, _ in planted} - {d for d, _ in brute}
    assert not clean


def test_leaks_edges(edge, empty, spark):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the quiet river"), (2, None), (3, ""), (4, "two words"), (4, "two words")], "item_id bigint, text string")
    found = Counter((r["doc_id"], r["item_id"]) for r in semantic.leaks(edge, items).collect())
    assert found[1, 1] == 1 and found[2, 1] >= 1 and found[11, 4] == found[12, 4] == 1 and not {d for d, _ in found} - {1, 2, 11, 12}
    assert semantic.leaks(empty, items).count() == 0 and semantic.leaks(edge, items.limit(0)).count() == 0
    assert semantic.decontaminated(edge, items).columns == edge.columns


def test_space_from_passages(spark, monkeypatch):
    """Weights count every passage, those of one word as well; the space is that of the dense matrix of the distinct passages."""
    draw = np.random.default_rng(3)
    texts = ["solo"] * 50 + [" ".join(f"w{x}" for x in draw.zipf(1.5, 90) % 500) for _ in range(40)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    monkeypatch.setattr(semantic, "GATHER", 100)
    rows, kinds = [], set()
    for t in texts:
        words = Texts(pa.array([t], pa.string()), lower=True)
        columns = (words.hash >> np.uint64(20)).astype(np.int64) & (semantic.COLUMNS - 1)
        for at in range(0, len(columns), semantic.PASSAGE):
            rows.append(np.bincount(columns[at : at + semantic.PASSAGE], minlength=semantic.COLUMNS))
            kinds.add(columns[at : at + semantic.PASSAGE].astype(np.uint16).tobytes())
    counts = np.array(rows, float)
    assert len(rows) == 130
    idf = draw.uniform(1, 5, semantic.COLUMNS)
    distinct = np.array([np.bincount(np.frombuffer(k, np.uint16), minlength=semantic.COLUMNS) for k in sorted(kinds)], float)
    tfidf = distinct * idf
    tfidf /= np.linalg.norm(tfidf, axis=1, keepdims=True)
    basis = draw.standard_normal((semantic.COLUMNS, 7))
    passages = spark.createDataFrame([(k,) for k in kinds], "words binary").repartition(3)
    np.testing.assert_allclose(semantic._product(passages, idf, basis), tfidf.T @ (tfidf @ basis), rtol=1e-4, atol=1e-3)
    space = semantic.fit(docs, docs.limit(0))
    held = (counts > 0).sum(axis=0)
    idf = np.where(held, np.log((1 + len(rows)) / (1 + held)) + 1e-3, np.log(1 + len(rows)))
    np.testing.assert_allclose(space.weights, idf, rtol=1e-5)
    assert len(distinct) == 81
    tfidf = distinct * idf
    tfidf /= np.linalg.norm(tfidf, axis=1, keepdims=True)
    strength, axes = np.linalg.svd(tfidf, full_matrices=False)[1:]
    want, got = (idf[:, None] * axes[:3].T / strength[:3]), space.vectors[:, :3]
    cosines = np.abs((want * got).sum(axis=0)) / np.linalg.norm(want, axis=0) / np.linalg.norm(got, axis=0)
    assert (cosines > 0.999).all() and np.allclose(np.linalg.norm(want, axis=0), np.linalg.norm(got, axis=0), rtol=1e-2)


def test_pairs_meet_in_the_bucket_of_their_first_common_run(spark):
    """A bucket gives a pair only if what is left of both sets from its run on suffices; equal sets of 100 that agree up to there meet earlier."""
    schema = "inside boolean, token bigint, node bigint, n int, pos int, label bigint, " + ", ".join(f"k{i} bigint" for i in range(jaccard.BRIEF))
    none = (None,) * jaccard.BRIEF
    rows = [(False, token, node, 100, pos, node, *none) for token, pos in ((7, 8), (8, 6), (9, 5)) for node in (token * 10, token * 10 + 1)]
    buckets = spark.createDataFrame(rows + [(True, 1, 5, 100, 0, 5, *none), (True, 1, 6, 100, 0, 6, *none)], schema)
    found = jaccard._pairs(buckets, buckets, 90).collect()
    assert {(r["a"], r["b"]) for r in found} == {(90, 91), (5, 6)}


def test_pairs_that_met_in_an_earlier_bucket_are_left_to_it(spark):
    schema = "inside boolean, token bigint, node bigint, n int, pos int, prev bigint, label bigint, " + ", ".join(f"k{i} bigint" for i in range(jaccard.BRIEF))
    none = (None,) * jaccard.BRIEF
    rows = [(7, 1, None), (7, 2, None), (8, 1, 7), (8, 2, 7), (9, 3, 5), (9, 4, 6), (10, 5, 4), (10, 6, None)]
    buckets = spark.createDataFrame([(False, token, node, 1000, 1, prev, node, *none) for token, node, prev in rows], schema)
    found = [(r["a"], r["b"]) for r in jaccard._pairs(buckets.where("token <> 7"), buckets, 90).collect()]
    assert sorted(found) == [(3, 4), (5, 6)]
    assert (1, 2) in {(r["a"], r["b"]) for r in jaccard._pairs(buckets, buckets, 90).collect()}


def test_rows_of_buckets_have_one_width(spark, monkeypatch):
    """What is shuffled by runs does not grow with the sets: a row has no list, and names the shared run before it."""
    made, step = [], jaccard._buckets

    def run(*given):
        out = step(*given)
        made.extend((out.schema, out.collect()))
        return out

    monkeypatch.setattr(jaccard, "_buckets", run)
    words = [f"w{i}" for i in range(1500)]
    rows = [(d, " ".join([*words[: 1200 - 300 * d], *(f"d{d}x{i}" for i in range(300 * d))])) for d in range(3)]
    rows.append((9, rows[2][1] + " y"))
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, 3, 90)
    schema, buckets = made
    assert not [f.name for f in schema.fields if f.dataType.typeName() == "array"]
    firsts = {node: min(r["pos"] for r in buckets if r["node"] == node) for node in {r["node"] for r in buckets}}
    assert all((r["prev"] is None) == (r["pos"] == firsts[r["node"]]) for r in buckets)


def test_space_of_all_distinct_passages(spark, monkeypatch):
    """The product that gives the directions has every distinct passage of the documents and the items once, however many there are."""
    docs = spark.createDataFrame([(f"one{i} two{i % 7} three",) for i in range(30_000)] * 2, "text string").repartition(6)
    items = spark.createDataFrame([(f"item{i} of some words",) for i in range(40)], "text string")
    seen, product = [], semantic._product
    monkeypatch.setattr(semantic, "_product", lambda passages, *rest: seen.append(passages.count()) or product(passages, *rest))
    monkeypatch.setattr(semantic, "HELD_PASSAGES", 1_000)
    semantic.fit(docs, items)
    assert seen == [40, 30_040]


def _scan(words, queries):
    """(text, query) of every leak that a plain scan of all windows by common subsequence and answer finds."""
    want, half = set(), semantic.BLOCK // 2
    for text in range(words.n):
        own = words.hash[words.first[text] : words.first[text + 1]].tolist()
        for size, index in queries.by_size.items():
            for query in index:
                for at in range(0, len(own), semantic.BLOCK):
                    window = own[max(0, at - half) : at + size * semantic.BLOCK + half]
                    if semantic.verdict(queries.words[query], queries.answers[query], window)[1]:
                        want.add((text, int(query)))
    return want


def _near_share(words, space, queries):
    """Part of the pairs of a window and an item of many words that are candidates by cosine."""
    starts = (np.arange(len(words.hash)) - words.first[words.doc]) % semantic.BLOCK == 0
    owner = words.doc[starts]
    latent = semantic._sums(space.vectors, semantic._columns(words.hash), np.flatnonzero(starts))
    near = sum(len(rows) for *_, rows in semantic._by_cosine(latent, np.searchsorted(owner, owner, side="right"), queries, semantic.COSINE))
    return near / len(latent) / sum(len(w) >= semantic.FEW_WORDS for w in queries.words)


def test_leaks_as_a_scan(spark, sample):
    """Nine of ten leaks of a plain scan at each of 100 to 50 % of the words and any offset, from few candidates; with random vectors there are many."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    space = semantic.fit(sample, items)
    draw = np.random.default_rng(8)
    host = [r["text"] for r in sample.where("text IS NOT NULL").orderBy("doc_id").limit(40).collect()]
    rows = items.orderBy("item_id").limit(40).collect()
    chosen = [(r["item_id"], r["text"]) for r in rows] + [(-1, "a short item of nine words in a row")]
    queries = semantic.prepare(chosen, space)
    rare = semantic.rare_words(queries, space)
    found_any = 0
    for kept in (1.0, 0.8, 0.7, 0.6, 0.5):
        texts = []
        for n, (_, text) in enumerate(chosen):
            words = [w if draw.random() < kept else f"new{draw.integers(10**6)}" for w in text.split()]
            texts.append(" ".join([*[f"pad{i}" for i in range(draw.integers(0, 30))], *words, *host[n % len(host)].split()[:60]]))
        words = Texts(pa.array(texts, pa.string()), lower=True)
        found, want = set(semantic.leaked_items(words, space, queries, rare, semantic.COSINE)), _scan(words, queries)
        assert found <= want and len(found) >= 0.9 * len(want)
        few = {(t, q) for t, q in want if len(queries.words[q]) < semantic.FEW_WORDS}
        assert few <= found
        found_any += len(want)
    assert found_any >= 80
    words = Texts(pa.array(host, pa.string()), lower=True)
    other = semantic.Space(space.weights, draw.standard_normal(space.vectors.shape).astype(np.float32))
    share, without = _near_share(words, space, queries), _near_share(words, other, semantic.prepare(chosen, other))
    assert share < 0.08 < without, (share, without)


def test_long_items(spark):
    """The last words of a long item are searched, and its answer beside the passage counts."""
    item = [f"i{n}" for n in range(157)] + ["Answer:", "yes", "indeed"]
    tail = " ".join(["pad"] * 20 + item[128:])
    half = " ".join(w if n % 5 < 3 or n > 156 else f"other{n}" for n, w in enumerate(item))
    docs = spark.createDataFrame([(1, tail), (2, half), (3, " ".join(half.split()[:96]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    alike = semantic.Space(np.ones(semantic.COLUMNS), np.ones((semantic.COLUMNS, 2)))
    queries = semantic.prepare([(1, " ".join(item))], alike)
    assert queries.words[-1] == Texts(pa.array([" ".join(item)], pa.string()), lower=True).hash[-semantic.PASSAGE :].tolist()
    assert {r["doc_id"] for r in semantic.leaks(docs, items).collect()} == {1, 2}
    best = semantic.leaked_items(Texts(pa.array([half], pa.string()), lower=True), alike, queries, semantic.rare_words(queries, alike), semantic.COSINE)
    assert {queries.around[q] for _, q in best} == {(0, 96), (64, 32), (96, 0)}


def test_answers():
    assert semantic.answer_of("What is it? A cat.").strip() == "A cat."
    assert semantic.answer_of("One. Two three.") == "Two three"
    needle, answer = list(range(20)), [18, 19]
    half = list(range(0, 20, 2))
    assert semantic.verdict(needle, answer, needle)[1] and not semantic.verdict(needle, answer, half + [99])[1]
    assert semantic.verdict(needle, answer, half[:-1] + [18, 19])[1] and not semantic.verdict([1, 2], [2], [1, 3, 2])[1]


@pytest.mark.parametrize("table", ["edge", "empty"])
def test_pipeline_edges(spark, request, table):
    """Nulls, repeated rows, long texts, clashing columns and empty tables pass through every stage."""
    docs = stored(request.getfixturevalue(table), "documents")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, "/root/testdata/sf0.001"), "stage")
        if name == "shards":
            assert set(columns) <= set(after.columns) and after.count() == before.count()
        else:
            assert after.columns == columns and not after.where("text IS NULL").count()
        if name != "mix":
            assert not after.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).count()
        if table == "empty":
            assert not after.count()
        before = after


def test_pipeline(spark):
    """Every stage on what its predecessor kept, and its decisions against plain loops."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, folder), "stage")
        results[name] = (before, after)
        if name != "shards":
            assert after.columns == columns
        before = after
    ids = {n: (Counter(r["doc_id"] for r in a.collect()), Counter(r["doc_id"] for r in b.collect())) for n, (a, b) in results.items()}
    assert len(ids["language"][1]) >= 0.97 * len(ids["language"][0])
    components_ = brute_components([(r["doc_id"], r["text"]) for r in results["near copies"][0].collect()], corpus_pipeline.SHINGLE, corpus_pipeline.ALIKE)
    assert ids["near copies"][1] == Counter({c for _, _, c in components_})
    gone = set(ids["benchmark"][0]) - set(ids["benchmark"][1])
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in results["benchmark"][0].collect() if any(i in " ".join((r["text"] or "").lower().split()) for i in items)}
    assert held <= gone and len(gone - held) <= 0.01 * len(ids["benchmark"][0])
    want = Counter()
    for r in mixing.copies(results["mix"][0]).collect():
        want[r["doc_id"]] += r["copies"]
    assert ids["mix"][1] == +want
    assert ids["shards"][0] == ids["shards"][1]
    placed = results["shards"][1]
    check_shards(results["shards"][0], placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"), sharding.SHARDS)
