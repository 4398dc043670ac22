"""Jaccard join of word n-grams by grouped prefixes.

Texts with equal sets are one class.  The prefix of a set is its rarest part:
two sets that are similar enough share a word run in their prefixes.  Classes
with identical prefix and size are collapsed into one group; groups that share a
run of their prefixes are filtered by size, by position and by a parity sketch
that bounds the difference of the sets; the rest is expanded to members and
verified on the whole sets.

Only classes are asked for, so members of a large bucket are first compared with
few others of it, and with all only while they are not connected: no link is
lost, and near copies by the thousand do not give all their pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.common import finished, stored, text_key
from cartsight.llm.components import components
from cartsight.llm.vectors import Texts, mix, pieces, shingle_sets

#: Runs counted together in a task, and the local count from which a run is reported as frequent.
COUNTED = 1_000_000
LOCAL = 2
#: A run is frequent when it has at least this part of all runs (so there are at most 2**22 of them), and at least 8.
FREQUENT = 2.0**-22
LEAST_FREQUENT = 8
#: Buckets up to this size are compared in full in the second round, where they are not connected yet; larger ones by so many times more members in each round.
SMALL = 32
#: Bytes of text that a task turns into sets at once.
PIECE = 1 << 18
#: Words of the short sketch that travels with a bucket's rows.  Larger sets, which all look alike in it, have a wide one besides, with so many cells
#: for each element in which two sets that are linked may differ: it is looked up for the pairs that are left, once each.
BRIEF = 4
CELLS = 4
#: Keys of texts that are broadcast, at most (about 16 MB); beyond, the join is left to the engine.
BROADCAST_ROWS = 250_000


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of frequent runs, sorted, and their class (logarithm of the count): these come last in the order of a prefix."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = [], 0, 0

        def report() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= LOCAL
            return pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], schema.names)

        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                for s in shingle_sets(Texts(piece.column("text"), lower=True), size):
                    held.append(s)
                    n += len(s)
                if n >= COUNTED:
                    yield report()
                    held, n, total = [], 0, total + n
        if held:
            yield report()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total + n])], schema.names)

    counts = stored(docs.select("text").mapInArrow(run, schema).groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    total = counts.where("token IS NULL").agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = counts.where((F.col("token").isNotNull()) & (F.col("n") >= max(LEAST_FREQUENT, total * FREQUENT))).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(np.maximum(rows["n"].to_numpy(np.float64), 1)).astype(np.uint8)[order] + np.uint8(1)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the counts of tokens per cell, in 64-bit words; two sketches differ in at most as many bits as the sets."""
    cells = max(64 * BRIEF, 1 << int(len(tokens) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def wide_sketch(sketch: np.ndarray, n: int, percent: int) -> np.ndarray | None:
    """The sketch of a set of ``n``, folded as far as it still tells sets apart; None where the short one does."""
    least = CELLS * 2 * n * (100 - percent) / (100 + percent) / 64
    while len(sketch) > BRIEF and len(sketch) // 2 >= least:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch if len(sketch) > BRIEF else None


def _set_rows(keyed: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n, s1, s2, prefix, sketch, brief, wide`` for every row: size and signature of its set, the prefix, and parity sketches."""
    frequent = keyed.sparkSession.sparkContext.broadcast(_frequent(keyed, size))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        keyed.schema["doc_id"], keyed.schema["text_key"], T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()),
        T.StructField("s2", T.LongType()), T.StructField("prefix", longs), T.StructField("sketch", longs), T.StructField("brief", longs),
        T.StructField("wide", longs),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, classes = frequent.value
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                sets = shingle_sets(Texts(piece.column("text"), lower=True), size)
                counts = np.array([len(s) for s in sets], np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
                rank = np.zeros(len(tokens), np.uint8)
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    rank = np.where(common[at] == tokens, classes[at], 0).astype(np.uint8)
                total = np.zeros((2, len(tokens) + 1), np.uint64)
                np.cumsum(mix(tokens + np.uint64(1)), out=total[0, 1:])
                np.cumsum(mix(tokens ^ np.uint64(0x5555555555555555)), out=total[1, 1:])
                signs = mix(total[:, bounds[1:]] - total[:, bounds[:-1]]).view(np.int64)
                prefixes, sketches = [], []
                for i, s in enumerate(sets):
                    length = prefix_size(len(s), percent) if len(s) else 0
                    own = rank[bounds[i] : bounds[i + 1]]
                    prefixes.append((s[np.argsort(own, kind="stable")[:length]] if own.any() else s[:length]).view(np.int64))
                    sketches.append(parity_sketch(s) if len(s) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("text_key"), pa.array(counts), pa.array(signs[0]), pa.array(signs[1]), _lists(prefixes), _lists(sketches),
                    _lists([np.bitwise_xor.reduce(s.reshape(-1, BRIEF), axis=0) if len(s) else s for s in sketches]),
                    pa.array([wide_sketch(s, len(own), percent) for s, own in zip(sketches, sets)], pa.list_(pa.int64())),
                ], schema.names)

    return keyed.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _grouped(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``classes`` with the group they belong to (its smallest class), and the members of groups of more than one class."""
    keyed = classes.select("cid", "n", F.xxhash64("prefix").alias("h1"), F.hash("prefix").alias("h2"))
    groups = keyed.groupBy("n", "h1", "h2").agg(F.min("cid").alias("gid"), F.count(F.lit(1)).alias("members")).where("members > 1")
    return stored(keyed.join(groups, ["n", "h1", "h2"]).select("gid", "cid", "n"), "groups")


def _buckets(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups that share a run of their prefixes, and classes that share a group.

    ``inside, token, node, m, first, pos, prev, n`` and the words of the short sketch,
    which are null for a group of several classes.  Runs that the same nodes share
    are one bucket: ``token`` tells its members, and ``pos`` is the place of the
    first of these runs, which is the same run for all of them.  ``prev`` is the
    last run before it that the node shares with any other.
    """
    named = classes.join(groups.select("cid", "gid"), "cid", "left")
    nodes = named.select(F.col("cid").alias("node"), F.col("n").cast("int").alias("n"), F.col("gid").isNotNull().alias("many"), "brief")
    tokens = named.where("gid IS NULL OR gid = cid").select(F.lit(False).alias("inside"), F.col("cid").alias("node"), F.posexplode("prefix").alias("pos", "token"))
    rows = tokens.select("inside", "token", "node", "pos").unionByName(
        groups.select(F.lit(True).alias("inside"), F.col("gid").alias("token"), F.col("cid").alias("node"), F.lit(0).alias("pos"))
    )
    # The runs of all prefixes are shuffled once, and with no more than this; what few are shared get the rest by their node.
    same = Window.partitionBy("inside", "token")
    members = F.bit_xor(F.xxhash64("node")).over(same)  # equal by chance: one bucket of more nodes, in which no pair is missing
    rows = rows.withColumns({"m": F.count(F.lit(1)).over(same), "first": F.min("node").over(same), "members": members}).where("m > 1")
    before = F.lag("token").over(Window.partitionBy("node").orderBy("inside", "pos"))
    rows = rows.withColumn("prev", F.when(~F.col("inside"), before)).groupBy("inside", F.col("members").alias("token"), "node", "m", "first")
    rows = rows.agg(F.min("pos").alias("pos"), F.min_by("prev", "pos").alias("prev"))
    brief = {f"k{i}": F.when(F.col("inside") | ~F.col("many"), F.get("brief", F.lit(i))) for i in range(BRIEF)}
    return stored(rows.join(nodes, "node").withColumns(brief).drop("brief", "many"), "buckets")


def _enough(overlap: Column, percent: int) -> Column:
    return overlap * (100 + percent) >= percent * (F.col("a_n") + F.col("b_n"))


def _pairs(left: DataFrame, right: DataFrame, percent: int, drawn: Column | None = None, sketches: DataFrame | None = None) -> DataFrame:
    """``inside, a, b`` of bucket members with different labels that size, position and sketches do not rule out, once each.

    ``drawn`` tells which rows of ``right`` are in ``left`` too: two of these meet once.  ``sketches`` has ``node, n, wide`` of
    the nodes with a wide sketch.  With a column ``prev``, two members with the same earlier run are left to an earlier bucket.
    """
    left, right = left.withColumn("drawn", F.lit(True)), right.withColumn("drawn", F.lit(False) if drawn is None else drawn)

    def side(rows: DataFrame, x: str) -> DataFrame:
        rows = rows if "prev" in rows.columns else rows.withColumn("prev", F.lit(None).cast("bigint"))
        names = ("node", "n", "pos", "prev", "label", "drawn", *(f"k{i}" for i in range(BRIEF)))
        return rows.select("inside", "token", *(F.col(c).alias(f"{x}_{c}") for c in names))

    # Prefixes have one order: before the first run that two sets share they have none in common, so the bucket of that run bounds
    # the overlap by what is left of either set from there on, and no run before it is the same.  Their other buckets need not find them.
    most = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    possible = F.when(F.col("inside"), F.least("a_n", "b_n")).otherwise(most)
    met_before = F.coalesce(F.col("a_prev") == F.col("b_prev"), F.lit(False))
    unlike = sum((F.bit_count(F.col(f"a_k{i}").bitwiseXOR(F.col(f"b_k{i}"))) for i in range(BRIEF)), F.lit(0))
    alike = F.coalesce(_enough((F.col("a_n") + F.col("b_n") - unlike) / 2, percent), F.lit(True))
    met = side(left, "a").join(side(right, "b"), ["inside", "token"])
    met = met.where(F.col("a_label") != F.col("b_label")).where((F.col("a_node") < F.col("b_node")) | ~F.col("b_drawn"))
    met = met.where(~met_before & _enough(possible, percent) & alike)
    pairs = met.select("inside", F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    if sketches is None:
        return pairs
    for x in "ab":
        pairs = pairs.join(sketches.select(*(F.col(c).alias(y) for c, y in (("node", x), ("n", f"{x}_n"), ("wide", f"{x}_wide")))), x, "left")
    wide = F.coalesce(_enough((F.col("a_n") + F.col("b_n") - _unlike("a_wide", "b_wide")) / 2, percent), F.lit(True))
    return pairs.where(wide).select("inside", "a", "b")


def _expanded(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of groups as pairs of their members; pairs inside a group are such already."""
    members = groups.select("gid", "cid")
    a, b = members.select(F.col("gid").alias("a"), F.col("cid").alias("a_member")), members.select(F.col("gid").alias("b"), F.col("cid").alias("b_member"))
    across = pairs.where("NOT inside").join(a, "a", "left").join(b, "b", "left")
    across = across.select(F.coalesce("a_member", "a").alias("a"), F.coalesce("b_member", "b").alias("b"))
    return across.unionByName(pairs.where("inside").select("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _unlike(a: str, b: str) -> Column:
    """Bits in which two parity sketches differ, the longer one folded to the length of the other."""

    def folded(x: str, y: str) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))

    bits = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave room for enough in common."""
    a = classes.select(F.col("cid").alias("a"), F.col("n").alias("a_n"), F.col("sketch").alias("a_sketch"))
    b = classes.select(F.col("cid").alias("b"), F.col("n").alias("b_n"), F.col("sketch").alias("b_sketch"))
    both = pairs.join(a, "a").join(b, "b")
    most = (F.col("a_n") + F.col("b_n") - _unlike("a_sketch", "b_sketch")) / 2
    return both.where(_enough(F.least("a_n", "b_n"), percent)).where(_enough(most, percent)).select("a", "b", "a_n", "b_n")


def _whole_sets(keyed: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``cid, tokens``: the whole sets of the wanted classes, from the text of one document of each."""
    classes = wanted.count()
    near = F.broadcast(wanted) if classes <= BROADCAST_ROWS else wanted
    rows = keyed.join(near, keyed["text_key"].eqNullSafe(near["rep"]["text_key"]) & keyed["doc_id"].eqNullSafe(near["rep"]["doc_id"]))
    schema = T.StructType([T.StructField("cid", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                sets = shingle_sets(Texts(piece.column("text"), lower=True), size)
                yield pa.RecordBatch.from_arrays([piece.column("cid"), _lists([s.view(np.int64) for s in sets])], schema.names)

    sets = stored(rows.select("cid", "text").mapInArrow(run, schema), "sets")
    return sets if sets.count() == classes else stored(sets.dropDuplicates(["cid"]), "sets")  # rows that repeat give their set again


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a, b = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("a_set")), sets.select(F.col("cid").alias("b"), F.col("tokens").alias("b_set"))
    both = pairs.join(a, "a").join(b, "b")
    return both.where(_enough(F.size(F.array_intersect("a_set", "b_set")), percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _shortcuts(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node within two links of each node; equal roots mean connected nodes."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    one = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
    two = both.join(one.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("root"))
    return two.withColumnRenamed("u", "node")


def _labelled(buckets: DataFrame, groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``buckets`` that hold more than one label.

    A class has its root; a group has that of its classes if
    they share one, else a label that no other has, so that it is compared.
    """
    roots = labels.select(F.col("node").alias("cid"), "root")
    mixed = groups.join(roots, "cid", "left").groupBy("gid").agg(
        F.min(F.coalesce("root", "cid")).alias("low"), F.max(F.coalesce("root", "cid")).alias("high")
    ).where("low < high").select(F.col("gid").alias("node"), F.lit(False).alias("inside"), F.lit(True).alias("mixed"))
    named = buckets.drop("label").join(roots.withColumnRenamed("cid", "node"), "node", "left").join(mixed, ["node", "inside"], "left")
    named = named.withColumn("label", F.when(F.col("mixed"), -1 - F.col("node")).otherwise(F.coalesce("root", "node"))).drop("root", "mixed")
    same = Window.partitionBy("inside", "token")
    several = named.withColumns({"low": F.min("label").over(same), "high": F.max("label").over(same)}).where("low < high")
    return stored(several.drop("low", "high"), "open")


def _links(keyed: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links (u, v) that connect all classes that are connected at all; None where no two classes share a bucket."""
    groups = _grouped(classes)
    buckets = _buckets(classes, groups).withColumn("label", F.col("node"))
    largest = buckets.agg(F.max("m").alias("m")).first()["m"]
    if largest is None:
        return None
    # The nodes whose sketch may rule a pair out at once; a group of several classes has none.
    sketches = classes.where("wide IS NOT NULL").select(F.col("cid").alias("node"), "n", "wide").join(groups.select(F.col("gid").alias("node")), "node", "left_anti")
    # Every bucket's first member against the others, whether they met before or not: as many rows as the buckets have, and near copies are connected by it.
    firsts = buckets.drop("prev")
    pairs, opened = _pairs(firsts.where("node = first"), firsts.where("node <> first"), percent, None, sketches), buckets
    chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / (1 << 30)
    sets, links, compared = None, None, 2
    while True:
        candidates = stored(_sketched(_expanded(pairs, groups).distinct(), classes, percent), "candidates")
        asked = candidates.select(F.col("a").alias("cid")).union(candidates.select("b")).distinct()
        wanted = asked if sets is None else asked.join(sets.select("cid"), "cid", "left_anti")
        more = _whole_sets(keyed, stored(wanted.join(classes.select("cid", "rep"), "cid"), "wanted"), size)
        sets = more if sets is None else sets.unionByName(more)
        found = _verified(candidates, sets.join(asked, "cid", "left_semi"), percent)
        links = stored(found if links is None else links.unionByName(found), "links")
        if compared >= largest:
            return links
        # What is still not connected: whole buckets up to ``compared`` members, a draw of about so many from larger ones.
        opened = _labelled(opened.where(F.col("m") > compared).drop("first"), groups, stored(_shortcuts(links), "roots"))
        compared = max(SMALL, compared * SMALL)
        drawn = chance * F.col("m") < compared
        pairs = _pairs(opened.where(drawn), opened, percent, drawn, sketches)


def link_documents(docs: DataFrame, size: int = 3, percent: int = 90, key: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; with ``key``, also ``text_key``.

    The set of a text: distinct runs of ``size`` words in lower case (A to Z), or
    the whole sequence of fewer words.  Two texts are linked when they share
    ``percent`` of their union.  ``component_id`` is the smallest id that is
    reachable by links; a null or empty text, or one of white space, has an
    empty set and its own id.  A null id takes part, counts as larger than every
    other, and gets the component's id.  Repeated rows are equal texts.  No rows
    give no rows.
    """
    return finished(docs.sparkSession, lambda: _components_of(docs, size, percent, key), "components")


def _components_of(docs: DataFrame, size: int, percent: int, key: bool) -> DataFrame:
    keyed = docs.select("doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    rows = stored(_set_rows(keyed, size, percent), "prefixes")
    signed = rows.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief"), F.first("wide").alias("wide")
    )
    classes = stored(signed.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links = _links(keyed, classes, size, percent)
    own = classes.select("s1", "s2", "n", "cid", "first_id")
    if links is None:
        named = own.withColumn("component_id", F.col("first_id"))
    else:
        rooted = own.join(components(links).withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = rooted.join(least, "root")
    named = named.select("s1", "s2", "n", "component_id")
    columns = ["doc_id", *(["text_key"] if key else [])]
    joined = rows.select(*columns, "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    return joined.select(*columns, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One row of each component of ``docs``, with its columns as they are: the smallest id, the first of equal texts.

    Rows with an empty set stay.  Where all ids of a component are null, its
    rows stay, except for repeats.
    """
    gone = link_documents(docs, size, percent, key=True).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = stored(gone.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct(), "copies")
    same = docs["doc_id"].eqNullSafe(gone["id"]) & (text_key(docs["text"]) == gone["key"])
    kept = docs.join(gone, same, "left_anti")
    keyed = kept.select("doc_id", text_key(kept["text"]).alias("key"))
    return kept if keyed.groupBy("doc_id", "key").count().where("count > 1").isEmpty() else _first_of_repeats(kept)


def _first_of_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose id and text occurred before; rows without a word stay."""
    wordless = F.coalesce(F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")), F.lit(0)) == 0
    worded = docs.where(~wordless)
    rows = worded.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), worded["doc_id"].alias("id"), text_key(worded["text"]).alias("key"))
    return docs.where(wordless).unionByName(rows.dropDuplicates(["id", "key"]).select("row.*"))
