"""Personal data by bootstrapped contextual extraction.

Entities found by fixed patterns are the seeds.  The words before a seed are a
lexical pattern; Spark scores the graph of patterns and instances (identifier-like
words that follow a pattern) in rounds: a pattern is trusted by the trusted
instances among its own, an instance by its patterns.  Trusted patterns mark
identifiers that no fixed pattern knows.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.llm.common import stored, text_key

# The base kinds in the order of the spans; ``context`` is what the method adds.  A match takes whole runs of
# digits, so an address starts where a run does: no run is tried from its middle, and a long one costs its length once.
KINDS = ("email", "ip", "card", "phone", "context")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_INSTANCE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rounds of scoring; different seed values a pattern needs; the trust from which patterns and instances count.
ROUNDS = 3
SUPPORT = 5
TRUST = 0.8
#: Digits of an identifier, at least.
DIGITS = 5
#: Characters before an identifier in which its pattern lies.
REACH = 128


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in turn: an address starts where the run of name characters before its sign starts."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = PATTERNS["email"].match(text, start) if start < sign else None
        if match:
            done = match.end()
            yield start, done
        sign = text.find("@", max(sign + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the seeds of one text, by kind and start."""
    out = [(0, *span) for span in _emails(text)]
    for m in PATTERNS["ip"].finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in PATTERNS["card"].finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PATTERNS["phone"].finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def _context(text: str, start: int) -> str:
    """The last two words in the ``REACH`` characters before ``start``, in lower case, digits as 0.

    What is specific to one instance does not count.  A longer word counts by its end, so
    that text without spaces costs the same for each finding.
    """
    words = _WORD.findall(text, max(0, start - REACH), start)
    return re.sub(r"[0-9]+", "0", " ".join(words[-2:]).lower())


def findings(text: str) -> list[tuple[int, int, int, str, str]]:
    """(kind, start, end, value, context) of the seeds, and of identifier-like words apart from them (kind ``context``)."""
    seeds = base_spans(text)
    out = [(k, a, b, text[a:b], _context(text, a)) for k, a, b in seeds]
    taken = sorted((a, b) for _, a, b in seeds)
    at = 0
    for m in _INSTANCE.finditer(text):
        word = m[0].strip("\"'.,;:!?()[]{}<>|")
        if sum(c.isdigit() for c in word) < DIGITS:
            continue
        start = m.start() + m[0].find(word)
        end = start + len(word)
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        out.append((4, start, end, word, _context(text, start)))
    return out


_SCHEMA = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("value", T.StringType()), T.StructField("context", T.StringType()),
])


def _found(keyed: DataFrame) -> DataFrame:
    """``text_key`` and the findings of every text that has any; one Arrow row per finding."""
    schema = T.StructType([keyed.schema["text_key"], *_SCHEMA.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, rows = [], []
            for i, text in enumerate(batch.column("text")):
                got = findings(text.as_py() or "")
                owners += [i] * len(got)
                rows += got
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key").take(pa.array(owners, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names
            )

    return keyed.select("text_key", "text").mapInArrow(run, schema)


def trusted_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """``context`` and ``trust`` of the patterns that hold after the last round.

    Edges join a pattern and a value, once each.  Seed values have trust 1,
    others start at 0; a pattern's trust is the mean over its values, and a
    value's is the chance that one of its patterns is right.
    """
    edges = stored(
        found.where("context <> ''").groupBy("context", "value").agg(F.max((F.col("kind") < 4).cast("double")).alias("seed")), "edges"
    )
    values = edges.groupBy("value").agg(F.max("seed").alias("trust"))
    patterns = None
    for _ in range(rounds):
        scored = edges.join(values, "value").groupBy("context").agg(
            F.avg("trust").alias("trust"), F.sum(F.when(F.col("trust") >= trust, 1).otherwise(0)).alias("support")
        )
        patterns = stored(scored.where((F.col("support") >= support) & (F.col("trust") >= trust)).select("context", "trust"), "patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.coalesce("p.trust", F.lit(0.0)), F.lit(1e-6)))))
        values = stored(
            edges.alias("e").join(patterns.alias("p"), "context", "left").groupBy("value").agg(F.greatest(F.max("seed"), 1 - doubt).alias("trust")),
            "values",
        )
    return patterns


def _joined(spans: Column) -> Column:
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and then
    start; those of kind ``context`` are the identifiers found by trusted
    patterns.  A null text counts as empty: no spans, and the hash of no bytes.
    Equal texts and repeated rows have equal spans.  No rows give no rows.
    """
    keyed = docs.select("doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    found = stored(_found(keyed), "findings")
    patterns = trusted_patterns(found)
    new = found.where("kind = 4").join(patterns, "context", "left_semi")
    spans = found.where("kind < 4").unionByName(new).select("text_key", F.struct("kind", "start", "end").alias("span")).distinct()
    per_text = spans.groupBy("text_key").agg(F.array_sort(F.collect_list("span")).alias("all"))
    every = keyed.select("doc_id", "text_key").join(per_text, "text_key", "left")
    all_spans = F.coalesce("all", F.array().cast("array<struct<kind:int,start:int,end:int>>"))
    base = F.filter(all_spans, lambda s: s["kind"] < 4)

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return every.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(all_spans).alias("spans"))
