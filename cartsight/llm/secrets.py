"""Secret scans through a trigram inverted index.

Each rule's regular expression gives a Boolean query of trigrams that every
match must hold.  Postings of the trigrams that any query names are written
once; the queries are answered by counting postings per text, and only the
candidates are verified with the expression.  A rule without mandatory trigrams
scans all texts.
"""

import itertools
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored, text_key

# The three base rules (expression, group that counts, its least length), and the added ones.
BASE = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
ADDED = {
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    "google": (r"AIza[A-Za-z0-9_-]+", 0, 39),
}
RULES = BASE | ADDED
#: Alternatives of a literal run that are still spelled out; beyond, the run ends there and demands less.
MOST_SPELLINGS = 64


def _letters(items: list) -> list[str] | None:
    """The characters of a class in lower case, if they are few."""
    found = set()
    for kind, value in items:
        if str(kind) == "LITERAL":
            found.add(chr(value).lower())
        elif str(kind) == "RANGE" and value[1] - value[0] < 6:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return sorted(found)


def _runs(tree) -> list[list[str]]:
    """Literal runs that each match holds one after the other; a run lists its spellings."""
    runs: list[list[str]] = [[""]]
    for kind, value in tree:
        kind, spelled = str(kind), None
        if kind == "LITERAL":
            spelled = [chr(value).lower()]
        elif kind == "IN":
            spelled = _letters(value)
        elif kind == "SUBPATTERN":
            inner = _runs(value[3])
            spelled = inner[0] if len(inner) == 1 else None
            if spelled is None:
                runs += inner + [[""]]
                continue
        elif kind == "BRANCH":
            branches = [_runs(b) for b in value[1]]
            spelled = sorted({s for b in branches for s in b[0]}) if all(len(b) == 1 for b in branches) else None
        elif kind == "MAX_REPEAT" and value[:2] == (0, 1):
            inner = _runs(value[2])
            spelled = ["", *inner[0]] if len(inner) == 1 else None
        if spelled is None or len(spelled) * len(runs[-1]) > MOST_SPELLINGS:
            runs.append([""])
        else:
            runs[-1] = ["".join(p) for p in itertools.product(runs[-1], spelled)]
    return runs


def trigram_query(expression: str) -> list[list[list[str]]]:
    """All of the outer list must hold; of each, one of the alternatives; of an alternative, all its trigrams.

    Trigrams are in lower case, as the index is.  An empty list means that
    nothing is mandatory.
    """
    query = []
    for run in _runs(regex_parser.parse(expression)):
        if all(len(s) >= 3 for s in run):
            query.append(sorted([s[i : i + 3] for i in range(len(s) - 2)] for s in run))
    return query


def _postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, text_key`` for every named trigram that a text holds."""
    lowered = texts.select("text_key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select("text_key", F.explode(held).alias("trigram"))


def _candidates(postings: DataFrame, queries: dict[str, list]) -> DataFrame:
    """``text_key, rules``: intersects the postings of every query, met text by text in a set of trigrams."""
    found = postings.groupBy("text_key").agg(F.collect_set("trigram").alias("held"))

    def holds(spelling: list[str]) -> Column:
        return F.size(F.array_except(F.lit(spelling), "held")) == 0

    def answer(query: list) -> Column:
        out = F.lit(True)
        for run in query:
            any_of = F.lit(False)
            for spelling in run:
                any_of = any_of | holds(spelling)
            out = out & any_of
        return out

    rules = F.array_compact(F.array(*(F.when(answer(q), F.lit(name)) for name, q in queries.items())))
    return found.select("text_key", rules.alias("rules")).where(F.size("rules") > 0)


def spans(text: Column, kind: str) -> Column:
    """Array of (start, kind, end) of the matches of a rule that are long enough; leftmost, without overlap, in code points."""
    expression, group, least = RULES[kind]
    whole = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    tested = whole if group == 0 else F.regexp_extract_all(text, F.lit(expression), F.lit(group))
    steps = F.arrays_zip(F.slice(F.split(text, expression, -1), 1, F.size(whole)).alias("gap"), whole.alias("hit"), tested.alias("part"))
    kinds = list(RULES)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        found = F.struct(start.alias("start"), F.lit(kinds.index(kind)).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.char_length(x["part"]) >= least, F.concat(state["out"], F.array(found))).otherwise(state["out"]).alias("out"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), _none().alias("out")), step)["out"]


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def _joined(found: Column) -> Column:
    kinds = F.lit(list(RULES))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    A null text counts as empty: no spans, and the hash of no bytes.  Spans are
    ``kind:start:end`` in code points, end exclusive, ordered by start and then
    by rule.  Repeated rows and equal texts are scanned as one text and reported
    for every row.  No rows give no rows.
    """
    queries = {k: trigram_query(rule[0]) for k, rule in RULES.items()}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for run in q for s in run for t in s})
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", text_key(F.col("text")))
    postings = stored(_postings(keyed, trigrams), "postings")
    candidates = _candidates(postings, indexed)
    verified = keyed.join(candidates, "text_key").select(
        "text_key", F.flatten(F.array(*(F.when(F.array_contains("rules", k), spans(F.col("text"), k)).otherwise(F.array()) for k in indexed))).alias("found")
    )
    for k in RULES.keys() - indexed.keys():
        expression, group, least = RULES[k]
        full = keyed.where(F.col("text").rlike(expression)) if group else keyed.where(F.col("text").rlike(f"{expression.removesuffix('+')}{{{least},}}"))
        verified = verified.unionByName(full.select("text_key", spans(F.col("text"), k).alias("found")))
    verified = stored(verified.where(F.size("found") > 0), "spans")
    per_text = verified.groupBy("text_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("found"))
    every = keyed.select("doc_id", "text_key").join(per_text, "text_key", "left")
    found = F.coalesce(F.col("found"), _none())
    base = F.filter(found, lambda s: s["kind"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == list(RULES).index(kind))).cast("bigint").alias(f"n_{kind}")

    return every.select(
        "doc_id", *(count(k) for k in BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(found).alias("spans")
    )
