"""Interpolated Kneser-Ney models of characters as tables, and scores of texts by joins with them.

Counts, discounts and back-off weights are aggregates over all n-grams; none is
left out.  :mod:`cartsight.llm.languages` packs tables that are small enough into
sorted arrays; larger ones stay tables, and texts meet them here.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.llm.common import stored

ORDER = 4
START, END = 2, 3
#: A word is a run of letters; anything else lies between words.
BETWEEN = r"[^\p{L}]+"


class Tables(NamedTuple):
    """``chances``: ``lang, k, gram, value``, the discounted probability of the last of ``k`` characters after the others.
    ``weights``: ``lang, k, gram, value``, what a context of ``k - 1`` characters leaves to the order below.
    ``floors``: ``lang, value``, the probability of a character that the language never showed."""

    chances: DataFrame
    weights: DataFrame
    floors: DataFrame


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def _grams(word: str) -> Column:
    """All runs of ``ORDER`` characters in a padded word: one for each of its characters and one for its end."""
    padded = F.concat(F.lit(chr(START) * (ORDER - 1)), F.col(word), F.lit(chr(END)))
    return F.transform(F.sequence(F.lit(1), F.char_length(word) + 1), lambda i: F.substr(padded, i, F.lit(ORDER)))


def gram_counts(training: DataFrame) -> DataFrame:
    """``lang, gram, n``: all runs of ``ORDER`` characters in the padded words of the training rows (lang, text)."""
    words = training.select("lang", F.explode(_words("text")).alias("word")).groupBy("lang", "word").count()
    return words.select("lang", "count", F.explode(_grams("word")).alias("gram")).groupBy("lang", "gram").agg(F.sum("count").alias("n"))


def model_tables(training: DataFrame) -> Tables:
    """The models of all languages of ``training`` (lang, text).

    Lower orders count the distinct characters before an n-gram.  The discount of
    an order is ones / (ones + 2 * twos), kept between 0.1 and 0.95.  No training
    rows, or none with a letter, give empty tables.
    """
    level = stored(gram_counts(training), "grams")
    chances, weights = [], []
    ones, twos = (F.sum((F.col("n") == n).cast("bigint")) for n in (1, 2))
    discount = F.least(F.lit(0.95), F.greatest(F.lit(0.1), ones / F.greatest(F.lit(1), ones + 2 * twos)))
    for k in range(ORDER, 0, -1):
        order = level.groupBy("lang").agg(discount.alias("discount"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        order = stored(order, f"order-{k}")
        value = ((F.col("n") - F.col("discount")) / F.col("total")).alias("value")
        if k == 1:
            chances.append(level.join(order, "lang").select("lang", F.lit(k).alias("k"), "gram", value))
            break
        headed = level.withColumn("head", F.substring("gram", 1, k - 1))
        heads = headed.groupBy("lang", "head").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        heads = heads.join(order.select("lang", "discount"), "lang")
        chances.append(headed.join(heads, ["lang", "head"]).select("lang", F.lit(k).alias("k"), "gram", value))
        left = F.col("discount") * F.col("kinds") / F.col("total")
        weights.append(heads.select("lang", F.lit(k).alias("k"), F.col("head").alias("gram"), left.alias("value")))
        level = level.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = stored(level, f"grams-{k - 1}")
    # The characters of all languages, the one that pads a word's start, and one for those never seen.
    alphabet = level.agg((F.count_distinct("gram") + 2).alias("alphabet"))
    floors = order.join(F.broadcast(alphabet)).select("lang", (F.col("discount") * F.col("kinds") / F.col("total") / F.col("alphabet")).alias("value"))
    return Tables(
        stored(reduce(DataFrame.unionByName, chances), "chances"), stored(reduce(DataFrame.unionByName, weights), "weights"), stored(floors, "floors")
    )


def gram_scores(grams: DataFrame, tables: Tables) -> DataFrame:
    """``gram, lang, score``: the logarithm of the chance of the last character of each of ``grams`` under every language."""
    floors = tables.floors.agg(F.collect_list(F.struct("lang", "value")).alias("floors"))  # one entry a language
    scored = grams.join(F.broadcast(floors)).select("gram", F.inline("floors").alias("lang", "chance"))
    for k in range(1, ORDER + 1):
        tail = F.substring("gram", ORDER - k + 1, k)
        own = tables.chances.where(F.col("k") == k).select("lang", F.col("gram").alias("tail"), F.col("value").alias("own"))
        scored = scored.withColumn("tail", tail).join(own, ["lang", "tail"], "left")
        rest = F.col("chance")
        if k > 1:
            head = tables.weights.where(F.col("k") == k).select("lang", F.col("gram").alias("head"), F.col("value").alias("weight"))
            scored = scored.withColumn("head", F.substring("tail", 1, k - 1)).join(head, ["lang", "head"], "left")
            rest = F.coalesce("weight", F.lit(1.0)) * rest
        scored = scored.select("gram", "lang", (F.coalesce("own", F.lit(0.0)) + rest).alias("chance"))
    return scored.select("gram", "lang", F.log("chance").alias("score"))


def measured_by_joins(docs: DataFrame, tables: Tables, keys: list[str], evidence: int) -> DataFrame:
    """``keys``, the best language, its cross-entropy per character, its score, letters and characters of every row of ``docs``.

    ``docs`` has ``text`` and its ``text_key``.  A distinct text is split into its
    words once, distinct words into n-grams, and distinct n-grams meet the model
    tables; sums go back the same way.  Texts without a letter have no language.
    """
    texts = docs.groupBy("text_key").agg(F.first("text").alias("text"))
    words = stored(texts.select("text_key", F.explode(_words("text")).alias("word")).groupBy("text_key", "word").count(), "text-words")
    inside = words.select("word").distinct().select("word", F.explode(_grams("word")).alias("gram"))
    inside = stored(inside.groupBy("word", "gram").agg(F.count(F.lit(1)).alias("times")), "word-grams")
    scores = stored(gram_scores(inside.select("gram").distinct(), tables), "gram-scores")
    per_word = inside.join(scores, "gram").groupBy("word", "lang").agg(F.sum(F.col("times") * F.col("score")).alias("score"))
    letters = F.col("count") * F.char_length("word")
    per_text = words.join(per_word, "word").groupBy("text_key", "lang").agg(
        F.sum(F.col("count") * F.col("score")).alias("total"), F.sum(letters).alias("letters"), F.sum(letters + F.col("count")).alias("characters")
    )
    ranked = per_text.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("total") / F.col("characters")).alias("entropy"), "lang"))).alias("ranked"),
        F.first("letters").alias("letters"), F.first("characters").alias("characters"),
    )
    lowest = F.get("ranked", F.lit(0))
    shares = F.transform("ranked", lambda r: F.exp((lowest["entropy"] - r["entropy"]) * F.least(F.col("characters"), F.lit(evidence))))
    chance = 1 / F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    best = ranked.select("text_key", lowest["lang"].alias("best"), lowest["entropy"].alias("entropy"), chance.alias("score"), "letters", "characters")
    return docs.select(*keys).join(stored(best, "text-scores"), "text_key", "left").fillna({"entropy": 0.0, "score": 0.0, "letters": 0, "characters": 0}).select(
        *keys, "best", "entropy", "score", "letters", "characters"
    )
