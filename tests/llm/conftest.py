import pytest
from pyspark.sql import functions as F

from cartsight.llm import semantic

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "web"),
    (2, "the quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "web"),
    (2, "the quick brown fox jumps over the lazy dog near the quiet river bank today", "en", "web"),
    (3, None, "en", "web"), (4, "", None, None), (5, " \n\t ", "fr", "web"), (6, "1234 !!! 5678", "fr", "other"),
    (None, "le petit chat dort sur la chaise verte dans la cuisine de la maison", "fr", "other"),
    (None, None, None, None), (8, "🙂 é 漢字 naïve résumé", "fr", "other"), (9, LONG, "en", "long"),
    (10, "der schnelle braune Fuchs springt über den faulen Hund und läuft davon", "de", "web"),
    (11, "two words", "en", None), (12, "two words", "en", "web"),
]
#: Names that operators might use themselves.
CLASHES = ("size", "shard", "slot", "score", "token", "n", "key", "text_key", "label", "rank", "copies", "weight", "part", "kind", "cid", "__given", "held_out")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    rows = spark.createDataFrame([(*r, None) for r in ROWS], SCHEMA)
    return rows.withColumns({c: F.lit(7) for c in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table, whole."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(autouse=True)
def narrow_space(monkeypatch):
    """Small matrices for small tables."""
    monkeypatch.setattr(semantic, "COLUMNS", 1 << 12)
