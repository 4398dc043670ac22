"""The corpus pipeline: each stage takes the documents that its predecessor kept.

A stage is given as (name, function of the session, the documents and the folder
of the tables).  All but the last return the columns of the documents.  Rows with
null texts or texts without a letter leave at the first stage; what each stage does
with ties, repeated rows and short texts is told where its operator is.  An empty
table stays empty through all of them.
"""

from pyspark.sql import DataFrame, SparkSession

from cartsight.llm import jaccard, languages, mixing, semantic, sharding
from cartsight.llm.common import stored, table

#: Words of a shingle and percent of the union that near copies share.
SHINGLE, ALIKE = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models know."""
    return languages.known_language(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return jaccard.representatives(docs, SHINGLE, ALIKE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return semantic.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language", known_language),
    ("near copies", one_of_each),
    ("benchmark", without_benchmark),
    ("mix", mixed),
    ("shards", sharded),
]
#: Language models and latent semantics have no SQL form; the stages are tested against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` after all stages; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
