"""The registered queries of this subpackage: each applies one operator, with its usual parameters, to its whole table."""

from cartsight.llm import alignment, html, jaccard, languages, mixing, outliers, personal, quality, secrets, semantic, sharding, toxicity, whitening
from cartsight.llm.common import table
from cartsight.llm.oracle import ORACLES


def op1_language(spark, sf_dir):
    return languages.identify(table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    return semantic.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_jaccard_join(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op7_personal(spark, sf_dir):
    return personal.find(table(spark, sf_dir, "documents"))


def op8_html_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op9_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_outliers(spark, sf_dir):
    return outliers.judge(table(spark, sf_dir, "documents"))


def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_sharding, op3_secrets, op4_mixing, op5_decontamination, op6_jaccard_join, op7_personal, op8_html_text, op9_quality, op10_outliers,
        op11_whitening, op12_toxicity, op13_alignment,
    )
}

__all__ = ["ORACLES", "QUERIES"]
