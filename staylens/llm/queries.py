"""The registered queries of the corpus operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import (ann, collocations, decontam, html_text, lexical, lm_score, mixing, pii, quality, secrets, simhash,
                          substring_dedup, toxicity)
from staylens.llm.common import read

PII_KEY = "corpus-surrogates"  # a deployment passes its own secret


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(read(spark, sf_dir, "documents"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"), key=PII_KEY)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filter_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_simhash, op3_secrets, op4_mixing, op5_substring_dedup, op6_html_text,
                                   op7_ann, op8_toxicity, op9_decontamination, op10_pii, op11_lexical, op12_quality,
                                   op13_collocations, pipeline)}
