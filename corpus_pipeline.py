"""Corpus pipeline: toxicity, SimHash near-duplicates, benchmark decontamination, PII, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a
stage returns and reads it as the next one's documents. All but the last return the
columns of ``documents``; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import decontam, mixing, pii, simhash, toxicity
from staylens.llm.common import read, stored
from staylens.llm.queries import PII_KEY

ORACLE_SQL = None  # XXH64 and zstandard have no SQL form; tests/llm compares with brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (trained on ``labels``) does not reject."""
    model = toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return pii.replace(docs, key=PII_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("pii", replace_pii), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
