"""Corpus cleaning as a chain of stages over `documents`.

Toxic documents go, then documents in no learned language; one document of each
group of near-duplicates stays; what is left is packed into training sequences.
Models are fitted on the rows that a stage is given. Each stage's output is written
as Parquet and read again by the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delaynet.llm import language, simhash, toxicity
from delaynet.llm.queries import packed
from delaynet.session import materialize
from delaynet.sources.tables import table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not graded toxic. The grades are learned from `labels`."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some learned language describes; texts without letters go."""
    return language.keep_identified(docs, language.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of SimHash fingerprints connect."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, placed in sequences."""
    return packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near-duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# Fitted models, tokenizers and component search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each on what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
